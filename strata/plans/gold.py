"""Gold models: the two facts, the dimensions and the bridges.

``fct_games`` carries the Bayesian weighted rating. Gold models are views in
the source design: they are plain projections over silver, so they are
returned as lazy frames and optimized together with whatever reads them.
Display names (with spaces) are applied by :func:`with_display_names` only
when publishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.rating import with_weighted_rating
from strata.operators.semantic import lookup
from strata.sources import runs

# Display names of the published gold columns.
DISPLAY_NAMES = {
    "fct_games": {
        "id": "Game ID", "name": "Game name", "fk_game_type": "Game type ID", "status": "Status",
        "average_rating": "Average rating", "num_of_reviews": "Number of reviews",
        "wishlist_count": "Wishlist count", "date_first_release": "Date game initial release",
        "weighted_rating": "Weighted rating",
    },
    "fct_daily_popularity": {
        "id": "Popularity ID", "fk_game": "Game ID", "fk_popularity_type": "Popularity type ID",
        "popularity_score": "Popularity score", "date_measured_at": "Date popularity measured at",
    },
    "dim_franchise": {"id": "Franchise ID", "name": "Franchise name", "date_created_at": "Date franchise created"},
    "dim_gamemode": {"id": "Game mode ID", "name": "Game mode name", "date_created_at": "Date game mode created"},
    "dim_gametype": {"id": "Game type ID", "type": "Game type name", "date_created_at": "Date game type created"},
    "dim_genre": {"id": "Genre ID", "name": "Genre name", "date_created_at": "Date genre created"},
    "dim_platform": {"id": "Platform ID", "name": "Platform name", "date_created_at": "Date platform created"},
    "dim_poptype": {"id": "Popularity type ID", "name": "Popularity type name"},
    "dim_bridge_franchise": {"fk_game": "Game ID", "fk_franchise": "Franchise ID"},
    "dim_bridge_gamemode": {"fk_game": "Game ID", "fk_game_mode": "Game mode ID"},
    "dim_bridge_genre": {"fk_game": "Game ID", "fk_genre": "Genre ID"},
    "dim_bridge_platform": {"fk_game": "Game ID", "fk_platform": "Platform ID"},
}


# Default summarization of the fact columns in the BI model
# (keys and dates are not summarized).
DEFAULT_SUMMARY = {
    "fct_games": {"id": "none", "name": "none", "fk_game_type": "none", "average_rating": "sum",
                  "num_of_reviews": "sum", "wishlist_count": "sum", "date_first_release": "none",
                  "status": "none", "weighted_rating": "sum"},
    "fct_daily_popularity": {"id": "count", "fk_game": "none", "fk_popularity_type": "none",
                             "popularity_score": "sum", "date_measured_at": "none"},
}


def with_display_names(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Display-name projection (P2): keep the mapped columns, renamed."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def fct_games(clean_games: DataFrame, clean_status: DataFrame,
              approx_median: bool = False) -> DataFrame:
    """Game fact: status label by left lookup (unknown status -> NULL) and
    the weighted rating from the global prior (Q2)."""
    rated = with_weighted_rating(clean_games, "average_rating", "num_of_reviews",
                                 "weighted_rating", approx_median=approx_median)
    with_status = lookup(rated, clean_status, "fk_status", "id", ["status"])
    return with_status.select("id", "name", "fk_game_type", "status", "average_rating",
                              "num_of_reviews", "wishlist_count", "date_first_release",
                              "weighted_rating")


def fct_daily_popularity(clean_popularity: DataFrame) -> DataFrame:
    return clean_popularity.select("id", "fk_game", "fk_popularity_type", "popularity_score",
                                   "date_measured_at")


DAY = "date_measured_at"
#: About a row group: days are many and should not become many small files.
DAY_FILE_BYTES = 128 * 1024 * 1024


def stage_popularity(fact: DataFrame, root: str, tag: str, target_file_bytes: int = DAY_FILE_BYTES) -> str:
    """Write the popularity fact in one folder per measuring day (rows without
    a day have their own), each day's rows put together first, so a day is a
    few files of about ``target_file_bytes`` whatever its share of the rows
    (S8, Q2b). Returns the version folder for a commit."""
    return runs.stage(fct_daily_popularity(fact), root, tag, [DAY], target_file_bytes)


def measured_on(fact: DataFrame, calendar: DataFrame, chosen: Column) -> DataFrame:
    """Rows of a popularity fact partitioned by day whose day the calendar
    filter ``chosen`` keeps. The calendar's size is bounded by its date span, so
    it is broadcast, and Spark prunes the fact's folders at run time by the
    days that are left: other days' files are not read."""
    days = F.broadcast(calendar.filter(chosen).select(F.col("Date").alias("_day")))
    return fact.join(days, fact[DAY] == F.col("_day"), "left_semi")


def build_gold(silver: dict[str, DataFrame], display: bool = False) -> dict[str, DataFrame]:
    out: dict[str, DataFrame] = {}
    if "clean_games" in silver and "clean_gamestatus" in silver:
        out["fct_games"] = fct_games(silver["clean_games"], silver["clean_gamestatus"])
    if "clean_popprimitive" in silver:
        out["fct_daily_popularity"] = fct_daily_popularity(silver["clean_popprimitive"])
    for name in ("franchise", "gamemode", "gametype", "genre", "platform", "poptype"):
        if f"clean_{name}" in silver:
            out[f"dim_{name}"] = silver[f"clean_{name}"]
    for name in ("franchise", "gamemode", "genre", "platform"):
        if f"clean_bridge_{name}" in silver:
            out[f"dim_bridge_{name}"] = silver[f"clean_bridge_{name}"]
    if display:
        out = {k: with_display_names(v, DISPLAY_NAMES[k]) for k, v in out.items()}
    return out


def view_sql(silver: str = "silver") -> dict[str, str]:
    """The twelve gold models as SELECTs over the silver catalog tables, for
    persistent views: columns under their display names (Q2, Q2b, Q2c)."""
    def shown(name: str, source: str) -> str:
        columns = ", ".join(f"`{src}` AS `{dst}`" for src, dst in DISPLAY_NAMES[name].items())
        return f"SELECT {columns} FROM {source}"

    rated = f"""(SELECT g.*, s.status, round(try_divide(p.threshold * p.mean + cast(g.average_rating AS double) * g.num_of_reviews,
       p.threshold + g.num_of_reviews), 2) AS weighted_rating
FROM `{silver}`.`clean_games` g LEFT JOIN `{silver}`.`clean_gamestatus` s ON g.fk_status = s.id
CROSS JOIN (SELECT avg(cast(average_rating AS decimal(38,18))) AS mean, median(num_of_reviews) AS threshold
            FROM `{silver}`.`clean_games` WHERE average_rating IS NOT NULL AND num_of_reviews > 0) p)"""
    out = {"fct_games": shown("fct_games", rated), "fct_daily_popularity": shown("fct_daily_popularity", f"`{silver}`.`clean_popprimitive`")}
    for name in DISPLAY_NAMES:
        if name.startswith("dim_"):
            out[name] = shown(name, f"`{silver}`.`clean_{name.removeprefix('dim_')}`")
    return out
