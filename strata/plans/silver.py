"""Silver models: cleaned entities and many-to-many bridges (Q1, Q1b-Q1d).

Inputs are bronze frames with the source contract's column names
(:mod:`strata.schemas`); outputs use the cleaned names. Every model is a
projection plus built-in scalar functions, so a model and its consumer fuse
into one stage; only the whole-row dedup of games shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import scalars as S
from strata.operators.flatten import flatten_bridge
from strata.operators.summarize import distinct_rows

# bridge model -> (array column of the games snapshot, output key column)
BRIDGES = {
    "clean_bridge_franchise": ("franchises", "fk_franchise"),
    "clean_bridge_gamemode": ("game_modes", "fk_game_mode"),
    "clean_bridge_genre": ("genres", "fk_genre"),
    "clean_bridge_platform": ("platforms", "fk_platform"),
}


def clean_games(raw_games: DataFrame) -> DataFrame:
    """Cleaned games: renamed keys, repaired review count, NULL wishlist as
    0, release epoch as a UTC date; identical rows collapsed (Q1)."""
    return distinct_rows(raw_games, [
        S.as_id("id").alias("id"),
        F.col("name"),
        S.as_id("game_type").alias("fk_game_type"),
        F.col("total_rating").alias("average_rating"),
        S.repaired_review_count("total_rating_count", "total_rating").alias("num_of_reviews"),
        S.zero_if_null("hypes").cast("bigint").alias("wishlist_count"),
        S.as_id("game_status").alias("fk_status"),
        S.epoch_to_date("first_release_date").alias("date_first_release"),
    ])


def clean_lookup(raw: DataFrame, label: str = "name", created: str | None = "created_at") -> DataFrame:
    """Id + label (+ created date) lookups: franchise, game mode, game type,
    genre, platform (Q1b)."""
    cols = [S.as_id("id").alias("id"), F.col(label)]
    if created:
        cols.append(S.epoch_to_date(created).alias("date_created_at"))
    return raw.select(*cols)


def clean_status(raw: DataFrame) -> DataFrame:
    return raw.select(S.as_id("id").alias("id"), F.col("status"))


def clean_poptype(raw: DataFrame) -> DataFrame:
    return raw.select(S.as_id("id").alias("id"), F.col("name"))


def clean_popularity(raw: DataFrame, type_as_id: bool = True) -> DataFrame:
    """Popularity measurements with the measuring day as a date.
    ``type_as_id=False`` keeps a text popularity-type key as it is."""
    ptype = S.as_id("popularity_type") if type_as_id else F.col("popularity_type")
    return raw.select(
        S.as_id("id").alias("id"),
        S.as_id("game_id").alias("fk_game"),
        ptype.alias("fk_popularity_type"),
        F.col("value").cast("double").alias("popularity_score"),
        S.epoch_to_date("calculated_at").alias("date_measured_at"),
    )


def clean_bridge(raw_games: DataFrame, array_col: str, out_col: str) -> DataFrame:
    """(game, key) rows of one id array (Q1d). Built from the undeduplicated
    snapshot, as the source model does: duplicates stay."""
    return flatten_bridge(raw_games, "id", array_col, out_col, "bigint", id_alias="fk_game")


def build_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All silver models from the bronze frames that are present."""
    out: dict[str, DataFrame] = {}
    games = bronze.get("raw_games")
    if games is not None:
        out["clean_games"] = clean_games(games)
        for model, (arr, key) in BRIDGES.items():
            out[model] = clean_bridge(games, arr, key)
    for src, model in (("raw_franchise", "clean_franchise"), ("raw_gamemode", "clean_gamemode"),
                       ("raw_genre", "clean_genre"), ("raw_platform", "clean_platform")):
        if src in bronze:
            out[model] = clean_lookup(bronze[src])
    if "raw_gametype" in bronze:
        out["clean_gametype"] = clean_lookup(bronze["raw_gametype"], label="type")
    if "raw_gamestatus" in bronze:
        out["clean_gamestatus"] = clean_status(bronze["raw_gamestatus"])
    if "raw_poptype" in bronze:
        out["clean_poptype"] = clean_poptype(bronze["raw_poptype"])
    if "raw_popprimitive" in bronze:
        out["clean_popprimitive"] = clean_popularity(bronze["raw_popprimitive"])
    return out
