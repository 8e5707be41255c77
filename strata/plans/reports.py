"""Report queries over a semantic model (Q4-Q15).

Each function takes the model (fact + dimensions), the filter context that
reaches its visual, and its parameters, and returns a lazy DataFrame. The
fact must carry the game-fact columns: key, ``name``, ``status``,
``num_of_reviews``, ``weighted_rating``, ``wishlist_count`` and
``date_first_release``.

Grouping is by *name* (games sharing a name merge); rankings never put
unaggregated rows through one task (see :mod:`strata.operators.topn`).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exact import avg_fixed, sum_exact
from strata.functions.text import collated, group_by_name, name_order
from strata.operators import semantic as sem
from strata.operators import topn
from strata.operators.summarize import drill
from strata.session import materialize_shared
from strata.sources.catalog import DEFAULT_TOP_N, selected_value

# Weighted ratings and popularity scores carry 2 decimals; their sums and
# means are computed exactly (see strata.functions.exact) so ties are stable.
SCORE_SCALE = 2


# Which slicer reaches which visual of the report page (the
# page's default is "filters"; these are the pairs left on).
SLICERS = ("game_mode", "status", "popularity_type", "aspect", "top_n")
FILTER_MATRIX = {
    "top3_rated": {"game_mode", "status"},
    "popularity_rank": {"status", "popularity_type", "top_n"},
    "top5_by_rating": {"status", "aspect"},
    "top5_by_reviews": {"status", "aspect"},
    "scatter": {"status"},
    "game_count": {"status"},
    "most_wishlisted": set(),
}


def context_for(visual: str, selections: Mapping[str, Iterable | None]) -> dict:
    """The slicer selections that reach ``visual``; the others are dropped."""
    reach = FILTER_MATRIX[visual]
    return {k: v for k, v in selections.items() if k in reach and v}


def display_order(df: DataFrame, *order) -> DataFrame:
    """Result ordering for a visual (L1): a distributed, range-partitioned
    sort. Ties can make a top-N result arbitrarily large, so it is never
    funnelled into a single partition."""
    return df.orderBy(*order)


def facts_in_context(model: sem.SemanticModel, filters, status) -> DataFrame:
    """Fact rows under dimension filters plus a status slicer (J6 + P5)."""
    status_filter = F.col("status").isin(list(status)) if status else None
    return sem.propagate(model, filters, status_filter)


def first_in_order(col: str, collation: str | None = None) -> Column:
    """The first value of ``col`` in sort order (A7/A10). Spark compares text
    by code point; pass e.g. ``collation="UNICODE_CI"`` to order ignoring case
    as the BI tool does. The result is returned as a plain string."""
    if collation is None:
        return F.min(col)
    return F.collate(F.min(F.collate(F.col(col), collation)), "UTF8_BINARY")


def most_wishlisted(fact: DataFrame, collation: str | None = None) -> DataFrame:
    """Highest wishlist among unreleased games and the game holding it;
    on ties the first name in sort order (Q4: P7, A8, P9, A10). One row."""
    unreleased = fact.filter(F.col("date_first_release").isNull())
    top = unreleased.agg(F.max("wishlist_count")).scalar()
    return (unreleased.filter(F.col("wishlist_count") == top)
                      .agg(first_in_order("name", collation).alias("name"),
                           F.max("wishlist_count").alias("wishlist_count")))


def top_rated(model: sem.SemanticModel, filters: Mapping[str, Iterable] | None = None,
              status: Iterable[str] | None = None, n: int = 3, mode_dim: str = "game_mode",
              display_scale: int | None = None, collation: str | None = None) -> DataFrame:
    """Top-``n`` names by average weighted rating, ties kept, with their
    summed reviews and their first game-mode label (Q5: J6 A5 A4 A7 L2 J7).
    ``display_scale`` ranks the average as displayed, rounded to that many
    decimals (coarser values tie more often). Names that ``collation`` calls
    equal are one, and labels order by it."""
    chosen = (filters or {}).get(mode_dim)
    pairs = sem.label_pairs(model, mode_dim)
    if chosen:
        pairs = pairs.filter(F.col("label").isin(list(chosen)))
    pairs = materialize_shared(pairs, "mode-pairs")  # read for the filter and for the label
    others = {k: v for k, v in (filters or {}).items() if k != mode_dim}
    facts = facts_in_context(model, others, status)
    if chosen:
        facts = facts.join(pairs.select(model.fact_key).distinct(), model.fact_key, "left_semi")
    avg = avg_fixed(F.col("weighted_rating"), SCORE_SCALE)
    if display_scale is not None:
        avg = F.round(avg, display_scale)
    facts = facts.withColumn("_same", collated("name", collation))
    per_name = facts.groupBy("_same").agg(
        F.min("name").alias("name"),
        avg.alias("avg_weighted_rating"),
        F.sum("num_of_reviews").cast("bigint").alias("sum_reviews"))
    best = topn.top_n_with_ties(per_name, "avg_weighted_rating", n)
    modes = (pairs.join(facts.select(model.fact_key, "_same"), model.fact_key, "inner")
                  .join(best.select("_same"), "_same", "left_semi")
                  .groupBy("_same").agg(first_in_order("label", collation).alias("min_mode")))
    shown = best.join(modes, "_same", "left").drop("_same")
    return display_order(shown, F.col("avg_weighted_rating").desc(), *name_order("name", collation))


def popularity_by_name(model: sem.SemanticModel, selections: Mapping[str, Iterable | None],
                       collation: str | None = None) -> DataFrame:
    """Summed popularity score per game *name* (games sharing a name merge)
    under the slicers that reach the rank table: status restricts the games
    and, through them, the measurements; the popularity type restricts the
    measurements (J6 over both facts, A4). Scores are summed exactly, per game
    first, so a much measured game shrinks before it meets its name."""
    context = context_for("popularity_rank", selections)
    status = context.get("status")
    games = facts_in_context(model, None, status)
    r = model.related["popularity"]
    rows = sem.related_rows(model, "popularity", context, games if status else None)
    per_game = rows.groupBy(r.key).agg(sum_exact(F.col("popularity_score")).alias("_score"))
    names = games.select(F.col(model.fact_key).alias(r.key), "name")
    return group_by_name(per_game.join(names, r.key, "left"), "name",
                         {"popularity_score": F.sum("_score").cast("decimal(38,18)")}, collation)


def popularity_rank(model: sem.SemanticModel, selections: Mapping[str, Iterable | None],
                    collation: str | None = None) -> DataFrame:
    """Game names by summed score, dense ranked, keeping those flagged top-N
    (Q6: A4 W1 W2 P8 A13). N is the slicer's single choice, else 10. Names
    that ``collation`` calls equal are one."""
    n = selected_value(selections.get("top_n"), DEFAULT_TOP_N)
    scores = popularity_by_name(model, selections, collation)
    ranked = topn.dense_top_n(scores, "popularity_score", n, rank_col="popularity_rank")
    ranked = ranked.withColumn("popularity_score", F.col("popularity_score").cast("double")).withColumn("is_top_n", F.lit(1))
    return display_order(ranked, "popularity_rank", *name_order("name", collation))


def popularity_flags(model: sem.SemanticModel, selections: Mapping[str, Iterable | None]) -> DataFrame:
    """Every game name with its summed score, its dense rank among all
    selected names and the 1/0 "is top N" flag (W1 + W2: the rank measure and
    the flag the rank table filters on)."""
    n = selected_value(selections.get("top_n"), DEFAULT_TOP_N)
    ranked = topn.dense_rank_all(popularity_by_name(model, selections), "popularity_score", rank_col="popularity_rank")
    flag = F.when(F.col("popularity_rank") <= n, 1).otherwise(0)
    return ranked.withColumn("popularity_score", F.col("popularity_score").cast("double")).withColumn("is_top_n", flag)


def top_labels(model: sem.SemanticModel, dim: str, metric: str = "reviews", n: int = 5,
               facts: DataFrame | None = None, collation: str | None = None) -> DataFrame:
    """Top-``n`` labels of one dimension, ties kept (Q7 by average weighted
    rating, Q8 by summed reviews; W3 W4 J5 A4 A5). Each game counts once per
    label, and labels that ``collation`` calls equal are one; NULL metrics
    drop out."""
    if metric == "reviews":
        aggs = {"sum_reviews": F.sum("num_of_reviews").cast("bigint")}
        key = "sum_reviews"
    elif metric == "rating":
        aggs = {"avg_weighted_rating": avg_fixed(F.col("weighted_rating"), SCORE_SCALE),
                "sum_reviews": F.sum("num_of_reviews").cast("bigint")}
        key = "avg_weighted_rating"
    else:
        raise ValueError(f"unknown metric {metric!r}")
    per = sem.metric_by_label(model, dim, aggs, facts, collation)
    return display_order(topn.top_n_with_ties(per, key, n), F.col(key).desc(), *name_order("label", collation))


def top_labels_for_aspect(model: sem.SemanticModel, aspect_to_dim: Mapping[str, str],
                          aspects: Iterable[str] | None, metric: str = "reviews", n: int = 5,
                          facts: DataFrame | None = None) -> DataFrame | None:
    """The dimension switch (Q9): the single selected aspect picks the
    dimension; no single selection -> no result (blank)."""
    chosen = selected_value(aspects)
    if chosen is None:
        return None
    return top_labels(model, aspect_to_dim[chosen], metric, n, facts)


def scatter_points(fact: DataFrame, collation: str | None = None) -> DataFrame:
    """Distinct (reviews, average rating) points with a representative
    (first) name; unrated games are not plotted (Q10: A11)."""
    return (fact.filter(F.col("average_rating").isNotNull())
                .groupBy("num_of_reviews", "average_rating")
                .agg(first_in_order("name", collation).alias("name")))


def game_count(facts: DataFrame, key: str = "id") -> DataFrame:
    """Number of games in the filter context (Q11: A6)."""
    return facts.agg(F.count(key).alias("n_items"))


def wishlist_top(fact: DataFrame, n: int = 5, collation: str | None = None) -> DataFrame:
    """Unreleased games first, then the top-``n`` names by summed wishlist,
    ties kept (Q12: P7 A4 L2); names that ``collation`` calls equal are one."""
    per = group_by_name(fact.filter(F.col("date_first_release").isNull()), "name",
                        {"wishlist_count": F.sum("wishlist_count").cast("bigint")}, collation)
    return display_order(topn.top_n_with_ties(per, "wishlist_count", n), F.col("wishlist_count").desc(), *name_order("name", collation))


def types_with_known_status(model: sem.SemanticModel) -> DataFrame:
    """Popularity types measured for at least one game whose status is known
    (Q13: P6 + J6 as a semi join over the fact-to-fact relationship)."""
    known = model.fact.filter(F.col("status").isNotNull())
    return sem.related_labels(model, "popularity", "popularity_type", known).withColumnRenamed("label", "popularity_type")


def drill_by_release(fact: DataFrame, calendar: DataFrame, levels: list[str],
                     aggs: Mapping[str, Column]) -> DataFrame:
    """The fact by release-date hierarchy level (Q14: J4 + A15). Every level,
    the date too, is the calendar's: games without a date, or with one outside
    the calendar, are in its blank member. The calendar's size is bounded by
    its date span, so it is broadcast."""
    cal = F.broadcast(calendar.select(F.col("Date").alias("_released"), *levels))
    joined = fact.join(cal, F.col("date_first_release") == F.col("_released"), "left")
    return drill(joined, levels, aggs)


def slicer_values(model: sem.SemanticModel, dim: str, facts: DataFrame | None = None) -> DataFrame:
    """Labels a slicer offers under the filters that reach it (Q15: A16)."""
    return sem.label_values(model, dim, facts)
