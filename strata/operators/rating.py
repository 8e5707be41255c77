"""Bayesian weighted rating (the flagship fact's measure)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize_shared


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One row: the median of ``value`` (the mean of the two middle values),
    exact, without one task that holds every distinct value (A2).

    Values are counted, range-sorted and written once; positions follow from
    running sums inside each range plus the total of the ranges before it (one
    row per range), and only the middle values are picked.
    """
    v = F.col(value)
    counts = (df.filter(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy("v").withColumn("part", F.spark_partition_id()))
    counts = materialize_shared(counts, "median-counts")
    sizes = counts.groupBy("part").agg(F.sum("n").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    total = counts.agg(F.sum("n")).scalar()
    inside = Window.partitionBy("part").orderBy("v")
    placed = counts.join(F.broadcast(offsets), "part").withColumn("end", F.col("offset") + F.sum("n").over(inside))
    def at(k):
        return F.max(F.when((F.col("end") > k) & (F.col("end") - F.col("n") <= k), F.col("v")))
    low, high = at(F.floor((total - 1) / 2)), at(F.floor(total / 2))
    return placed.agg(((low + high) / 2).cast("double").alias("median"))


def bayesian_prior(df: DataFrame, rating: str, reviews: str, approx_median: bool = False) -> tuple[DataFrame, DataFrame]:
    """One-row frames: mean rating and median review count over rated,
    reviewed rows (P4, A1, A2). Ratings are summed as decimals and divided
    once, so the mean doesn't depend on the order of rows. ``approx_median``
    switches to ``percentile_approx``."""
    n = F.col(reviews).cast("double")
    used = df.filter(F.col(rating).isNotNull() & (F.col(reviews) > 0))
    mean = used.agg(F.try_divide(F.sum(F.col(rating).cast("decimal(38,18)")).cast("double"),
                                 F.count(F.lit(1)).cast("double")).alias("global_mean"))
    if approx_median:
        return mean, used.agg(F.percentile_approx(n, 0.5, 10000).cast("double").alias("median"))
    return mean, exact_median(used.select(n.alias("reviews")), "reviews")


def weighted_rating_expr(rating: Column, reviews: Column, mean: Column, threshold: Column,
                         scale: int = 2) -> Column:
    """(C*m + R*v) / (C + v), rounded half away from zero.

    NULL rating -> NULL; a zero denominator gives NULL instead of an error.
    """
    r, v = rating.cast("double"), reviews.cast("double")
    return F.round(F.try_divide(threshold * mean + r * v, threshold + v), scale)


def with_weighted_rating(df: DataFrame, rating: str = "rating", reviews: str = "reviews",
                         out: str = "weighted_rating", scale: int = 2,
                         approx_median: bool = False) -> DataFrame:
    """Append the Bayesian weighted rating to every row of ``df``.

    The prior's two values are scalar subqueries: each is computed once and
    inlined as a constant, so no join -- and no shuffle of ``df`` -- is needed
    to bring it next to each row (J2). ``df`` is read several times (prior and
    rows): pass a persisted silver table, not a long lineage.
    """
    mean, median = bayesian_prior(df, rating, reviews, approx_median)
    return (df.withColumn("_prior", F.struct(mean.scalar().alias("mean"), median.scalar().alias("threshold")))
              .withColumn(out, weighted_rating_expr(F.col(rating), F.col(reviews), F.col("_prior.mean"),
                                                    F.col("_prior.threshold"), scale))
              .drop("_prior"))
