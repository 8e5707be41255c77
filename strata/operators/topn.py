"""Ranking and top-N without a single-partition window.

A plain ``rank().over(Window.orderBy(...))`` moves every row to one task.
Here the N-th best value is found first with a distributed top-k
(``orderBy().limit(n)`` plans as ``TakeOrderedAndProject``: each task keeps
its own n best, then only those are merged), rows are filtered against it,
and ranks are computed on a table of at most ``n`` distinct values which is
then broadcast back. The ``limit`` is what proves that table's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize_shared

# Above this many rank values the rank table is joined by shuffle, not broadcast.
MAX_BROADCAST_RANKS = 100_000


def _order(col, ascending: bool):
    return col.asc() if ascending else col.desc()


def _join_ranks(df: DataFrame, ranks: DataFrame, metric: str, n: int) -> DataFrame:
    ranks = F.broadcast(ranks) if n <= MAX_BROADCAST_RANKS else ranks
    return df.join(ranks, on=metric, how="inner")


def _stable(df: DataFrame, materialize: bool) -> DataFrame:
    return materialize_shared(df, "topn-input") if materialize else df


def top_n_with_ties(df: DataFrame, metric: str, n: int, ascending: bool = False,
                    rank_col: str | None = None, materialize: bool = True) -> DataFrame:
    """Rows whose ``rank()`` by ``metric`` is <= n (ties kept, so the result
    may hold more than n rows); NULL metrics are dropped.

    rank <= n  <=>  metric is at least as good as the n-th best value counted
    with repeats, which is the threshold used here. The input is written once
    and read for the threshold and for the rows: evaluated twice, a metric
    that depends on the order of rows could lose its best one.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    df = _stable(df, materialize)
    m = F.col(metric)
    nonnull = df.filter(m.isNotNull())
    best_n = nonnull.select(m.alias("_v")).orderBy(_order(F.col("_v"), ascending)).limit(n)
    threshold = best_n.agg((F.max if ascending else F.min)("_v")).scalar()
    kept = nonnull.filter(m <= threshold if ascending else m >= threshold)
    if rank_col is None:
        return kept
    # rank = 1 + rows strictly better; the kept rows have at most n distinct values.
    counts = kept.groupBy(metric).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(_order(F.col(metric), ascending)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select(metric, (F.coalesce(F.sum("_n").over(w), F.lit(0)) + 1).cast("bigint").alias(rank_col))
    return _join_ranks(kept, ranks, metric, n)


def dense_rank_values(df: DataFrame, metric: str, n: int, ascending: bool = False,
                      rank_col: str = "rank") -> DataFrame:
    """The ``n`` best distinct values of ``metric`` with their dense rank
    (at most ``n`` rows)."""
    m = F.col(metric)
    values = (df.filter(m.isNotNull()).select(metric).distinct()
                .orderBy(_order(m, ascending)).limit(n))
    return values.select(metric, F.dense_rank().over(Window.orderBy(_order(m, ascending))).cast("bigint").alias(rank_col))


def dense_top_n(df: DataFrame, metric: str, n: int, ascending: bool = False,
                rank_col: str = "rank", materialize: bool = True) -> DataFrame:
    """Rows whose ``dense_rank()`` by ``metric`` is <= n, with that rank."""
    if n < 1:
        raise ValueError("n must be >= 1")
    df = _stable(df, materialize)
    return _join_ranks(df, dense_rank_values(df, metric, n, ascending, rank_col), metric, n)


def dense_rank_all(df: DataFrame, metric: str, ascending: bool = False,
                   rank_col: str = "rank", materialize: bool = True) -> DataFrame:
    """Every row of ``df`` with the dense rank of its ``metric`` (NULL metric
    -> NULL rank), without a single-partition window and without joining rows
    on the value.

    The rows themselves are range-sorted, and by a hash of all their columns
    among equal values, so that a value that many rows share spreads over
    partitions. Each partition numbers its distinct values; how many lie
    before it, not counting one that it shares with the partition before, is
    all that is added. That table has one row per partition, so it is the
    only thing that is broadcast. The sorted rows are written once: range
    bounds come from sampling, so sorting twice could place rows differently.
    """
    df = _stable(df, materialize)
    m = F.col(metric)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed = materialize_shared(df.filter(m.isNotNull()).orderBy(_order(m, ascending), spread).withColumn("_part", F.spark_partition_id()), "dense-rank")
    first, last = (F.min, F.max) if ascending else (F.max, F.min)
    sizes = placed.groupBy("_part", metric).agg(F.count(F.lit(1)).alias("_rows")).groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), first(metric).alias("_first"), last(metric).alias("_last"))
    parts = Window.orderBy("_part")
    shared = F.when(F.lag("_last").over(parts) == F.col("_first"), 1).otherwise(0)
    steps = sizes.withColumn("_shared", shared)
    before = F.coalesce(F.sum("_n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = steps.select("_part", (before - F.sum("_shared").over(parts.rowsBetween(Window.unboundedPreceding, 0))).alias("_offset"))
    inside = F.dense_rank().over(Window.partitionBy("_part").orderBy(_order(m, ascending)))
    ranked = placed.withColumn("_local", inside).join(F.broadcast(offsets), "_part").withColumn(
        rank_col, (F.col("_offset") + F.col("_local")).cast("bigint")).select(*df.columns, rank_col)
    return ranked.unionByName(df.filter(m.isNull()).withColumn(rank_col, F.lit(None).cast("bigint")))
