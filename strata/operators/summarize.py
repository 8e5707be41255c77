"""Deduplication, metadata-driven summaries and date drill-down."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exact import sum_exact

_AGGS = {
    "sum": F.sum,
    "count": F.count,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
}


def distinct_rows(df: DataFrame, columns: Sequence[str | Column] | None = None) -> DataFrame:
    """Whole-row dedup of a projection (A3): a hash aggregate whose partial
    step runs on every task before the shuffle, so even a row repeated across
    a third of the input shrinks to one row per task first."""
    return (df.select(*columns) if columns else df).distinct()


def summary_columns(summary: Mapping[str, str], exact: Sequence[str] = ()) -> list[Column]:
    """Aggregates for columns whose default summarization is not ``none``
    (A14); each is named ``{agg}_{column}``. Sums of the ``exact`` columns do not
    depend on the order of rows (see :mod:`strata.functions.exact`)."""
    out = []
    for col, how in summary.items():
        if how in (None, "none"):
            continue
        fn = _AGGS[how]
        expr = fn(F.col(col))
        if how == "count":
            expr = expr.cast("bigint")
        elif how == "sum" and col in exact:
            expr = sum_exact(F.col(col)).cast("double")
        out.append(expr.alias(f"{how}_{col}"))
    return out


def summarize(df: DataFrame, keys: Sequence[str], summary: Mapping[str, str], exact: Sequence[str] = ()) -> DataFrame:
    """Group by ``keys`` and apply each column's default summarization."""
    return df.groupBy(*keys).agg(*summary_columns(summary, exact))


def drill(df: DataFrame, levels: Sequence[str], aggs: Mapping[str, Column],
          level_col: str = "drill_level") -> DataFrame:
    """All levels of a hierarchy at once (A15): a ``rollup`` over the level
    columns, with ``drill_level`` = number of levels grouped (0 = grand total).
    """
    out = df.rollup(*levels).agg(*[c.alias(n) for n, c in aggs.items()],
                                 F.grouping_id(*levels).alias("_gid"))
    # each rolled-up level sets one bit of grouping_id
    return (out.withColumn(level_col, (F.lit(len(levels)) - F.bit_count(F.col("_gid"))).cast("int"))
               .drop("_gid"))
