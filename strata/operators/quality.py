"""Declarative column tests.

Each test returns its failing rows; zero rows means it passes. A suite run
folds every row-level test of one table (not-null, range, accepted values)
into a single aggregation pass, and its uniqueness tests into one partially
aggregated group-by.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Key values appearing more than once (NULL keys ignored) with their
    row count ``n_records`` (D1)."""
    cols = _cols(columns)
    notnull = F.lit(True)
    for c in cols:
        notnull = notnull & F.col(c).isNotNull()
    return (df.filter(notnull).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def not_null_condition(column: str) -> Column:
    return F.col(column).isNull()


def range_condition(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    c = F.col(column)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & (c >= min_value if inclusive else c > min_value)
    if max_value is not None:
        ok = ok & (c <= max_value if inclusive else c < max_value)
    return c.isNotNull() & ~ok


def values_condition(column: str, values: Iterable) -> Column:
    c = F.col(column)
    return c.isNotNull() & ~c.isin(list(values))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(not_null_condition(column))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None,
                   inclusive: bool = True) -> DataFrame:
    """Rows outside the bounds; NULL passes (D3)."""
    return df.filter(range_condition(column, min_value, max_value, inclusive))


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose value is not one of ``values``; NULL passes."""
    return df.filter(values_condition(column, values))


@dataclass(frozen=True)
class Check:
    kind: str  # unique | not_null | accepted_range | accepted_values
    column: str | tuple
    params: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        col = "_".join(_cols(self.column))
        return f"{self.kind}:{col}"

    def condition(self) -> Column:
        if self.kind == "not_null":
            return not_null_condition(self.column)
        if self.kind == "accepted_range":
            return range_condition(self.column, self.params.get("min_value"),
                                   self.params.get("max_value"), self.params.get("inclusive", True))
        if self.kind == "accepted_values":
            return values_condition(self.column, self.params["values"])
        raise ValueError(f"{self.kind} is not a row-level check")


def _repeated_keys(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """(pos, failures) of every uniqueness check, over one shuffle: each row
    gives one (check, key) pair per check whose key has no NULL, the pairs are
    counted (partially in every task first, so a key that a third of the rows
    have is one pair per task), and so are the keys met more than once."""
    def pair(i: int, c: Check) -> Column:
        keys = [F.col(k) for k in _cols(c.column)]
        known = functools.reduce(Column.__and__, [k.isNotNull() for k in keys])
        # within a check keys have one type, so equal texts are equal keys
        return F.when(known, F.struct(F.lit(i).alias("pos"), F.array(*[k.cast("string") for k in keys]).alias("key")))

    pairs = df.select(F.explode(F.array(*[pair(i, c) for i, c in checks])).alias("p")).filter("p is not null")
    repeated = pairs.groupBy("p").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = repeated.agg(*[F.count(F.when(F.col("p.pos") == i, 1)).alias(f"c{i}") for i, _ in checks])
    return found.select(F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.col(f"c{i}").alias("failures")) for i, _ in checks])).alias("s")).select("s.*")


def run_checks(df: DataFrame, checks: Sequence[Check], table: str = "") -> DataFrame:
    """(table, pos, check, failures) for every check, in the given order.

    Row-level checks share one aggregation over ``df``; all uniqueness checks
    share one group-by of (check, key) pairs.
    """
    row_checks = [(i, c) for i, c in enumerate(checks) if c.kind != "unique"]
    unique_checks = [(i, c) for i, c in enumerate(checks) if c.kind == "unique"]
    parts: list[DataFrame] = []
    if row_checks:
        sums = [F.coalesce(F.sum(F.when(c.condition(), 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"c{i}")
                for i, c in row_checks]
        stacked = F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.col(f"c{i}").alias("failures")) for i, _ in row_checks]))
        parts.append(df.agg(*sums).select(stacked.alias("s")).select("s.*"))
    if unique_checks:
        parts.append(_repeated_keys(df, unique_checks))
    if not parts:
        raise ValueError("no checks given")
    out = functools.reduce(DataFrame.unionByName, parts)
    names = F.element_at(F.array(*[F.lit(c.name) for c in checks]), F.col("pos") + 1)
    return out.select(F.lit(table).alias("table"), "pos", names.alias("check"), "failures")


def assert_checks(results: DataFrame) -> None:
    """Fail the run when any check has failing rows (the result has one row
    per check, so collecting it is bounded)."""
    bad = [r for r in results.filter(F.col("failures") > 0).collect()]
    if bad:
        detail = ", ".join(f"{r['table']}.{r['check']}={r['failures']}" for r in bad)
        raise AssertionError(f"data tests failed: {detail}")
