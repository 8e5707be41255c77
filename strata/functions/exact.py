"""Order-independent sums and means of fixed-decimal values.

Summing doubles depends on the order rows arrive in, so the same query can
return different last bits on different partitionings -- enough to flip a tie
in a ranking. Values known to carry at most ``scale`` decimals (ratings
rounded to 2 dp, money amounts) are summed exactly as scaled integers and
divided once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _scaled(c: Column, scale: int) -> Column:
    return F.round(c * F.lit(10 ** scale)).cast("bigint")


def sum_fixed(c: Column, scale: int = 2) -> Column:
    """Exact sum of values with at most ``scale`` decimals, as a double."""
    return F.sum(_scaled(c, scale)).cast("double") / F.lit(float(10 ** scale))


def sum_exact(c: Column) -> Column:
    """Exact decimal sum of doubles as written (their shortest decimal form),
    down to 18 decimals: scores in scientific notation keep their digits. The
    result is a decimal: compare and rank it as such, cast it to show it."""
    return F.sum(c.cast("decimal(38,18)"))


def avg_fixed(c: Column, scale: int = 2) -> Column:
    """Exact mean of values with at most ``scale`` decimals (NULLs ignored,
    NULL when there are none)."""
    return F.try_divide(F.sum(_scaled(c, scale)).cast("double"),
                        (F.count(c) * F.lit(10 ** scale)).cast("double"))
