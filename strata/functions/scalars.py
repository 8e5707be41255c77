"""Column-in, column-out helpers (scalar functions F1-F19).

All are compositions of built-in ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_to_date(seconds: Column | str) -> Column:
    """UNIX seconds -> UTC calendar date (F1).

    ``floor`` (not integer ``div``, which truncates toward zero) keeps
    pre-1970 instants on the right day, and going through
    ``date_from_unix_date`` makes the result independent of the session
    time zone.
    """
    return F.date_from_unix_date(F.floor(_c(seconds) / F.lit(SECONDS_PER_DAY)).cast("int"))


def zero_if_null(c: Column | str) -> Column:
    """NULL -> 0 (F2)."""
    return F.coalesce(_c(c), F.lit(0))


def repaired_review_count(count: Column | str, rating: Column | str,
                          max_rating_for_repair: float = 95) -> Column:
    """Review-count repair.

    * no reviews but a rating strictly between 0 and the limit -> 1
    * reviews but a rating of exactly 0 -> 0
    * otherwise the count, NULL read as 0
    """
    n, r = _c(count), _c(rating)
    return (F.when((n == 0) & (r > 0) & (r < max_rating_for_repair), F.lit(1))
            .when((n > 0) & (r == 0), F.lit(0))
            .otherwise(zero_if_null(n))).cast("bigint")


def as_id(c: Column | str) -> Column:
    """Integer id cast (F4). The source's small integer types are 38-digit
    numbers, so ids are always ``bigint`` (a byte cast would overflow)."""
    return _c(c).cast("bigint")


def weekday_monday1(d: Column | str) -> Column:
    """Day of week with Monday = 1 ... Sunday = 7."""
    return F.weekday(_c(d)) + 1


def week_of_year_jan1(d: Column | str) -> Column:
    """Week number with weeks starting Monday and week 1 holding January 1st
    (F11; not ISO-8601). Week k starts on the k-th Monday-aligned boundary
    counted from the Monday on or before January 1st."""
    d = _c(d)
    return (F.floor((F.dayofyear(d) - 1 + F.weekday(F.trunc(d, "year"))) / 7) + 1).cast("int")


def is_leap_year(d: Column | str) -> Column:
    """True when the day before March 1st of the date's year is the 29th (F16)."""
    d = _c(d)
    return F.dayofmonth(F.date_sub(F.make_date(F.year(d), F.lit(3), F.lit(1)), 1)) == 29


def yyyymmdd(d: Column | str) -> Column:
    """Date -> number yyyyMMdd."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def timestamp_to_epoch(ts: Column | str) -> Column:
    """Wall-clock timestamp read as UTC -> UNIX seconds (sub-second part
    dropped).

    Built from the calendar day and the time-of-day fields of the value cast
    to ``timestamp_ntz``, so a naive timestamp gives the same seconds under
    every session time zone.
    """
    t = _c(ts).cast("timestamp_ntz")
    return (F.unix_date(F.to_date(t)).cast("bigint") * SECONDS_PER_DAY
            + F.hour(t) * 3600 + F.minute(t) * 60 + F.floor(F.second(t)).cast("bigint"))
