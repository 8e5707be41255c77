"""Generated calendar dimension (S11 with F9-F19).

One row per day between two dates. Rows come from ``spark.range`` so the
generation itself is spread over partitions instead of exploding one big
array in a single task; every derived column is a built-in date function.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import scalars as S

# The calendar's default span and its column names, in the
# order the model defines them.
DEFAULT_START = dt.date(1990, 1, 1)
DEFAULT_END = dt.date(2030, 12, 31)
CALENDAR_COLUMNS = [
    "Date", "DateKey", "Year", "MonthNumber", "MonthName", "MonthShort", "Quarter",
    "QuarterName", "DayOfMonth", "DayOfWeekNumber", "DayOfWeekName", "DayOfWeekShort",
    "WeekOfYear", "DayOfYear", "YearMonth", "YearMonthName", "YearQuarter",
    "YearQuarterName", "IsWeekend", "IsWeekday", "IsLeapYear", "IsCurrentYear",
    "IsCurrentMonth", "IsCurrentQuarter", "IsPastDate", "IsFutureDate",
]
# The date hierarchy's levels, top to bottom.
DATE_HIERARCHY = ["Year", "QuarterName", "MonthName", "MonthShort", "Date"]


def _as_date(v) -> dt.date:
    return v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v))


def calendar_columns(date_col: str = "Date", as_of=None) -> dict:
    """The 25 derived calendar columns as expressions over ``date_col``.

    ``as_of`` pins "today" for the relative flags (repeatable tests); ``None``
    means ``current_date()``.
    """
    d = F.col(date_col)
    today = F.current_date() if as_of is None else F.lit(_as_date(as_of))
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    dow = S.weekday_monday1(d)
    return {
        "DateKey": S.yyyymmdd(d),
        "Year": year,
        "MonthNumber": month,
        "MonthName": F.date_format(d, "MMMM"),
        "MonthShort": F.date_format(d, "MMM"),
        "Quarter": quarter,
        "QuarterName": F.concat(F.lit("Q"), quarter.cast("string")),
        "DayOfMonth": F.dayofmonth(d),
        "DayOfWeekNumber": dow,
        "DayOfWeekName": F.date_format(d, "EEEE"),
        "DayOfWeekShort": F.date_format(d, "EEE"),
        "WeekOfYear": S.week_of_year_jan1(d),
        "DayOfYear": F.dayofyear(d),
        "YearMonth": year * 100 + month,
        "YearMonthName": F.date_format(d, "yyyy MMM"),
        "YearQuarter": year * 10 + quarter,
        "YearQuarterName": F.concat(F.date_format(d, "yyyy"), F.lit(" Q"), quarter.cast("string")),
        "IsWeekend": dow >= 6,
        "IsWeekday": dow < 6,
        "IsLeapYear": S.is_leap_year(d),
        "IsCurrentYear": year == F.year(today),
        "IsCurrentMonth": (year == F.year(today)) & (month == F.month(today)),
        "IsCurrentQuarter": (year == F.year(today)) & (quarter == F.quarter(today)),
        "IsPastDate": d < today,
        "IsFutureDate": d > today,
    }


def calendar(spark: SparkSession, start=DEFAULT_START, end=DEFAULT_END, as_of=None,
             num_partitions: int | None = None) -> DataFrame:
    """Calendar table from ``start`` to ``end`` inclusive.

    Its size is fixed by the two dates (about 365 rows a year), which is the
    proven bound that lets it be broadcast into a fact-to-date lookup.
    """
    start, end = _as_date(start), _as_date(end)
    days = (end - start).days + 1
    if days <= 0:
        raise ValueError("calendar end must not be before start")
    ids = spark.range(0, days, numPartitions=num_partitions) if num_partitions else spark.range(0, days)
    base = ids.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("Date"))
    return base.withColumns(calendar_columns("Date", as_of)).select(*CALENDAR_COLUMNS)


def calendar_days(start=DEFAULT_START, end=DEFAULT_END) -> int:
    return (_as_date(end) - _as_date(start)).days + 1
