"""Names compared as the BI tool compares them: ignoring case.

Spark compares text by code point unless told otherwise. A collation such as
``UNICODE_CI`` makes ``Alpha`` and ``ALPHA`` one name; accents still tell
names apart. What is shown for such a group is its first spelling in
code-point order, so results do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ignores case and keeps accents apart.
IGNORE_CASE = "UNICODE_CI"
PLAIN = "UTF8_BINARY"


def collated(c: str | Column, collation: str | None) -> Column:
    """``c`` as it compares under ``collation``; unchanged without one."""
    c = F.col(c) if isinstance(c, str) else c
    return c if collation is None else F.collate(c, collation)


def plain(c: str | Column) -> Column:
    """``c`` as an ordinary string again."""
    return F.collate(F.col(c) if isinstance(c, str) else c, PLAIN)


def group_by_name(df: DataFrame, name: str, aggs: Mapping[str, Column], collation: str | None = None) -> DataFrame:
    """``df`` aggregated by ``name``; under a collation, names that it calls
    equal are one group, shown by their first spelling."""
    columns = [c.alias(n) for n, c in aggs.items()]
    if collation is None:
        return df.groupBy(name).agg(*columns)
    grouped = df.withColumn("__name", collated(name, collation)).groupBy("__name").agg(F.min(name).alias(name), *columns)
    return grouped.drop("__name")


def name_order(name: str, collation: str | None) -> list[Column]:
    """Sort keys of a visual that orders by ``name``: as collated, then by
    code point, so that the order is total."""
    return [F.col(name)] if collation is None else [collated(name, collation), F.col(name)]
