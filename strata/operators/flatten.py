"""Lateral flatten of id arrays into bridge rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_bridge(df: DataFrame, id_col: str, array_col: str, out_col: str,
                   key_type: str | None = "bigint", id_alias: str | None = None) -> DataFrame:
    """One row per array element, next to the owning row's id.

    Semantics of a lateral flatten: a NULL or empty array yields no row, a NULL
    element yields a row with a NULL key, and repeated elements or repeated
    owner rows are all kept (no dedup). ``explode`` -- not ``explode_outer`` --
    has exactly this behaviour and runs inside the scan's stage, so flattening
    adds no shuffle.
    """
    arr = F.col(array_col)
    if key_type:
        arr = arr.cast(f"array<{key_type}>")
    return df.select(F.col(id_col).alias(id_alias or id_col), F.explode(arr).alias(out_col))
