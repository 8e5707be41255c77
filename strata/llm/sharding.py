"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import numbered

#: Hash bits that enter the logarithm: value + 1/2 is exact in a double, so u
#: is never 0 or 1.
HASH_BITS = 52


def rendezvous(key: Sequence[Column], weights: Sequence[float]) -> Column:
    """The shard whose score for ``key`` is highest.

    A shard's score is -weight / ln(u), u in (0, 1) from a hash of the key and
    the shard's number. It depends on no other shard, so a new shard takes
    only the records it wins, and a heavier weight wins in proportion. Ties go
    to the lower number; a null key is a key like any other.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one per shard")
    scores = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(shard)), 64 - HASH_BITS)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**HASH_BITS))
        scores.append(F.struct((F.lit(-float(weight)) / F.log(u)).alias("score"), F.lit(-shard).alias("shard")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["shard"]).cast("int")


def assign_shards(records: DataFrame, key: Sequence[str], n_shards: int, weights: Sequence[float] | None = None,
                  shard_col: str = "shard") -> DataFrame:
    """``records`` with ``shard_col`` added: a projection, no shuffle.

    All columns and rows stay; rows with equal keys (null included) share a
    shard; an empty table stays empty. A column already called ``shard_col``
    is replaced.
    """
    weights = list(weights) if weights is not None else [1.0] * n_shards
    if len(weights) != n_shards:
        raise ValueError("one weight per shard")
    return records.withColumn(shard_col, rendezvous([F.col(k) for k in key], weights))


def shard_slots(records: DataFrame, key: Sequence[str], n_shards: int) -> DataFrame:
    """``assign_shards`` plus ``grown_shard`` (with one shard more) and
    ``slot``, the record's gapless number within its shard. ``records`` should
    hold only the columns wanted in the result."""
    out = assign_shards(records, key, n_shards)
    out = assign_shards(out, key, n_shards + 1, shard_col="grown_shard")
    return numbered(out, "shard", list(key), "slot")
