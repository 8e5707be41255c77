"""Mixing sources to target weights by cube-method balanced sampling.

A source's target divided by its size is the expected number of copies of each
of its units. Whole copies are certain; the fractional rest is an inclusion
probability. The flight phase of the cube method turns these into 0 or 1 while
the expected totals of words and of documents stay exactly as they are; it runs
in small blocks, gathers the one or two undecided units of each, and repeats
until a source has so few left that the landing phase can settle them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import SPACE_WORD, bucket_count, stored

#: Units that one flight works on at a time: few enough that a source with most
#: of a small table's units is dealt to many tasks, and many enough that the one
#: or two undecided units of each block leave little to later rounds.
UNITS_A_BLOCK = 2_000
#: Units of a source that wait for its landing phase.
LANDING_UNITS = 12
#: Probabilities this close to 0 or 1 are that.
EPSILON = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their ``position`` (from 0) by code point, null last. A
    range sort ranks inside partitions; the offsets have a row per partition."""
    by = [F.col("source").asc_nulls_last()]
    ordered = stored(sources.orderBy(*by).withColumn("_part", F.spark_partition_id()), "mix-sources")
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*by))
    return ordered.withColumn("_row", inside).join(F.broadcast(offsets), "_part").withColumn(
        "position", F.col("_offset") + F.col("_row") - 1).drop("_part", "_row", "_offset")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source``, source_size, source_units and ``target``.

    ``sizes`` has columns source, size and units (one row per unit or group of
    units). Sources in order of their names, null last, weigh ``weights``,
    repeating. They share ``share`` times all sizes by weight; a target stops
    at ``most`` times its source's size and the excess is shared anew by
    weight among the others until none is above. Each round of that is one
    aggregate over the per-source table; two numbers reach the driver.
    """
    per_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("units")).alias("source_size"),
                                             F.sum("units").alias("source_units"))
    repeating = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                             (F.pmod("position", F.lit(len(weights))) + 1).cast("int"))
    table = stored(_ranked(per_source).withColumn("weight", repeating), "mix-weights")
    total = share * float(table.agg(F.sum("source_size")).first()[0] or 0)
    ceiling = F.lit(float(most)) * F.col("source_size")
    rate, before, exact = 0.0, None, "decimal(38,6)"  # sums that don't depend on the order of rows
    while True:
        full = F.lit(rate) * F.col("weight") > ceiling
        capped, n, free = table.agg(F.sum(F.when(full, ceiling).otherwise(0.0).cast(exact)), F.count(F.when(full, 1)),
                                    F.sum(F.when(full, 0.0).otherwise(F.col("weight")).cast(exact))).first()
        if n == before or not free:  # every round caps a source more, or ends
            break
        before, rate = n, (total - float(capped)) / float(free)
    return table.select("source", "source_size", "source_units", F.least(F.lit(rate) * F.col("weight"), ceiling).alias("target"))


def flight(p: np.ndarray, x: np.ndarray, draws: np.random.Generator) -> np.ndarray:
    """Flight phase with two constraints: the sums of p and of x * p stay.

    Three undecided units have, under two constraints, a one-dimensional
    null-space: the direction (x2 - x3, x3 - x1, x1 - x2). Moving along it, by
    a random one of the two steps that decide a unit, with odds that keep each
    expectation, decides at least one. Two units of equal x are settled by
    one constraint's direction (1, -1). At most two units stay undecided.
    """
    p = p.copy()
    held: list[int] = []
    u = draws.random(len(p) + 8)
    used = 0
    values, sizes = p.tolist(), x.tolist()

    def move(units, direction):
        nonlocal used
        up = min((1 - values[i]) / d if d > 0 else values[i] / -d for i, d in zip(units, direction) if d)
        down = min(values[i] / d if d > 0 else (1 - values[i]) / -d for i, d in zip(units, direction) if d)
        step = up if u[used % len(u)] * (up + down) < down else -down
        used += 1
        for i, d in zip(units, direction):
            values[i] = min(1.0, max(0.0, values[i] + step * d))
            if values[i] < EPSILON or values[i] > 1 - EPSILON:
                values[i] = float(round(values[i]))
        return [i for i in units if 0 < values[i] < 1]

    for i in range(len(values)):
        if not 0 < values[i] < 1:
            continue
        held.append(i)
        while len(held) == 3 or len(held) == 2 and sizes[held[0]] == sizes[held[1]]:
            a, b = sizes[held[0]], sizes[held[1]]
            if len(held) == 2:
                direction = (1.0, -1.0)
            else:
                c = sizes[held[2]]
                direction = (b - c, c - a, a - b)
                if not any(direction):
                    direction = (1.0, -1.0, 0.0)
                scale = max(map(abs, direction))
                direction = tuple(d / scale for d in direction)
            held = move(held, direction)
    return np.array(values)


def settle(p: np.ndarray, x: np.ndarray, draws: np.random.Generator) -> np.ndarray:
    """Flight, then landing, for all units of a source that are left.

    ``LANDING_UNITS`` units of evenly spread rank by size wait while the
    others fly; with the one or two that stay undecided they are the landing
    problem: of all choices of 0 or 1 the one whose word total is nearest the
    expected one (of equals, whose count is).
    """
    open_ = np.flatnonzero((p > 0) & (p < 1))
    by_size = open_[np.argsort(x[open_], kind="stable")]
    waiting = by_size[np.unique(np.linspace(0, len(by_size) - 1, min(LANDING_UNITS, len(by_size))).astype(int))] if len(by_size) else by_size
    flying = np.setdiff1d(open_, waiting)
    out = p.copy()
    out[flying] = flight(p[flying], x[flying], draws)
    left = np.flatnonzero((out > 0) & (out < 1))
    choices = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    words = np.abs(choices @ x[left] - out[left] @ x[left]).round(6)
    count = np.abs(choices.sum(axis=1) - out[left].sum()).round(6)
    out[left] = choices[np.lexsort((count, words))[0]]
    return out


def _flight_of_block(keys: list[str], seed: int, round_: int, last: bool):
    def run(key, table):
        table = table.sort_by([("_key", "ascending"), *[(k, "ascending") for k in keys]])
        x = table["size"].to_numpy().astype(float)
        first = table["_key"][0].as_py() & 0xFFFFFFFFFFFFFFFF
        work = settle if last else flight
        p = work(table["p"].to_numpy(), x, np.random.default_rng([seed, round_, first]))
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p))

    return run


def balanced_copies(units: DataFrame, targets: DataFrame, keys: list[str], seed: int = 7,
                    units_a_block: int = UNITS_A_BLOCK) -> DataFrame:
    """``units`` with ``source_size``, ``target`` and ``copies`` of each unit.

    ``units`` has ``keys`` (they tell units apart), source, size and units (how
    many equal rows it stands for; they share the copies). The draws depend on
    the seed and the keys alone, so reruns agree whatever the partitioning.
    Rounds are written to the shared folder; each leaves at most two undecided
    units per block, and the last has one block per source.
    """
    joined = units.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = ratio * F.col("units")
    certain = F.floor(copies + EPSILON)
    rest = F.when(copies - certain < EPSILON, 0.0).otherwise(copies - certain)
    state = joined.withColumn("copies", certain.cast("long")).withColumn("p", rest).withColumn("_key", F.xxhash64(*keys))
    blocked = T.StructType([*state.schema.fields, T.StructField("_block", T.LongType())])
    state = stored(state, "mix-units")
    done = state.filter("p = 0 or p = 1")
    left = state.filter("p > 0 and p < 1")
    round_ = 0
    while True:
        most = left.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        if not most:
            break
        blocks = bucket_count(most, units_a_block)
        block = F.pmod(F.xxhash64("_key", F.lit(round_)), F.lit(blocks))
        flown = left.withColumn("_block", block).groupBy("source", "_block").applyInArrow(
            _flight_of_block(keys, seed, round_, blocks == 1), blocked)
        flown = stored(flown.drop("_block"), "mix-round")
        done = done.unionByName(flown.filter("p = 0 or p = 1"))
        left = flown.filter("p > 0 and p < 1")
        round_ += 1
    return done.withColumn("copies", F.col("copies") + F.col("p").cast("long")).drop("p", "_key")


def mix_units(units: DataFrame, keys: list[str], weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
              most: float = 2.0) -> DataFrame:
    """Targets and balanced copies for ``units`` (see :func:`balanced_copies`)."""
    units = stored(units, "mix-input")
    return balanced_copies(units, source_targets(units, weights, share, most), keys)


def mix_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
                  id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each repeated as often as the mix takes it.

    All columns stay. Size is the number of words; null and empty texts have
    none and take part like other rows. A null source is a source, the last
    one. Rows equal in id, text and source are one unit that shares its copies
    evenly; an empty table stays empty.
    """
    keyed = docs.withColumn("__s_text_hash", F.xxhash64(text_col))
    units = (keyed.select(F.col(id_col).alias("__s_id"), F.col("__s_text_hash").alias("__s_hash"), F.col(source_col).alias("source"),
                          word_count(F.col(text_col)).alias("size"))
             .groupBy("__s_id", "__s_hash", "source", "size").agg(F.count(F.lit(1)).alias("units")))
    taken = mix_units(units, ["__s_id", "__s_hash"], weights, share, most).select(
        "__s_id", "__s_hash", F.col("source").alias("__s_source"), F.col("units").alias("__s_units"), F.col("copies").alias("__s_copies"))
    taken = stored(taken.filter("__s_copies > 0"), "mix-taken")

    def matched(of: DataFrame) -> DataFrame:
        return keyed.join(of, keyed[id_col].eqNullSafe(of["__s_id"]) & (keyed["__s_text_hash"] == of["__s_hash"])
                          & keyed[source_col].eqNullSafe(of["__s_source"]))

    times, rows = F.col("__s_copies"), F.col("__s_units")
    out = matched(taken.filter(rows == 1)).withColumn("__s_times", times)
    repeated = taken.filter(rows > 1)
    if repeated.limit(1).count():
        row = F.row_number().over(Window.partitionBy("__s_id", "__s_hash", "__s_source").orderBy(F.lit(0)))
        even = F.floor(times / rows) + F.when(row <= F.pmod(times, rows), 1).otherwise(0)
        out = out.unionByName(matched(repeated).withColumn("__s_times", even.cast("long")).filter("__s_times > 0"))
    return out.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__s_times"))).alias("__s_copy")).drop("__s_copy")
