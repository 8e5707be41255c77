"""A Merkle manifest of a dataset: a leaf per row, a tree per group, a tree
over the groups, and every leaf's proof, by butterfly exchange."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

_STEP = "struct<place int, siblings array<string>>"


def _hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields' concatenation: ``-`` for a null,
    else the value's UTF-8 byte count, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return _hashed(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def group_key(group: Column) -> Column:
    """A text that orders as the groups do, null first, bytewise after it."""
    return F.coalesce(F.concat(F.lit("s"), group.cast("string")), F.lit("n"))


def fold(leaf: str, proof, fanout_hash=hashlib.sha256) -> str:
    """The root that a leaf and its proof, (place, siblings) by level, give."""
    node = leaf
    for place, siblings in proof:
        node = fanout_hash("".join([*siblings[:place], node, *siblings[place:]]).encode()).hexdigest()
    return node


def _levels(nodes: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The nodes of a block, level by level: ``levels`` of them above the
    leaves, or up to a single node where that is None."""
    out = [nodes]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([hashlib.sha256("".join(below[i : i + fanout]).encode()).hexdigest() for i in range(0, len(below), fanout)])
    return out


def _positions(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` with ``position``, gapless from 0 within ``grp`` in the given
    order (then by leaf, then as stored), and ``total``, the group's rows: a
    range sort, with counts of earlier partitions added."""
    sort = ["grp", *[F.col(c).asc_nulls_first() for c in order], "leaf", "row"]
    at = F.monotonically_increasing_id()
    ordered = stored(leaves.orderBy(*sort).select("*", F.spark_partition_id().alias("part"), at.alias("at")), "merkle-ordered")
    runs = ordered.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("least"))
    by_part = Window.partitionBy("grp").orderBy("part")
    runs = runs.select(F.col("grp").alias("g"), F.col("part").alias("p"), (F.sum("rows").over(by_part) - F.col("rows") - F.col("least")).alias("shift"),
                       F.sum("rows").over(Window.partitionBy("grp")).alias("total"))
    return ordered.join(runs, (F.col("grp") == F.col("g")) & (F.col("part") == F.col("p"))).withColumn(
        "position", F.col("at") + F.col("shift")).drop("g", "p", "shift", "part", "at", "row")


def _exchange(state: DataFrame, fanout: int, reach: int) -> DataFrame:
    """One round: in every aligned group, ``fanout`` blocks of a tree whose
    numbers differ in one digit swap their subtree roots, and each hashes the
    parent itself and notes its siblings."""
    digit = (F.floor(F.col("block") / reach) % fanout).cast("int")
    ring = F.array_sort(F.collect_list(F.struct(digit.alias("digit"), "block", "node", "proof"))).alias("ring")
    swapped = state.groupBy("grp", "blocks", (F.col("block") - digit * reach).alias("first")).agg(ring)
    there = F.filter("ring", lambda m: m["node"].isNotNull())
    nodes = F.transform("there", lambda m: m["node"])
    me = F.col("me")
    siblings = F.transform(F.filter("there", lambda m: m["digit"] != me["digit"]), lambda m: m["node"])
    step = F.array(F.struct(me["digit"].alias("place"), siblings.alias("siblings")))
    return (swapped.withColumn("there", there).select("grp", "blocks", F.col("there"), F.explode("ring").alias("me"))
            .select("grp", "blocks", me["block"].alias("block"), F.when(F.size("there") > 0, _hashed(F.array_join(nodes, ""))).alias("node"),
                    F.concat(me["proof"], step).alias("proof")))


def _block_proofs(roots: DataFrame, fanout: int) -> DataFrame:
    """grp, block, node (the tree's root) and proof of every block of the
    trees whose block roots ``roots`` holds (grp, blocks, block, node).

    Block numbers are padded to a power of the fanout with blocks without a
    node, at most ``fanout`` times as many, so that every group of a round is
    whole. A round is one shuffle of a small row per block, written before
    the next; there is no downward pass."""
    most = roots.agg(F.max("blocks")).first()[0] or 0
    rounds = 0
    while fanout ** rounds < most:
        rounds += 1
    width = F.lit(1).cast("long")  # the least power of the fanout that holds a tree's blocks
    for r in range(rounds):
        width = F.when(F.col("blocks") > fanout ** r, F.lit(fanout ** (r + 1)).cast("long")).otherwise(width)
    numbers = roots.filter("block = 0").select("grp", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), width - 1)).alias("block"))
    state = numbers.join(roots.drop("blocks"), ["grp", "block"], "left").select(
        "grp", "blocks", "block", "node", F.array().cast(f"array<{_STEP}>").alias("proof"))
    for r in range(rounds):
        state = stored(state, "merkle-round")
        larger = F.col("blocks") > fanout ** r
        state = _exchange(state.filter(larger), fanout, fanout ** r).unionByName(state.filter(~larger))
    return stored(state.filter("block < blocks"), "merkle-blocks")


def _tree(leaves: DataFrame, order: Sequence[str], fanout: int, block_levels: int) -> tuple[DataFrame, DataFrame]:
    """Leaves with grp, block, position and total; and grp, block, node and
    proof of their blocks of ``fanout ** block_levels`` leaves."""
    width = fanout ** block_levels
    placed = stored(_positions(leaves, order).withColumn("block", F.floor(F.col("position") / width)), "merkle-leaves")

    def root(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        total = table.column("total")[0].as_py()
        top = _levels(table.column("leaf").to_pylist(), fanout, block_levels if total > width else None)[-1][0]
        return pa.table({"grp": table.column("grp")[:1].cast(pa.string()), "blocks": pa.array([-(-total // width)], pa.int64()),
                         "block": table.column("block")[:1], "node": pa.array([top])})

    roots = placed.select("grp", "block", "position", "total", "leaf").groupBy("grp", "block").applyInArrow(
        root, "grp string, blocks long, block long, node string")
    return placed, _block_proofs(stored(roots, "merkle-roots"), fanout)


def _own_steps(levels: list[list[str]], fanout: int, index: int):
    """(place, siblings) of a leaf at each level inside its block."""
    for below in levels[:-1]:
        run = index // fanout * fanout
        some, place = below[run : run + fanout], index - run
        yield place, some[:place] + some[place + 1 :]
        index //= fanout


def _proven(placed: DataFrame, blocks: DataFrame, keep: Sequence[str], fanout: int, block_levels: int, with_proof: bool) -> DataFrame:
    """Leaves with subroot, root, proof_sha256 and folded_root (of ``other``,
    the leaf to check), and ``proof`` where asked: the block's upper proof
    (``blocks``: grp, block, node, proof, root) joins the levels that its
    leaves hash again."""
    width = fanout ** block_levels
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.select(*keep).schema.fields)
    schema += ", grp string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    schema += f", proof array<{_STEP}>" if with_proof else ""
    proof_type = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))

    def prove(leaves: pa.Table, upper: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("position")
        total, top = leaves.column("total")[0].as_py(), upper.to_pylist()[0]
        nodes = leaves.column("leaf").to_pylist()
        levels = _levels(nodes, fanout, block_levels if total > width else None)
        above = [(s["place"], s["siblings"]) for s in top["proof"]]
        above_text = "".join("".join(s) for _, s in above)
        digests, folded, proofs = [], [], []
        for index, other in enumerate(leaves.column("other").to_pylist()):
            own = list(_own_steps(levels, fanout, index))
            digests.append(hashlib.sha256(("".join("".join(s) for _, s in own) + above_text).encode()).hexdigest())
            folded.append(fold(other, own + above))
            if with_proof:
                proofs.append([{"place": p, "siblings": s} for p, s in own + above])
        n = len(nodes)
        out = {c: leaves.column(c) for c in keep}
        out |= {"grp": leaves.column("grp"), "leaf": leaves.column("leaf"), "subroot": pa.array([top["node"]] * n, pa.string()),
                "root": pa.array([top["root"]] * n, pa.string()), "proof_sha256": pa.array(digests, pa.string()), "folded_root": pa.array(folded, pa.string())}
        if with_proof:
            out["proof"] = pa.array(proofs, proof_type)
        return pa.table(out)

    groups = placed.groupBy("grp", "block").cogroup(blocks.groupBy("grp", "block"))
    return groups.applyInArrow(prove, schema)


def manifest(docs: DataFrame, fields: Sequence[str], group: str = "source", order: str = "doc_id", changed: Mapping[str, Column] | None = None,
             fanout: int = 3, block_levels: int = 6, with_proof: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``order``, leaf, subroot (of its group's
    tree), root (over the subroots, ordered by group, null first, bytewise),
    proof_sha256 (of the siblings, level by level, left to right), folded_root
    (recomputed from the row's copy and its siblings) and verified. ``changed``
    gives the columns of the copy that differ; ``with_proof`` adds the proof.

    Leaves of a group ascend by ``order``, nulls first; rows with equal ids by
    their leaf, and rows equal in all fields have proofs of their own. Every
    ``fanout`` consecutive nodes (fewer at the end, even one) become one until
    one is left; a lone leaf is its group's subroot, and a lone subroot the
    root. Nulls and empty texts have different leaves. An empty table has no
    rows; columns that are not named are not read.

    Blocks of ``fanout ** block_levels`` consecutive leaves hash their own
    subtree in one task; the upper levels come from rounds in which blocks swap
    subtree roots. A group that holds most rows is just many blocks.
    """
    leaf = leaf_hash([F.col(f) for f in fields])
    other = leaf_hash([(changed or {}).get(f, F.col(f)) for f in fields]) if changed else leaf
    rows = stored(docs.select(group_key(F.col(group)).alias("grp"), F.col(order).alias("key"), leaf.alias("leaf"), other.alias("other"),
                              F.monotonically_increasing_id().alias("row")), "merkle-rows")
    placed, blocks = _tree(rows, ["key"], fanout, block_levels)

    tops = blocks.filter("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("of"), F.col("node").alias("leaf"), F.col("node").alias("other"), F.lit(0).alias("row"))
    top_placed, top_blocks = _tree(tops, ["of"], fanout, block_levels)
    top = _proven(top_placed, top_blocks.withColumn("root", F.col("node")), ["of"], fanout, block_levels, True)
    top = stored(top.select("of", "root", F.col("proof").alias("top_proof")), "merkle-top")
    upper = blocks.join(top, F.col("grp") == F.col("of")).select("grp", "block", "node", F.concat("proof", "top_proof").alias("proof"), "root")
    proven = _proven(placed, upper, ["key"], fanout, block_levels, with_proof).withColumnRenamed("key", order)
    shown = [order, "leaf", "subroot", "root", "proof_sha256", "folded_root"] + (["proof"] if with_proof else [])
    return proven.select(*shown, (F.col("folded_root") == F.col("root")).alias("verified"))
