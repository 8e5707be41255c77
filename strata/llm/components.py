"""Distributed union-find: connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import drop_stored, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def _star(arcs: DataFrame, keep) -> DataFrame:
    """Hang the arcs of every node u that pass ``keep`` under u's least
    neighbour (or u itself)."""
    least = arcs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return arcs.join(least, "u").filter(keep).select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node with an edge; ``root`` is the least node of
    its component. ``edges`` has columns a and b; direction, repeats and loops
    don't matter; no edges give no rows.

    Alternating large-star and small-star steps: each hangs neighbours under
    the least one, so a component ends as one star in a logarithmic number of
    rounds whatever its shape, and edges never outnumber the first ones by
    more than its nodes. Each round is written to the shared folder; only a
    count and a checksum reach the driver. A hub's neighbours are joined with
    one row, never gathered: the skew-join rule can split them.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges = stored(edges, name)
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            break
        before = state
        large = _star(_both_ways(edges), F.col("v") > F.col("u")).distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        # small star: every node and its smaller neighbours go under the least of them
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("m").alias("a"), F.col("v").alias("b")), F.struct(F.col("m").alias("a"), F.col("u").alias("b")))).alias("e"))
            .select("e.a", "e.b").filter("a < b").distinct())
        after = stored(small, name)
        drop_stored(edges)
        edges = after
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(edges.select("a", "a").distinct())
