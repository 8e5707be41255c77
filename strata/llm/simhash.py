"""SimHash near-duplicates by pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.components import connected_components

BITS = 64
#: Buckets of up to so many fingerprints are compared pair by pair; larger
#: ones go through their members' one-bit neighbours, which is exact too.
PAIRWISE_BUCKET = 32
#: Blocks that two fingerprints must share to meet.
BLOCKS_MET = 3


def fingerprint(text: str | None, shingle_words: int, seed: int = 42) -> int:
    """SimHash of a whole text: a bit is set if it is set in over half of the
    XXH64 hashes of the word shingles, repeats included. A-Z is folded; words
    are separated by ASCII white space; fewer words than a shingle make one
    shingle; no words give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed) for s in shingles], np.uint64)
    set_in = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a very long text
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(set_in * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, text_hash (XXH64 of the text) and the signed 64-bit
    ``fingerprint`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(2)], pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), prints], names=[id_col, "text_hash", "fingerprint"])

    return docs.select(id_col, F.xxhash64(text_col).alias("text_hash"), text_col).mapInArrow(
        run, f"`{id_col}` {kind}, text_hash long, fingerprint long")


def block_masks(max_distance: int) -> list[int]:
    """Masks of which two fingerprints within ``max_distance`` bits agree on at
    least one as a whole.

    The bits are split into max_distance + ``BLOCKS_MET`` blocks. Differing
    bits touch at most ``max_distance`` of them, so some ``BLOCKS_MET`` blocks
    are equal; each mask is one choice of so many. For two bits these are ten
    masks of about 38 bits: 10^8 unrelated fingerprints hardly ever meet, where
    single blocks of 21 bits would hold 48 of them each.
    """
    n = max_distance + BLOCKS_MET
    edges = [round(k * BITS / n) for k in range(n + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, BLOCKS_MET)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def close_pairs(prints: DataFrame, max_distance: int = 2, pairwise_bucket: int = PAIRWISE_BUCKET) -> DataFrame:
    """Edges (a, b) that connect distinct ``fingerprint`` values as their
    links of at most ``max_distance`` (0 to 2) bits do.

    Fingerprints meet in the buckets of their masks (:func:`block_masks`). In a bucket of up to
    ``pairwise_bucket`` members, pairs are joined and their distance is
    verified. The members of larger buckets (a big group of near copies) each
    send themselves to their 64 one-bit neighbours and to themselves: two are
    within two bits exactly if they meet at such a midpoint, where at most 65
    can meet, so the work stays linear in the group.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance must be 0, 1 or 2")
    blocks = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("bits"))
                       for i, m in enumerate(block_masks(max_distance))])
    placed = prints.select("fingerprint", F.explode(blocks).alias("k")).select("fingerprint", "k.block", "k.bits")
    sizes = placed.groupBy("block", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(placed.join(sizes, ["block", "bits"]), "simhash-blocks")
    left = shared.filter(F.col("n") <= pairwise_bucket).select("block", "bits", F.col("fingerprint").alias("a"))
    right = left.select("block", "bits", F.col("a").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    pairs = left.join(right, ["block", "bits"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")
    dense = shared.filter(F.col("n") > pairwise_bucket).select("fingerprint").distinct()
    flips = F.array(*[F.lit(_signed(1 << k)) for k in range(BITS)], F.lit(0).cast("long"))
    midpoints = (dense.select("fingerprint", F.explode(flips).alias("flip"))
                 .groupBy(F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("mid"))
                 .agg(F.collect_set("fingerprint").alias("members")).filter(F.size("members") > 1))
    centre = F.array_min("members") if max_distance == 2 else F.col("mid")
    if max_distance < 2:  # only neighbours of a fingerprint that is there itself
        midpoints = midpoints.filter(F.array_contains("members", F.col("mid")) & F.lit(max_distance == 1))
    stars = midpoints.select(centre.alias("a"), F.explode("members").alias("b")).filter(F.col("a") != F.col("b"))
    return pairs.union(stars)


def near_duplicates(prints: DataFrame, max_distance: int = 2, id_col: str = "doc_id") -> DataFrame:
    """``prints`` with component_id, the least ``id_col`` reachable over links
    of at most ``max_distance`` bits (itself included).

    Equal fingerprints are one node, so a group of exact copies costs one row
    however large it is. Null ids are members, but never a component's id
    while another is there. Texts without words share fingerprint 0. An empty
    table gives no rows. ``prints`` should be stored: it is read twice.
    """
    nodes = stored(prints.groupBy("fingerprint").agg(F.min(id_col).alias("_first")), "simhash-nodes")
    roots = connected_components(close_pairs(nodes.select("fingerprint"), max_distance), "simhash-edges")
    members = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "_first", F.coalesce("root", "fingerprint").alias("root"))
    least = members.groupBy("root").agg(F.min("_first").alias("component_id"))
    of = stored(members.join(least, "root").select("fingerprint", "root", "component_id"), "simhash-members")
    return prints.join(of, "fingerprint")


def deduplicate(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the
    least (id, text hash), null ids last; of rows equal in both, one. All
    columns are kept; null and empty texts are one group."""
    prints = stored(fingerprints(docs, shingle_words, id_col, text_col), "simhash-prints")
    found = near_duplicates(prints, max_distance, id_col)
    chosen = found.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                                                      F.col("text_hash").alias("hash"))).alias("k")).select("k.*")
    rows = prints.groupBy(F.col(id_col).alias("id2"), F.col("text_hash").alias("hash2")).agg(F.count(F.lit(1)).alias("rows"))
    chosen = chosen.join(rows, F.col("id").eqNullSafe(F.col("id2")) & (F.col("hash") == F.col("hash2")))
    chosen = stored(chosen.select(F.col("id").alias("__s_id"), F.col("hash").alias("__s_hash"), F.col("rows").alias("__s_rows")), "simhash-kept")
    keyed = docs.withColumn("__s_text_hash", F.xxhash64(text_col))

    def staying(of: DataFrame) -> DataFrame:
        return keyed.join(of, keyed[id_col].eqNullSafe(of["__s_id"]) & keyed["__s_text_hash"].eqNullSafe(of["__s_hash"]), "left_semi")

    once = staying(chosen.filter("__s_rows = 1"))
    repeated = chosen.filter("__s_rows > 1")
    if repeated.limit(1).count():
        once = once.union(staying(repeated).dropDuplicates([id_col, "__s_text_hash"]))
    return once.drop("__s_text_hash")
