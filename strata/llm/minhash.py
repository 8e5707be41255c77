"""MinHash near-duplicates: one-permutation hashing, densified, in banded
buckets with star-shaped candidate edges."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.components import connected_components
from strata.session import broadcast_if_small

_WORD_TURN, _KEY_TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PROBES = 4096


@dataclass(frozen=True)
class Banding:
    """Parameters of a match. A link has 100 * common >= ``percent`` * union of
    the two sets of ``shingle_words``-word shingles. Sets at the threshold miss
    each other in all ``bands`` of ``rows`` bins with probability
    (1 - (percent / 100) ^ rows) ^ bands: 2.4e-7 by default, 1e-12 at 0.9.
    In buckets of up to ``pairwise_bucket`` sets, what stars leave open is
    compared pair by pair; larger ones go through their rarest shingles, which
    gives the same links."""

    shingle_words: int = 5
    percent: int = 85
    bands: int = 48
    rows: int = 8
    pairwise_bucket: int = 32

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def shingle_set(text: str | None, shingle_words: int = 5) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a whole text's word shingles. A-Z is
    folded, words are separated by ASCII white space; fewer words than a
    shingle make one shingle; no words give an empty set."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in words], np.uint64)
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    mixed = np.full(n, k, np.uint64)
    for at in range(k):
        mixed = (mixed ^ hashes[at : at + n]) * _WORD_TURN
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


@lru_cache(maxsize=4)
def _probes(bins: int) -> np.ndarray:
    """The bins that bin i asks in turn for a value while they are empty."""
    return np.random.Generator(np.random.PCG64(bins)).integers(0, bins, (_PROBES, bins), dtype=np.int64)


def one_permutation(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The least hash of each of ``bins`` equal ranges of one permutation.
    Empty bins are densified optimally: each draws bins at random, by a fixed
    sequence of its own, until one was filled by the set itself."""
    of = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)  # ascends with the hashes
    first = np.flatnonzero(np.diff(of, prepend=-1))
    least, filled = np.full(bins, hashes[0], np.uint64), np.zeros(bins, bool)
    least[of[first]], filled[of[first]] = hashes[first], True
    probes, empty, at = _probes(bins), np.flatnonzero(~filled), 0
    while len(empty) and at < _PROBES:
        asked = probes[at : at + 64, empty]
        found = filled[asked]
        hit = found.any(axis=0)
        least[empty[hit]] = least[asked[found.argmax(axis=0), np.arange(len(empty))][hit]]
        empty, at = empty[~hit], at + 64
    return least


def band_keys(hashes: np.ndarray, how: Banding) -> np.ndarray:
    """One signed 64-bit key per band. A set so small that one shingle more or
    less breaks a link has no keys: it is like its equals only."""
    if 100 * len(hashes) < how.percent * (len(hashes) + 1):
        return np.empty(0, np.int64)
    least = one_permutation(hashes, how.bins).reshape(how.bands, how.rows)
    keys = np.arange(1, how.bands + 1, dtype=np.uint64) * _KEY_TURN
    for row in range(how.rows):
        keys = (keys ^ least[:, row]) * _WORD_TURN
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def sketches(docs: DataFrame, how: Banding, id_col: str, text_col: str) -> DataFrame:
    """id, text_hash, n_shingles, set_id (XXH64 of the set's hashes; null for
    an empty set) and keys (one per band) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sizes, ids, keys = [], [], []
            for text in batch.column(2):
                found = shingle_set(text.as_py(), how.shingle_words)
                sizes.append(len(found))
                ids.append(int(np.uint64(xxhash.xxh64_intdigest(found.tobytes())).view(np.int64)) if len(found) else None)
                keys.append(band_keys(found, how))
            ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *keys])))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), lists],
                                  names=["id", "text_hash", "n_shingles", "set_id", "keys"])

    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, text_hash long, n_shingles long, set_id long, keys array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, how: Banding, id_col: str, text_col: str) -> DataFrame:
    """set_id, n and hashes of the sets in ``wanted``, taken again from the
    text of one document each: sets of all documents would outweigh the texts."""
    def run(batches):
        for batch in batches:
            found = [shingle_set(t.as_py(), how.shingle_words).view(np.int64) for t in batch.column(1)]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            yield pa.record_batch([batch.column(0), pa.array([len(f) for f in found], pa.int64()),
                                   pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *found])))],
                                  names=["set_id", "n", "hashes"])

    rows = docs.select(F.col(id_col).alias("id2"), F.xxhash64(text_col).alias("hash2"), F.col(text_col).alias("text"))
    wanted = broadcast_if_small(wanted)  # beyond that bound texts are shuffled, once
    rows = rows.join(wanted, F.col("id2").eqNullSafe(F.col("id")) & (F.col("hash2") == F.col("text_hash"))).select("set_id", "text")
    sets = rows.mapInArrow(run, "set_id long, n long, hashes array<long>")
    return stored(sets.groupBy("set_id").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes")), "minhash-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, how: Banding) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity. A centre with
    many pairs is a skewed join key, which the skew-join rule splits."""
    side = lambda c: sets.select(F.col("set_id").alias(c), F.col("hashes").alias(f"h{c}"), F.col("n").alias(f"n{c}"))
    small = pairs.join(side("b"), "b").join(side("a"), "a").filter(_sized(F.col("na"), F.col("nb"), how))
    common = F.size(F.array_intersect("ha", "hb"))
    return small.select("a", "b", "na", "nb", common.alias("common")).filter(
        100 * F.col("common") >= how.percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _sized(na: Column, nb: Column, how: Banding) -> Column:
    return 100 * F.least(na, nb) >= how.percent * F.greatest(na, nb)


def _by_rarest(crowd: DataFrame, sets: DataFrame, how: Banding) -> DataFrame:
    """Candidate pairs (a, b) of different parts among ``crowd`` (id, part).

    In any common order, here from the rarest on, sets that reach the
    similarity share one of their first n - ceil(similarity n) + 1 shingles;
    and from the first shared one on, enough must be left for the overlap that
    their sizes ask for. No pair of the crowd that is a link is lost."""
    theta = how.percent / 100
    spread = crowd.join(sets, crowd["id"] == sets["set_id"]).select("id", "part", "n", F.explode("hashes").alias("h"))
    counts = spread.groupBy("h").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("sets", F.lit(1)), "h"))
    first = spread.join(counts, "h", "left").withColumn("place", place).filter(
        F.col("sets").isNotNull() & (F.col("place") <= F.col("n") - F.ceil(F.col("n") * theta - 1e-9) + 1))
    first = stored(first.select("h", "id", "part", "n", "place"), "minhash-prefixes")
    side = lambda s: first.select("h", *[F.col(c).alias(f"{c}{s}") for c in ("id", "part", "n", "place")])
    left = 1 + F.least(F.col("na") - F.col("placea"), F.col("nb") - F.col("placeb"))
    enough = left * (100 + how.percent) >= how.percent * (F.col("na") + F.col("nb"))
    return (side("a").join(side("b"), "h").filter((F.col("ida") < F.col("idb")) & (F.col("parta") != F.col("partb")) & enough
                                                  & _sized(F.col("na"), F.col("nb"), how))
            .select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct())


def links(members: DataFrame, sets: DataFrame, how: Banding) -> DataFrame:
    """Confirmed edges (a, b) with the components of all links between sets
    that share a bucket. ``members`` has key, size (of the bucket) and id.

    Every bucket first gives a star: its members are compared with one centre,
    the member that meets most others over all buckets, so that the buckets of
    one group of copies choose the same centre and candidates stay linear in
    the members. Then only sets whose parts the confirmed stars left apart are
    compared: pair by pair in small buckets, over their rarest shingles in
    larger ones.
    """
    degrees = members.groupBy("id").agg(F.sum("size").alias("degree"))
    centres = members.join(degrees, "id").groupBy("key").agg(F.max(F.struct("degree", "id")).alias("top")).select("key", F.col("top.id").alias("centre"))
    stars = members.join(centres, "key").filter("id != centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    found = stored(_confirmed(stars, sets, how), "minhash-stars")

    roots = connected_components(found, "minhash-edges")
    placed = members.join(roots, F.col("id") == F.col("node"), "left").select("key", "size", "id", F.coalesce("root", "id").alias("part"))
    placed = stored(placed, "minhash-parts")
    mixed = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("key")
    open_ = stored(placed.join(mixed, "key"), "minhash-open")
    small = open_.filter(F.col("size") <= how.pairwise_bucket).select("key", "id", "part")
    other = small.select("key", F.col("id").alias("b"), F.col("part").alias("part_b"))
    pairs = small.join(other, "key").filter((F.col("id") < F.col("b")) & (F.col("part") != F.col("part_b"))).select(F.col("id").alias("a"), "b").distinct()
    edges = found.union(_confirmed(pairs, sets, how))
    crowd = open_.filter(F.col("size") > how.pairwise_bucket).select("id", "part").distinct()
    if crowd.limit(1).count():
        edges = edges.union(_confirmed(_by_rarest(crowd, sets, how), sets, how))
    return edges


def near_duplicates(docs: DataFrame, how: Banding = Banding(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, text_hash, n_shingles,
    component_id (the least id reachable over links, its own included) and
    ``kept`` (whether its id is that one).

    Equal sets are one node however many documents have them, so groups of
    copies cost one row each. Null and empty texts, and texts of white space
    only, have no shingles and are linked with nothing. Null ids are members,
    but never a component's id while another is there; a row whose component
    has none is kept. Rows with equal ids are judged by their own texts. Other
    columns are ignored; an empty table gives no rows. Sets are told apart by
    64-bit hashes of their contents: among 10^9 distinct sets two share one
    with odds of about 1 in 40.
    """
    prints = stored(sketches(docs, how, id_col, text_col), "minhash-prints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("k")
    nodes = stored(prints.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(first, F.first("keys").alias("keys")), "minhash-nodes")
    placed = nodes.select(F.col("set_id").alias("id"), F.explode("keys").alias("key"))
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(placed.join(sizes, "key"), "minhash-members")
    wanted = nodes.join(members.select(F.col("id").alias("set_id")).distinct(), "set_id", "left_semi").select("set_id", "k.id", "k.text_hash")
    sets = _full_sets(docs, stored(wanted, "minhash-wanted"), how, id_col, text_col)

    roots = connected_components(links(members, sets, how), "minhash-links")
    of = nodes.select("set_id", "k.id").join(roots, F.col("set_id") == F.col("node"), "left").select("set_id", "id", F.coalesce("root", "set_id").alias("root"))
    of = stored(of, "minhash-of")
    ids = of.groupBy("root").agg(F.min("id").alias("component"))
    of = of.join(ids, "root").select(F.col("set_id").alias("of"), "component")
    component = F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("component"))
    return (prints.drop("keys").join(of, F.col("set_id") == F.col("of"), "left").withColumn("component_id", component)
            .select(F.col("id").alias(id_col), "text_hash", "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))
