"""Benchmark decontamination over a distributed positional inverted index.

The index is cut by documents: a segment holds the positions, in ascending
lists per term, of every occurrence of the test set's terms in some thousand
whole documents. Segments are written to the shared folder; each is searched
on its own, so no text is shuffled and a lost task searches its segment again.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ALNUM_WORD, ascii_lower, stored

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall
#: Words of a segment; a longer document is a segment of its own.
SEGMENT_WORDS = 2_000_000
#: Words of the test set that one pass over the corpus searches for. What is
#: sent to the tasks is counted first; a larger test set takes more passes.
#: (A pass holds one item at least.)
TEST_WORDS_A_PASS = 200_000
#: Empty places between two documents of a segment: no phrase or
#: neighbourhood reaches over them.
GAP = 1_000


def words_of(text: str | None) -> list[bytes]:
    """Words of ASCII digits, letters (A-Z folded) and anything beyond ASCII."""
    return _WORDS((text or "").encode("utf-8", "surrogatepass").lower())


def windows_of(words: list, size: int) -> list[tuple]:
    """Every run of ``size`` words; a shorter text, if not empty, is one."""
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class TestSet:
    """The distinct windows of some benchmark items, as numbers of terms."""

    __test__ = False

    def __init__(self, items: list[tuple], size: int):
        number: dict[bytes, int] = {}
        owners: dict[tuple, set] = {}
        for item, text in items:
            for w in windows_of(words_of(text), size):
                owners.setdefault(tuple(number.setdefault(x, len(number)) for x in w), set()).add(item)
        self.number = number
        self.owners = list(owners.values())
        self.lengths = np.array([len(w) for w in owners], np.int32)
        self.padded = np.full((len(owners), size), -1, np.int32)
        for i, w in enumerate(owners):
            self.padded[i, : len(w)] = w

    def window(self, i: int) -> np.ndarray:
        return self.padded[i, : self.lengths[i]]

    def rank(self, frequency: dict[int, int], rarest: int) -> None:
        """Choose what proximity is tested by, from how often the terms occur
        in the whole corpus: any ``rarest`` of the ``rarest`` + 1 rarest terms
        of each window, so one replaced word loses no window. Equal terms sets
        are held once, with all their items."""
        names = list(self.number)
        order = lambda t: (frequency.get(t, 0), names[t])
        groups: dict[tuple, set] = {}
        for i, owners in enumerate(self.owners):
            terms = sorted(set(self.window(i).tolist()), key=order)[: rarest + 1]
            if len(terms) >= rarest:
                for group in itertools.combinations(terms, rarest):
                    groups.setdefault(group, set()).update(owners)
        self.groups = np.array(list(groups), np.int32).reshape(len(groups), rarest)
        self.group_owners = list(groups.values())


def build_index(docs: DataFrame, terms: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Index segments: ids, text hashes and word counts of their documents in
    order, and for each term of ``terms`` that occurs one ascending list of positions."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        of = terms.get
        part, number = TaskContext.get().partitionId(), 0
        ids, hashes, counts, term_parts, position_parts, start = [], [], [], [], [], 0

        def segment():
            term, position = np.concatenate(term_parts), np.concatenate(position_parts)
            present, lengths = np.unique(term, return_counts=True)
            flat = position[np.argsort(term, kind="stable")].astype("<i8" if start > 2**31 - 1 else "<i4")
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), one(pa.concat_arrays(ids)),
                 one(pa.concat_arrays(hashes)), one(pa.array(counts, pa.int64())), one(pa.array(present.astype(np.int32))),
                 one(pa.array(lengths.astype(np.int64))), pa.array([flat.tobytes()], pa.binary()), pa.array([flat.itemsize], pa.int32())],
                names=["part", "number", "ids", "hashes", "counts", "terms", "lengths", "positions", "width"])

        for batch in batches:
            for i, text in enumerate(batch.column(2)):
                words = words_of(text.as_py())
                found = np.fromiter((of(w, -1) for w in words), np.int32, len(words))
                at = np.flatnonzero(found >= 0)
                ids.append(batch.column(0).slice(i, 1))
                hashes.append(batch.column(1).slice(i, 1))
                counts.append(len(words))
                term_parts.append(found[at])
                position_parts.append(at + start)
                start += len(words) + GAP
                if start >= SEGMENT_WORDS:
                    yield segment()
                    number += 1
                    ids, hashes, counts, term_parts, position_parts, start = [], [], [], [], [], 0
        if ids:
            yield segment()

    return docs.select(id_col, F.xxhash64(text_col).alias("hash"), text_col).mapInArrow(
        run, f"part int, number int, ids array<{kind}>, hashes array<long>, counts array<long>, terms array<int>, lengths array<long>, "
             "positions binary, width int")


class Segment:
    """One index segment, opened for searching."""

    def __init__(self, counts, terms, lengths, positions: bytes, width: int):
        self.counts = np.array(counts, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts + GAP)[:-1]]) if len(self.counts) else np.zeros(0, np.int64)
        flat = np.frombuffer(positions, f"<i{width}")
        ends = np.cumsum(lengths)
        self.lists = {t: flat[e - n : e] for t, n, e in zip(terms, lengths, ends)}

    def phrase(self, window: list[int]) -> np.ndarray:
        """Starts of ``window``: offset-adjusted lists, intersected from the
        rarest term on; stops as soon as nothing is left."""
        order = sorted(range(len(window)), key=lambda k: len(self.lists[window[k]]))
        starts = self.lists[window[order[0]]].astype(np.int64) - order[0]
        for k in order[1:]:
            if not len(starts):
                break
            with_term, wanted = self.lists[window[k]], starts + k
            at = np.searchsorted(with_term, wanted)
            at[at == len(with_term)] = 0
            starts = starts[with_term[at] == wanted]
        return starts

    def close_together(self, terms: list[int], within: int) -> np.ndarray:
        """Positions of the first of ``terms`` that have an occurrence of each
        of the others within ``within`` words."""
        near = self.lists[terms[0]].astype(np.int64)
        for t in terms[1:]:
            if not len(near):
                break
            other = self.lists[t]
            near = near[np.searchsorted(other, near + within, "right") > np.searchsorted(other, near - within, "left")]
        return near

    def docs_at(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1


def merged(spans: list[tuple]) -> list[dict]:
    """The union of half-open intervals, as disjoint intervals in order."""
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["first"] + out[-1]["words"]:
            out[-1]["words"] = max(out[-1]["words"], b - out[-1]["first"])
        else:
            out.append({"first": a, "words": b - a})
    return out


def search(index: DataFrame, tests: TestSet, rarest: int, within: int) -> DataFrame:
    """One row per indexed document: its word count, the merged word spans
    inside exact occurrences, the items they belong to, and the items of which
    ``rarest`` of a window's rarest terms (see :meth:`TestSet.rank`) lie within
    ``within`` words. Terms are ranked by one aggregate over the whole index:
    at most one row per term of the test set comes back."""
    kind = index.schema["ids"].dataType.elementType.simpleString()
    lengths = index.select(F.explode(F.arrays_zip("terms", "lengths")).alias("t")).groupBy("t.terms").agg(F.sum("t.lengths").alias("n"))
    tests.rank({r["terms"]: r["n"] for r in lengths.collect()}, rarest)

    def run(batches):
        lengths_of = np.zeros(len(tests.number) + 1, np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {k: batch.column(i)[at] for i, k in enumerate(batch.schema.names)}
                terms, lengths = np.array(row["terms"].values), np.array(row["lengths"].values)
                counts = np.array(row["counts"].values)
                seg = Segment(counts, terms.tolist(), lengths, row["positions"].as_py(), row["width"].as_py())
                lengths_of[:-1] = 0
                lengths_of[terms] = lengths
                lengths_of[-1] = 1  # the padding of a short window
                spans: list[list] = [[] for _ in counts]
                exact: list[set] = [set() for _ in counts]
                near: list[set] = [set() for _ in counts]
                for w in np.flatnonzero(lengths_of[tests.padded].min(axis=1) > 0):
                    window, owners = tests.window(w).tolist(), tests.owners[w]
                    starts = seg.phrase(window)
                    in_docs = seg.docs_at(starts)
                    for d, s in zip(in_docs.tolist(), (starts - seg.starts[in_docs]).tolist()):
                        spans[d].append((s, s + len(window)))
                        exact[d] |= owners
                for g in np.flatnonzero(lengths_of[tests.groups].min(axis=1) > 0):
                    for d in np.unique(seg.docs_at(seg.close_together(tests.groups[g].tolist(), within))).tolist():
                        near[d] |= tests.group_owners[g]
                n = len(counts)
                span = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
                names = pa.list_(pa.string())
                yield pa.record_batch(
                    [pa.array([row["part"].as_py()] * n, pa.int32()), pa.array([row["number"].as_py()] * n, pa.int32()),
                     pa.array(range(n), pa.int64()), row["ids"].values, row["hashes"].values, pa.array(counts),
                     pa.array([merged(x) for x in spans], span),
                     pa.array([sorted(x) for x in exact], names), pa.array([sorted(x) for x in near], names)],
                    names=["part", "number", "ordinal", "id", "text_hash", "n_words", "spans", "items", "near_items"])

    return index.mapInArrow(run, f"part int, number int, ordinal long, id {kind}, text_hash long, n_words long, "
                                 "spans array<struct<first: long, words: long>>, items array<string>, near_items array<string>")


def match_benchmark(docs: DataFrame, items: DataFrame, window: int = 10, rarest: int = 3, within: int = 30,
                    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", words_a_pass: int = TEST_WORDS_A_PASS) -> DataFrame:
    """One row per document: ``id_col``, text_hash, n_words, ``spans`` (disjoint word
    spans inside occurrences of a test window), ``items`` and ``near_items``
    (item ids as strings, sorted).

    A test window is ``window`` consecutive words of an item; an item of
    fewer words is one window. Null and empty texts have no words, nor do
    their items match anything; an item with a null id marks spans under the
    id "null". Repeated items or documents are handled each. An empty test set
    or table gives no matches or rows. Other columns are ignored. Nothing is
    shuffled in a single pass; passes are merged by document position.
    """
    n_words = F.coalesce(F.regexp_count(ascii_lower(F.col(item_text_col)), F.lit(ALNUM_WORD)), F.lit(0))
    test_words = items.agg(F.sum(n_words)).first()[0] or 0
    passes = max(1, -(-test_words // words_a_pass))
    found = None
    for k in range(passes):
        block = items.filter(F.pmod(F.xxhash64(item_col, item_text_col), F.lit(passes)) == k) if passes > 1 else items
        tests = TestSet([("null" if r[0] is None else str(r[0]), r[1]) for r in block.select(item_col, item_text_col).collect()], window)
        index = stored(build_index(docs, tests.number, id_col, text_col), "positional-index")
        hits = search(index, tests, rarest, within)
        found = hits if found is None else found.unionByName(hits)
    if passes > 1:
        lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "near_items")]  # one entry per pass
        found = found.groupBy("part", "number", "ordinal").agg(
            F.first("id").alias("id"), F.first("text_hash").alias("text_hash"), F.first("n_words").alias("n_words"), *lists)
        found = found.mapInArrow(_one_document, found.schema)
    return found.select(F.col("id").alias(id_col), "text_hash", "n_words", "spans", "items", "near_items")


def _one_document(batches):
    """What several passes found in a document, as one pass would give it."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            r["spans"] = merged([(x["first"], x["first"] + x["words"]) for x in r["spans"]])
            r["items"], r["near_items"] = sorted(set(r["items"])), sorted(set(r["near_items"]))
        yield pa.RecordBatch.from_pylist(rows, batch.schema)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an occurrence of a test window.

    All columns and all other rows stay, null and empty texts too. Rows are
    keyed by id and text hash, so rows that share an id are judged by their
    own texts and repeated rows go or stay together.
    """
    found = match_benchmark(docs, items, window, id_col=id_col, text_col=text_col).filter(F.size("spans") > 0)
    found = stored(found.select(F.col(id_col).alias("__s_id"), F.col("text_hash").alias("__s_hash")).distinct(), "contaminated")
    return docs.join(found, docs[id_col].eqNullSafe(found["__s_id"]) & (F.xxhash64(docs[text_col]) == found["__s_hash"]), "left_anti")
