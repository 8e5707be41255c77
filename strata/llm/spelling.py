"""Spelling variants: words within one edit of each other, found through the
one-edit neighbourhoods of their forms in a reduced alphabet."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, drop_stored, stored

#: Latin letters: A-Z in either case and U+00C0 to U+00FF.
LATIN = r"[a-z\x{C0}-\x{FF}]"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@dataclass(frozen=True)
class Alphabet:
    """``symbols`` that the letters are hashed to. Pairs of reduced words with
    over ``crowded`` word pairs go to the alphabet ``finer``, where such letters
    have symbols of their own (code points modulo 64), and are not expanded here."""

    symbols: int = 8
    finer: int = 64
    crowded: int = 10_000


def word_runs(docs: DataFrame, min_length: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run): every maximal run of Latin letters of ``min_length`` or more
    in the whole texts, A-Z folded and nothing else; null texts have none."""
    runs = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(f"({LATIN}{{{min_length},}}+)"), F.lit(1))
    return docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))


def reduced(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Symbols of code points: their hash, or in a finer alphabet their last
    bits, which differ among the letters of one script."""
    if symbols >= 64:
        return codes % symbols
    return ((codes.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(13)) % np.uint64(symbols)).astype(np.int64)


def _values(symbols: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(symbols)).integers(1, 1 << 63, symbols, dtype=np.uint64)


def _finish(sums: np.ndarray, length: int) -> np.ndarray:
    x = sums + np.uint64(length * 0xC2B2AE3D27D4EB4F % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def _powers(n: int) -> np.ndarray:
    """base ^ 0 .. base ^ n, modulo 2^64."""
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE, np.uint64)]))


def _by_length(words: list[str], cells: int = 1 << 20):
    """(places, code points) of words of one length at a time, one row each."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        step = max(1, cells // max(int(length), 1))
        for at in range(0, len(places), step):
            some = places[at : at + step]
            codes = np.frombuffer("".join(words[p] for p in some).encode("utf-32-le", "surrogatepass"), "<u4")
            yield some, codes.reshape(len(some), length).astype(np.int64)


def reduced_keys(words: list[str], symbols: int) -> np.ndarray:
    """The hash of each word's reduced form."""
    values, out = _values(symbols), np.empty(len(words), np.int64)
    for places, codes in _by_length(words):
        length = codes.shape[1]
        out[places] = _finish((values[reduced(codes, symbols)] * _powers(length)[length - 1 :: -1][:length]).sum(axis=1, dtype=np.uint64), length)
    return out


def neighbour_keys(words: list[str], symbols: int):
    """(places, keys) arrays: hashes of reduced words one edit from each
    word's reduced form. Being one edit apart goes both ways, so each pair of
    forms is generated at one end only: a deletion at the longer (the shorter
    one's insertion), a replacement at the one with the lesser symbol.
    """
    values = _values(symbols)
    for places, codes in _by_length(words):
        length = codes.shape[1]
        if not length:  # nothing to delete or replace; longer words lead to it
            continue
        form, powers = reduced(codes, symbols), _powers(length)
        weight = powers[length - 1 :: -1][:length]  # of each place
        terms = values[form] * weight
        total = terms.sum(axis=1, dtype=np.uint64)
        behind = total[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)  # what follows a place
        # what stands before a place moves one place down: its terms of one power less
        shorter = values[form][:, : length - 1] * powers[length - 2 :: -1][: length - 1] if length > 1 else np.empty((len(places), 0), np.uint64)
        before = np.concatenate([np.zeros((len(places), 1), np.uint64), np.cumsum(shorter, axis=1, dtype=np.uint64)], axis=1)
        new = np.concatenate([np.ones((len(places), 1), bool), form[:, 1:] != form[:, :-1]], axis=1)  # of a run of one symbol, one deletion
        row, _ = np.nonzero(new)
        yield places[row], _finish((before + behind)[new], length - 1)
        for symbol in range(1, symbols):
            lesser = form < symbol
            row, _ = np.nonzero(lesser)
            if len(row):
                yield places[row], _finish((total[:, None] - terms + values[symbol] * weight)[lesser], length)


def _with_keys(words: DataFrame, symbols: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(reduced_keys(batch.column(0).to_pylist(), symbols))], names=["word", "key"])

    return words.select("word").mapInArrow(run, "word string, key long")


def _neighbourhoods(forms: DataFrame, symbols: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            keys = batch.column(1).to_numpy()
            for places, near in neighbour_keys(batch.column(0).to_pylist(), symbols):
                yield pa.record_batch([pa.array(keys[places]), pa.array(near)], names=["key", "near"])

    return forms.select("word", "key").mapInArrow(run, "key long, near long")


def _expanded(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """Word pairs (a, b) of the pairs of forms, verified on the words themselves."""
    a = keyed.select(F.col("key").alias("r1"), F.col("word").alias("x"))
    b = keyed.select(F.col("key").alias("r2"), F.col("word").alias("y"))
    both = pairs.select("r1", "r2").join(a, "r1").join(b, "r2").filter((F.col("r1") != F.col("r2")) | (F.col("x") < F.col("y")))
    return both.filter(F.levenshtein("x", "y", 1) == 1).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def one_edit_pairs(words: DataFrame, how: Alphabet = Alphabet()) -> DataFrame:
    """The pairs (a, b), a < b, of distinct ``word`` values that one inserted,
    deleted or replaced code point makes equal; each once."""
    keyed = stored(_with_keys(words, how.symbols), "spelling-keys")
    forms = stored(keyed.groupBy("key").agg(F.min("word").alias("word"), F.count(F.lit(1)).alias("size")), "spelling-forms")
    near = _neighbourhoods(forms, how.symbols)
    joined = near.join(forms.select(F.col("key").alias("near"), F.col("size").alias("size2")), "near").select(
        F.col("key").alias("r1"), F.col("near").alias("r2"), "size2")
    joined = joined.join(forms.select(F.col("key").alias("r1"), "size"), "r1").select("r1", "r2", (F.col("size") * F.col("size2")).alias("cost"))
    alone = forms.filter("size > 1").select(F.col("key").alias("r1"), F.col("key").alias("r2"), (F.col("size") * F.col("size")).alias("cost"))
    pairs = stored(joined.union(alone).distinct(), "spelling-pairs")
    if how.symbols >= how.finer:
        return _expanded(pairs, keyed).distinct()
    edges = _expanded(pairs.filter(F.col("cost") <= how.crowded), keyed)
    crowded = pairs.filter(F.col("cost") > how.crowded).select(F.explode(F.array("r1", "r2")).alias("key")).distinct()
    if crowded.limit(1).count():
        again = keyed.join(crowded, "key", "left_semi").select("word")
        edges = edges.union(one_edit_pairs(again, Alphabet(how.finer, how.finer, how.crowded)))
    return edges.distinct()


def spelling_variants(words: DataFrame, ratio: int = 10, how: Alphabet = Alphabet()) -> DataFrame:
    """One row per row of ``words`` (word, n; words distinct and not null):
    word, n, n_near (words one edit away), form and form_n (the near word of
    the largest n and its n, ties to the first in code-point order, if that n
    is at least ``ratio`` times the word's; else null) and root (the last word
    that forms lead to; the word itself without one).

    Forms at least multiply n by ``ratio``, so a chain has no loop; each round
    doubles the steps that roots have followed. No words give no rows.
    """
    pairs = stored(one_edit_pairs(words, how), "spelling-edges")
    arcs = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other")),
                                          F.struct(F.col("b").alias("word"), F.col("a").alias("other")))).alias("e")).select("e.*")
    counted = arcs.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    near = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    is_form = -F.col("best.less") >= ratio * F.col("n")
    found = words.select("word", "n").join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"),
        F.when(is_form, -F.col("best.less")).cast("long").alias("form_n"))
    found = stored(found, "spelling-found")
    steps = stored(found.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        drop_stored(steps)
        steps = after.select("word", "root")
        if not after.filter("moved").limit(1).count():
            break
    return found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def without(run: Column, place: Column) -> Column:
    """``run`` without its code point at ``place`` (from 0)."""
    return F.concat(F.substring(run, F.lit(1), place.cast("int")), F.substring(run, place.cast("int") + 2, F.length(run)))
