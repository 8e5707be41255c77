"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digit and symbol substitutions) and an
Aho-Corasick automaton finds every word that starts with a lexicon stem.
Hits inside an exception phrase don't count. The score is a logistic function
of the summed weights and of their density in the text. Stems, weights and the
function are learned from labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

#: Letters that look like Latin ones. Fixed values.
HOMOGLYPHS = dict(zip("асеорхуіјѕԁһкмтвнгпАСЕОРХУІЈЅКМТВНαεικνορτυχ", "aceopxyijsdhkmtbhrnaceopxyijskmtbhaeiknoptux"))
#: Digits and symbols written for letters. Fixed values. What may stand for
#: i or l becomes i; stems are also looked for with i for l.
SUBSTITUTES = dict(zip("01345789@$!|", "oieastbgasii"))
#: Insults that are looked for whether or not the labels teach them.
SEEDS = ("idiot", "moron", "stupid", "scum", "loser", "trash", "pathetic", "worthless", "disgusting", "clown")
#: Phrases in which a hit is no insult.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "clownfish", "circus clown", "white trash bag", "loser tree")


@dataclass(frozen=True)
class Learning:
    """Bounds of learning. ``max_rows`` labelled documents are fitted on, the
    ones with the lowest hash of their texts; the other values are tests that a
    stem has to pass (see :func:`learn_lexicon`), of which any number may."""

    max_rows: int = 20_000
    min_texts: int = 5
    min_log_ratio: float = 1.2
    min_strength: float = 28.0
    steps: int = 50


#: Stems of fewer letters match whole words only: too many words begin so.
PREFIX_LETTERS = 5
LEAST_LETTERS = 3


def stems_of(word: str) -> set[str]:
    """What a folded word may teach: its beginnings that can match as such,
    and, if it is a short one, itself."""
    if len(word) < PREFIX_LETTERS:
        return {word} if len(word) >= LEAST_LETTERS else set()
    return {word[:k] for k in range(PREFIX_LETTERS, len(word) + 1)}


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: Logistic function of (1, log(1 + sum), log(1 + sum per 100 words)).
    coefficients: list[float] = field(default_factory=lambda: [-2.0, 2.0, 1.0])


_FOLD = str.maketrans(HOMOGLYPHS)
_SUBSTITUTE = str.maketrans(SUBSTITUTES)
_TOKEN = re.compile(r"[@$]?[^\W_](?:[@$!|]*[^\W_])*")
_MARKS = re.compile("[̀-ͯ​-‏⁠﻿­]")
_SUSPECT = re.compile(r"[^\W\d_][0-9@$!|]+[^\W\d_]|(?<!\w)[0-9@$]+[^\W\d_]")
_BEYOND_LATIN = re.compile("[^\u0000-ɏ]|\u00ad")


def _letters_for(match: re.Match) -> str:
    """A token with two letters at least, read as letters throughout."""
    token = match[0]
    return token.translate(_SUBSTITUTE) if sum(map(str.isalpha, token)) > 1 else token


def fold(text: str) -> str:
    """Lower case; compatibility forms, look-alikes and invisible marks
    resolved; digits and symbols inside a word read as letters."""
    if _BEYOND_LATIN.search(text):
        text = _MARKS.sub("", unicodedata.normalize("NFKC", text)).translate(_FOLD)
    if _SUSPECT.search(text):
        text = _TOKEN.sub(_letters_for, text)
    return text.lower()


_WORD = re.compile(r"[^\W\d_]+").findall


class Matcher:
    """Aho-Corasick automaton over a lexicon's stems and exception phrases."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for stem, weight in lexicon.weights.items():
            for form in {stem, stem.replace("l", "i")}:
                self.automaton.add_word(form, (len(stem), weight))
        for phrase in lexicon.exceptions:
            if phrase not in lexicon.weights:
                self.automaton.add_word(phrase, (len(phrase), None))
        self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(start, weight) of each word start that a stem matches (a short stem:
        the whole word); the longest stem counts. A start inside an exception
        phrase is dropped."""
        if not len(self.automaton):
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if start and folded[start - 1].isalpha():
                continue
            if size < PREFIX_LETTERS and weight is not None and folded[end + 1 : end + 2].isalpha():
                continue
            if weight is None:
                spared.append((start, end))
            elif start not in best or size > best[start][0]:
                best[start] = (size, weight)
        return [(s, w) for s, (_, w) in best.items() if not any(a <= s <= b for a, b in spared)]

    def features(self, text: str | None) -> tuple[float, float, int]:
        """log(1 + sum of weights), log(1 + that sum per 100 words), hits."""
        folded = fold(text or "")
        found = self.hits(folded)
        total = sum(w for _, w in found)
        words = max(1, len(folded.split()))
        return math.log1p(max(0.0, total)), math.log1p(max(0.0, 100 * total / words)), len(found)

    def score(self, text: str | None) -> tuple[float, int]:
        summed, density, n = self.features(text)
        a, b, c = self.lexicon.coefficients
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, a + b * summed + c * density)))), n


def in_training(doc_id: Column) -> Column:
    """Rows to learn from: CRC-32 of the id as text leaves a rest by 5."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) != 0


def training_rows(docs: DataFrame, labels: DataFrame, how: Learning, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Distinct labelled texts outside the held-out fifth, at most
    ``how.max_rows``. Equal texts count once, so a group of copies teaches no
    more than one text."""
    marked = labels.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).distinct()
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull() & in_training(F.col("_doc")))
    labelled = (texts.select("_doc", F.xxhash64("text").alias("hash")).join(marked, F.col("_doc") == F.col("_id"))
                .groupBy("hash").agg(F.min(F.struct("_doc", "label")).alias("k")).select("hash", "k._doc", "k.label"))
    labelled = stored(labelled, "toxicity-labelled")
    rows = labelled.count()
    if rows > how.max_rows:  # by a hash limit that leaves about so many, so that few rows meet where the last are cut
        limit = -(1 << 63) + int((1 << 64) * min(1.0, 1.1 * how.max_rows / rows))
        labelled = labelled.filter(F.col("hash") <= F.lit(min(limit, (1 << 63) - 1)))
    chosen = labelled.orderBy("hash").limit(how.max_rows)
    chosen = F.broadcast(stored(chosen.withColumnRenamed("_doc", "_id"), "toxicity-sample"))
    rows = texts.join(chosen, (F.col("_doc") == F.col("_id")) & (F.xxhash64("text") == F.col("hash")))
    return stored(rows.groupBy("hash").agg(F.first("text").alias("text"), F.first("label").alias("label")), "toxicity-training")


def learn_lexicon(docs: DataFrame, labels: DataFrame, how: Learning = Learning(), id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic") -> Lexicon:
    """A lexicon fitted on a bounded sample of labelled rows.

    Stems are beginnings of ``PREFIX_LETTERS`` letters or more, and whole short
    words of ``LEAST_LETTERS``. One counts if it is in ``how.min_texts`` toxic
    texts at least, the share of toxic texts that have it is
    ``exp(how.min_log_ratio)`` times that of the others, and the
    likelihood-ratio statistic of the two shares is over ``how.min_strength``;
    the log ratio is its weight. A text counts once, however often it repeats
    a word. Of stems that extend each other the strongest stays, of equally
    strong ones the longest: what only ever begins "pathetic" is not learned
    as "path". However many pass are kept. Without labelled rows of both kinds
    the seeds stand, with weight 1.
    """
    rows = training_rows(docs, labels, how, id_col, text_col, label_col)
    seeds = Lexicon({s: 1.0 for s in SEEDS})
    sizes = dict(rows.groupBy("label").count().collect())
    if len(sizes) < 2:
        return seeds

    def stems(batches):
        for batch in batches:
            counts: dict[tuple[str, int], int] = {}
            for text, label in zip(batch.column(0), batch.column(1)):
                label = label.as_py()
                found = set().union(*map(stems_of, set(_WORD(fold(text.as_py())))))
                for s in found:
                    counts[s, label] = counts.get((s, label), 0) + 1
            yield pa.record_batch([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
                                   pa.array(list(counts.values()), pa.int64())], names=["stem", "label", "texts"])

    on = lambda label: F.sum(F.when(F.col("label") == label, F.col("texts")).otherwise(0))
    table = rows.select("text", "label").mapInArrow(stems, "stem string, label int, texts long").groupBy("stem").agg(on(1).alias("bad"), on(0).alias("good"))
    n_bad, n_good = sizes[1], sizes[0]
    ratio = F.log((F.col("bad") + 0.5) / n_bad) - F.log((F.col("good") + 0.5) / n_good)
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    both, bad, good = F.col("bad") + F.col("good"), F.col("bad"), F.col("good")
    share = both / (n_bad + n_good)
    strength = 2 * (part(bad, share * n_bad) + part(good, share * n_good) + part(n_bad - bad, (1 - share) * n_bad) + part(n_good - good, (1 - share) * n_good))
    ranked = (table.filter(bad >= how.min_texts).withColumn("ratio", ratio).filter(F.col("ratio") >= how.min_log_ratio)
              .withColumn("strength", F.round(strength, 9)).filter(F.col("strength") > how.min_strength)
              .select("stem", "ratio", "strength").collect())  # stems of at most max_rows texts that pass the test
    weights: dict[str, float] = {}
    begun: set[str] = set()  # every beginning of a chosen stem
    for r in sorted(ranked, key=lambda r: (-r["strength"], -len(r["stem"]), r["stem"])):
        stem = r["stem"]
        beginnings = {stem[:k] for k in range(PREFIX_LETTERS, len(stem))}
        if stem not in begun and not any(b in weights for b in beginnings):
            weights[stem] = r["ratio"]
            begun |= beginnings
    for s in SEEDS:
        if s not in begun and not any(s[:k] in weights for k in range(LEAST_LETTERS, len(s) + 1)):
            weights[s] = how.min_log_ratio
    lexicon = Lexicon(weights)
    points = rows.select("text", "label").mapInArrow(_features(lexicon), "summed double, density double, label int")
    data = np.array(sorted(map(tuple, points.collect())), float).reshape(-1, 3)  # at most how.max_rows rows
    lexicon.coefficients = logistic_fit(data[:, :2], data[:, 2], how.steps)
    return lexicon


def _features(lexicon: Lexicon):
    """Features of (text, label) batches; the automaton is built in the task."""

    def run(batches):
        matcher = Matcher(lexicon)
        for batch in batches:
            f = [matcher.features(t.as_py())[:2] for t in batch.column(0)]
            yield pa.record_batch([pa.array([x[0] for x in f], pa.float64()), pa.array([x[1] for x in f], pa.float64()), batch.column(1)],
                                  names=["summed", "density", "label"])

    return run


def logistic_fit(x: np.ndarray, y: np.ndarray, steps: int, ridge: float = 1e-3) -> list[float]:
    """Newton's method for logistic regression with an intercept; slopes are
    kept at 0 or above, so that more hits never lower a score."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(3)
        step = np.linalg.solve(hess, grad)
        w = w - step
        w[1:] = np.maximum(w[1:], 0.0)
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in w]


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns of ``keep``, toxicity ``score`` (0 to 1) and
    ``n_hits`` of every row. Null and empty texts score as a text without
    hits; repeated rows are scored each. No shuffle; ids and other columns
    never enter a score."""
    names = [id_col, *keep]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def run(batches):
        matcher = Matcher(lexicon)
        for batch in batches:
            scored = [matcher.score(t.as_py()) for t in batch.column(len(names))]
            yield pa.record_batch([*batch.columns[: len(names)], pa.array([s for s, _ in scored], pa.float64()),
                                   pa.array([n for _, n in scored], pa.int64())], names=[*names, "score", "n_hits"])

    return docs.select(*names, text_col).mapInArrow(run, f"{kinds}, score double, n_hits long")


def drop_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, whole and in their
    own schema, judged in the scan: no join back."""

    def run(batches):
        matcher = Matcher(lexicon)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array([matcher.score(t.as_py())[0] < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
