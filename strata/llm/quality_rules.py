"""Distribution divergence against language references.

A document's character-class histogram and its histogram of a language's
common words are compared with the language's reference by Jensen-Shannon
distance (base 2: 0 equal, 1 disjoint). Short texts are not judged: their
histograms are noise.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Common words of each language. Fixed values.
COMMON_WORDS = {
    "en": "the of and to a in is it that was for on are as with be by at from this".split(),
    "de": "der die das und in den von zu mit sich des auf ein eine nicht auch es an dem ist".split(),
    "fr": "le la les de des et en un une du que qui dans pour par sur pas au est ce".split(),
    "es": "el la los las de y en que un una del por con para se no es al lo su".split(),
}
CLASSES = ("lower", "upper", "digit", "space", "newline", "sentence", "symbol", "beyond_ascii")


def _class_of_bytes() -> np.ndarray:
    of = np.full(256, CLASSES.index("symbol"), np.int64)
    of[0x80:] = CLASSES.index("beyond_ascii")
    for name, chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                        ("digit", "0123456789"), ("space", " \t\v\f\r"), ("newline", "\n"), ("sentence", ".,;:!?'\"()-")):
        of[list(chars.encode())] = CLASSES.index(name)
    return of


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict. ``min_chars`` / ``min_words`` are the
    minimum-length guards of the two comparisons, and ``noise_words`` over the
    number of words is added to the word limit, as few words scatter more."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_chars: int = 300
    max_class_distance: float = 0.35
    min_common_words: int = 100
    max_word_distance: float = 0.3
    noise_words: float = 3.0


@lru_cache(maxsize=None)
def word_forms(word: str) -> set[bytes]:
    return {word.encode(), word.capitalize().encode()}


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the base-2 Jensen-Shannon divergence of two histograms."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    tiny = 1e-300  # a class that is empty on either side adds 0 there
    d = (p * np.log2((p + tiny) / (m + tiny)) + q * np.log2((q + tiny) / (m + tiny))).sum() / 2
    return float(min(max(d, 0.0), 1.0)) ** 0.5


def repeated_window_words(ids: np.ndarray, window: int = 3) -> int:
    """Words inside a ``window``-word run that occurs at least twice."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = ids[:n]
    for k in range(1, window):  # number the pairs anew each time, so that keys never overflow
        key = key * (int(ids.max()) + 1) + ids[k : n + k]
        if k + 1 < window or n > 1 << 20:
            key = np.unique(key, return_inverse=True)[1] if key.max() > 1 << 40 else key
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit = np.zeros(len(ids), bool)
    for k in range(window):
        hit[k : n + k] |= twice
    return int(hit.sum())


class Measure:
    """Measures of one text; everything is taken from its whole bytes."""

    class_of = _class_of_bytes()

    def __init__(self, text: str | None):
        self.text = text = text or ""
        self.data = text.encode("utf-8", "surrogatepass")
        self.words = self.data.split()
        self.counts = Counter(self.words)
        self.n_words = len(self.words)
        self.word_chars = len(text) - (len(self.data) - sum(map(len, self.words)))

    def base(self) -> dict:
        number = {w: i for i, w in enumerate(self.counts)}
        ids = np.array([number[w] for w in self.words], np.int64)
        lines = [line for line in self.data.split(b"\n") if line.strip()]
        return {
            "n_words": self.n_words, "word_chars": self.word_chars,
            "n_symbols": len(self.data) - len(self.data.translate(None, b"#*$%&|<>")),
            "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": repeated_window_words(ids),
        }

    def classes(self) -> np.ndarray:
        return np.bincount(self.class_of[np.frombuffer(self.data, np.uint8)], minlength=len(CLASSES)).astype(float)

    def common(self, words: list[str]) -> np.ndarray:
        """Counts of ``words`` (as written or capitalised), then of all others."""
        of = self.counts
        found = [sum(of[form] for form in word_forms(w)) for w in words]
        return np.array([*found, self.n_words - sum(found)], float)


#: References sum each text's shares in whole millionths: sums of integers are
#: the same in any order.
SHARE = 1_000_000
#: Language labels that get a reference: codes of two or three letters. There
#: are 18,252, so references stay small whatever a label column holds.
LANGUAGE = re.compile("[a-z]{2,3}")


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, dict]:
    """Reference histograms per language (see ``LANGUAGE``), over all
    documents: of character classes, and for languages in ``COMMON_WORDS`` of
    those words too. Every text adds its shares with equal weight, so no single
    long text sets a reference. Tasks add up their own rows; what comes back has
    at most thirty rows a language, whatever the input."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                if lang and LANGUAGE.fullmatch(lang) and (m := Measure(text.as_py())).n_words:
                    shares = [m.classes() / len(m.data)]
                    if lang in COMMON_WORDS:
                        shares.append(m.common(COMMON_WORDS[lang]) / m.n_words)
                    row = np.concatenate([[m.n_words], *[(x * SHARE).astype(np.int64) for x in shares]]).astype(np.int64)
                    sums[lang] = sums.get(lang, 0) + row
        for lang, row in sums.items():
            yield pa.record_batch([pa.array([lang] * len(row)), pa.array(range(len(row)), pa.int32()), pa.array(row)],
                                  names=["lang", "slot", "value"])

    parts = docs.select(text_col, lang_col).mapInArrow(run, "lang string, slot int, value long")
    out: dict[str, dict[int, int]] = {}
    for r in parts.groupBy("lang", "slot").agg(F.sum("value").alias("value")).collect():
        out.setdefault(r["lang"], {})[r["slot"]] = r["value"]
    k = 1 + len(CLASSES)
    return {lang: {"n_words": v[0], "classes": np.array([v[i] for i in range(1, k)], float),
                   "common": np.array([v[i] for i in range(k, len(v))], float) if len(v) > k else None} for lang, v in out.items()}


#: Letters of the references' script, and letters of any other.
_LATIN = re.compile("[A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]").findall
_OTHER_SCRIPT = re.compile(r"[^\W\d_\u0000-\u024f]").findall


def latin_script(text: str) -> bool:
    """Whether no other script has more letters in ``text`` than the Latin one,
    in which all of ``COMMON_WORDS`` are written."""
    return text.isascii() or len(_OTHER_SCRIPT(text)) <= len(_LATIN(text))


def judge(m: Measure, lang: str | None, references: dict[str, dict], rules: Rules) -> tuple[float | None, float | None]:
    """Distances to the reference of ``lang``. A null language is held against
    the nearest reference of ``COMMON_WORDS`` if the text's script is theirs.
    None where a guard forbids a verdict or there is nothing to judge by."""
    if lang is None:
        against = [k for k in references if k in COMMON_WORDS] if latin_script(m.text) else []
    else:
        against = [lang] if lang in references else []
    by_class = by_word = None
    if against and len(m.data) >= rules.min_chars:
        classes = m.classes()
        by_class = min(js_distance(classes, references[k]["classes"]) for k in against)
    listed = [k for k in against if references[k]["common"] is not None]
    if listed and m.n_words >= rules.min_common_words:
        by_word = min(js_distance(m.common(COMMON_WORDS[k]), references[k]["common"]) for k in listed)
    return by_class, by_word


def quality_verdicts(docs: DataFrame, references: dict[str, dict] | None = None, rules: Rules = Rules(),
                     id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: the base measures, both distances and ``kept``.

    Two scans when the references are built from ``docs``, no shuffle of
    texts. Null texts count as empty: no words, hence ``base_failed``. Every
    language in the data has a reference, however little text it has: a lone
    text is at distance 0 from its own. Without a list of common words a
    language is judged by character classes only. A null language is held
    against the nearest reference with a list, if the text is mostly in their
    script. Texts under the guards, without a language and in another script,
    or labelled with no language code get null distances and keep the base
    verdict, as does everything when there is no reference (an empty table). Repeated rows are judged each; other columns
    are ignored.
    """
    references = language_references(docs, text_col, lang_col) if references is None else references
    kind = docs.schema[id_col].dataType.simpleString()
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for batch in batches:
            cols: dict[str, list] = {k: [] for k in [*fields, "base_failed", "class_distance", "word_distance", "kept"]}
            for text, lang in zip(batch.column(1), batch.column(2)):
                m = Measure(text.as_py())
                row = m.base()
                failed = row["n_words"] < rules.min_words or 100 * row["n_repeat_words"] > rules.max_repeat_percent * row["n_words"]
                by_class, by_word = judge(m, lang.as_py(), references, rules)
                far = (by_class or 0) > rules.max_class_distance or (by_word or 0) > rules.max_word_distance + rules.noise_words / max(1, m.n_words)
                row |= {"base_failed": failed, "class_distance": by_class, "word_distance": by_word, "kept": not failed and not far}
                for k, v in row.items():
                    cols[k].append(v)
            kinds = [pa.int64()] * len(fields) + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.record_batch([batch.column(0), *[pa.array(v, t) for v, t in zip(cols.values(), kinds)]], names=[id_col, *cols])

    return docs.select(id_col, text_col, lang_col).mapInArrow(
        run, f"`{id_col}` {kind}, " + ", ".join(f"{k} long" for k in fields)
        + ", base_failed boolean, class_distance double, word_distance double, kept boolean")
