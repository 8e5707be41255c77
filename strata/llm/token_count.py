"""Token counts by byte-pair merging, without producing token ids.

A text is cut at special strings and by the pre-tokenizer's pattern. Every
piece starts as one symbol per UTF-8 byte, held in a doubly linked list; a
heap yields the lowest-rank adjacent pair (leftmost first on ties) until no
pair can merge. The count is the initial symbols minus the merges. A piece's
count depends on the piece alone, so each worker remembers recent pieces.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import types

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pieces a worker remembers before it starts anew (bounds its memory).
CACHE_PIECES = 1_000_000
#: A text of these characters only can be split by the faster ``re`` module:
#: its letters are one class, its digits another, its white space a third.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_OTHER = re.compile(f"[^\x00-\x1b\x20-\x7f{_LETTERS}]").search
_SIMPLE = {r"\p{L}": _LETTERS, r"\p{N}": "0-9", r"\s": r" \t\n\v\f\r", r"\S": r"[^ \t\n\v\f\r]"}


def simple_pattern(pattern: str) -> str:
    """``pattern`` with its classes spelled out for such a text."""
    bare = {r" ?\p{L}+": f" ?[{_LETTERS}]+", r" ?\p{N}+": " ?[0-9]+", r"\s+": r"[ \t\n\v\f\r]+"}
    for classes in (bare, _SIMPLE):
        for name, chars in classes.items():
            pattern = pattern.replace(name, chars)
    return pattern


class PieceCounter(dict):
    """Maps a pre-token to its number of tokens; misses are merged and kept.

    Symbols are small numbers: the byte values, then one per merged string.
    """

    def __init__(self, merges: list[list[str]], alphabet: list[str]):
        super().__init__()
        number = {c: i for i, c in enumerate(alphabet)}
        self.made = [number.setdefault(a + b, len(number)) for a, b in merges]
        self.width = len(number)
        self.rank = {number[a] * self.width + number[b]: r for r, (a, b) in enumerate(merges)}

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE_PIECES:
            self.clear()
        data = piece.encode("utf-8", "surrogatepass")
        n = self[piece] = len(data) - self.merges(data)
        return n

    def merges(self, data: bytes) -> int:
        """How many merges byte-pair encoding makes in ``data``. Heap entries
        are rank << 32 | position of the left symbol."""
        symbol, n = list(data), len(data)
        rank_of, width, made, pop, push = self.rank.get, self.width, self.made, heapq.heappop, heapq.heappush
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [rank << 32 | i for i in range(n - 1) if (rank := rank_of(symbol[i] * width + symbol[i + 1])) is not None]
        heapq.heapify(heap)
        merged = 0
        while heap:
            entry = pop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = right[i]
            a = symbol[i]
            if j < 0 or a < 0 or rank_of(a * width + symbol[j]) != rank:
                continue  # one side has been merged since this pair was queued
            merged += 1
            symbol[i] = a = made[rank]
            symbol[j] = -1
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (rank := rank_of(a * width + symbol[k])) is not None:
                    push(heap, rank << 32 | i)
            h = left[i]
            if h >= 0 and (rank := rank_of(symbol[h] * width + a)) is not None:
                push(heap, rank << 32 | h)
        return merged


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value: printable
    Latin-1 bytes stand for themselves, the rest follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class TokenCounter:
    """Counts the tokens of texts for a byte-level BPE file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pieces = PieceCounter(spec["model"]["merges"], byte_symbols())
        self.any_split = regex.compile(pattern).findall
        self.simple_split = re.compile(simple_pattern(pattern)).findall
        special = sorted((t["content"] for t in spec["added_tokens"] if t["special"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def split(self, text: str) -> list[str]:
        return self.any_split(text) if _OTHER(text) else self.simple_split(text)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        of = self.pieces.__getitem__
        return len(parts) - 1 + sum(sum(map(of, self.split(p))) for p in parts)


def worker_counter(path: str, pattern: str) -> TokenCounter:
    """This Python worker's counter: kept from task to task, as the module's
    own globals are shipped anew with each."""
    kept = vars(sys.modules.setdefault("_token_counters", types.ModuleType("_token_counters"))).setdefault("kept", {})
    if (path, pattern) not in kept:
        kept[path, pattern] = TokenCounter(path, pattern)
    return kept[path, pattern]


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, max_tokens: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit of every whole text.

    ``vocabulary`` is the path of a byte-level BPE .json file that every
    worker can open; ``pattern`` is its pre-tokenizer's pattern. A special
    string inside a text is one token. Null and empty texts have no bytes and
    no tokens; repeated rows are counted each; other columns are ignored.
    Rows are independent: no shuffle, and a lost task is just run again.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        counter = worker_counter(vocabulary, pattern)
        for batch in batches:
            sizes, tokens = [], []
            for value in batch.column(1):
                text = value.as_py()
                sizes.append(len(text.encode()) if text else 0)
                tokens.append(counter.count(text))
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([t > max_tokens for t in tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
