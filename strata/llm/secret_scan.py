"""Secret scan: known shapes, and a battery of randomness tests under
false-discovery control. DataFrame functions only.

The null hypothesis of a run of characters is that it is text-like: drawn
unevenly from its alphabet and changing rarely between kinds of characters.
Length enters every test, so a short run has to be odder than a long one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

#: Shapes: kind, pattern, and the group and length that a match must have.
#: Fixed values. Matches that fail are dropped after matching.
SHAPES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: Equal to the pattern of a shape followed by its test of length: a shorter
#: match of these two can't hold or hide a longer one.
_ONLY_LONG = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
#: Runs that the battery tests: maximal, of this length at least.
RUN_CHARS, RUN_LENGTH = "A-Za-z0-9+/_=-", 20
#: How runs are cut before an encoding is inferred. First at every '=' but
#: trailing padding, as in NAME=key; then, as in paths and names, at what only
#: one base64 alphabet has, at what only the other has, and at both.
_PADDING = "(?:=+\\z)?"
WHOLE_PIECE = "[A-Za-z0-9+/_-]{%d,}" + _PADDING
INNER_PIECES = ("[A-Za-z0-9_-]{%d,}" + _PADDING, "[A-Za-z0-9+/]{%d,}" + _PADDING, "[A-Za-z0-9]{%d,}" + _PADDING)
LEAST_SYMBOLS = 16
#: Encodings in the order of inference: name, pattern, alphabet.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("decimal", "^[0-9]+$", _DIGITS),
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567"),
    ("base64", "^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: Text-like null: the chance that two of its characters are equal, and that
#: the next one is of another kind (lower, upper, digit or symbol).
TEXT_REPEAT, TEXT_CHANGE = 0.0655, 0.2
#: A run must look random at this many standard deviations in each test.
RANDOM_LIMIT = 3.5
WIDER = 100.0
#: P-values are held as steps of a twentieth of a decade.
STEPS_A_DECADE, MOST_STEPS = 20, 2000


def _found(text: Column, pattern: str) -> Column:
    """(gap, match) pairs: what precedes each match back to the one before,
    in code points, and the match. From these follow the places."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    return F.when(text.rlike(pattern), pairs)


def _places(scanned: DataFrame, column: str) -> DataFrame:
    """row, start, end (code points, end exclusive) and match of every pair."""
    rows = scanned.filter(F.col(column).isNotNull()).select("row", F.posexplode(column).alias("i", "p"))
    rows = rows.select("row", "i", "p.match", F.col("p.gap").alias("gap"), F.length("p.match").alias("size"))
    ends = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row").orderBy("i"))
    return rows.select("row", (ends - F.col("size")).alias("start"), ends.alias("end"), "match")


def pieces(runs: DataFrame) -> DataFrame:
    """row, start, end and match of the pieces of ``runs`` (see
    :func:`_places`) that may be keys, and their ``level``: 0 for what lies
    between '=' signs, 1 for the cuts inside it."""

    def cut(of: DataFrame, pattern: str) -> DataFrame:
        found = of.select("row", F.col("start").alias("run"), F.posexplode(_found(F.col("match"), pattern % LEAST_SYMBOLS)).alias("i", "p"))
        found = found.select("row", "run", "i", "p.match", F.col("p.gap").alias("gap"), F.length("p.match").alias("size"))
        ends = F.col("run") + F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row", "run").orderBy("i"))
        return found.select("row", (ends - F.col("size")).alias("start"), ends.alias("end"), "match").filter(F.length("match") >= RUN_LENGTH)

    separated = F.col("match").rlike("=[^=]")
    whole = runs.filter(~separated).select("row", "start", "end", "match").unionByName(cut(runs.filter(separated), WHOLE_PIECE))
    mixed = runs.filter(F.col("match").rlike("[+/_-]"))
    out = whole.withColumn("level", F.lit(0))
    for pattern in INNER_PIECES:
        out = out.unionByName(cut(mixed, pattern).withColumn("level", F.lit(1)))
    return out.groupBy("row", "start", "end").agg(F.first("match").alias("match"), F.min("level").alias("level"))


def _apart(found: DataFrame) -> DataFrame:
    """Of overlapping discoveries, the best: the uncut piece, then the least p;
    a piece with separators inside must be ``WIDER`` times less likely, or it
    is a key with the end of a path."""
    weighed = F.when((F.col("level") > 0) & F.col("match").rlike("[+/_-]"), F.col("p") * WIDER).otherwise(F.col("p")).alias("p")
    spans = F.array_sort(F.collect_list(F.struct("level", weighed, "start", "end")))
    kind = "array<struct<level: int, p: double, start: bigint, end: bigint>>"
    clear = lambda kept, x: ~F.exists(kept, lambda k: (k["start"] < x["end"]) & (x["start"] < k["end"]))
    best = F.aggregate("spans", F.array().cast(kind), lambda kept, x: F.when(clear(kept, x), F.concat(kept, F.array(x))).otherwise(kept))
    rows = found.withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long"))
    rows = rows.groupBy("row").agg(spans.cast(kind).alias("spans")).select("row", F.explode(best).alias("s"))
    return rows.select("row", "s.start", "s.end")


def _normal_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal law (Zelen and Severo's polynomial)."""
    x = F.abs(z)
    t = 1 / (1 + F.lit(0.2316419) * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def randomness(runs: DataFrame) -> DataFrame:
    """``runs`` (with a column ``match``) plus the battery's statistics, but
    for plain numbers, unknown encodings (of which :func:`pieces` has the
    parts) and runs that are mostly padding.

    chi: chi-squared against a uniform alphabet. changes: runs of characters
    of one kind, less one. serial: correlation of neighbouring symbols' numbers.
    ``like_random`` holds if none of the three rejects randomness for the
    inferred encoding; ``p`` is the chance of text as even and as mixed.
    """
    body = F.rtrim(F.col("match"), F.lit("="))
    name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n, pattern, chars in reversed(ENCODINGS):
        name, alphabet = F.when(body.rlike(pattern), n).otherwise(name), F.when(body.rlike(pattern), chars).otherwise(alphabet)
    out = runs.withColumn("encoding", name).withColumn("_alphabet", alphabet)
    out = out.filter(F.col("encoding").isNotNull() & (F.col("encoding") != "decimal") & (F.length(body) >= LEAST_SYMBOLS))
    symbols = F.filter(F.split(body, ""), lambda c: c != "")
    out = out.withColumn("_s", F.transform(symbols, lambda c: F.instr(F.col("_alphabet"), c).cast("double")))
    kind = lambda c: F.when(c.rlike("[a-z]"), 1).when(c.rlike("[A-Z]"), 2).otherwise(3)
    out = out.withColumn("_k", F.transform(symbols, kind)).withColumn("_n", F.size("_s").cast("double"))
    rest = lambda c: F.slice(c, 2, F.size(c))
    size = F.length("_alphabet").cast("double")
    n = F.col("_n")
    same = F.aggregate(F.array_distinct("_s"), F.lit(0.0), lambda a, v: a + F.pow(F.size(F.filter("_s", lambda u: u == v)).cast("double"), F.lit(2.0)))
    changes = F.aggregate(F.slice(F.zip_with("_k", rest(F.col("_k")), lambda a, b: (a != b).cast("int")), 1, F.size("_k") - 1), F.lit(0), lambda a, v: a + v)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    out = (out.withColumn("chi", same * size / n - n).withColumn("changes", changes.cast("double"))
           .withColumn("_mean", total(F.col("_s")) / n))
    centred = out.withColumn("_c", F.transform("_s", lambda v: v - F.col("_mean")))
    products = F.slice(F.zip_with("_c", rest(F.col("_c")), lambda a, b: a * b), 1, F.size("_c") - 1)
    square = total(F.transform("_c", lambda v: v * v))
    out = centred.withColumn("serial", F.when(square > 0, total(products) / square).otherwise(1.0))
    kinds = lambda pattern: F.length(F.regexp_replace("_alphabet", pattern, "")) / size
    lower, upper = kinds("[^a-z]"), kinds("[^A-Z]")
    change = 1 - (lower * lower + upper * upper + (1 - lower - upper) * (1 - lower - upper))
    free = size - 1
    z_chi = (F.col("chi") - free) / F.sqrt(2 * free)
    z_change = F.abs(F.col("changes") - (n - 1) * change) / F.sqrt((n - 1) * change * (1 - change))
    z_serial = F.abs(F.col("serial")) * F.sqrt(n)
    like = (z_chi <= RANDOM_LIMIT) & (z_change <= RANDOM_LIMIT) & (z_serial <= RANDOM_LIMIT)
    repeat = F.greatest(F.lit(TEXT_REPEAT), 2 / size)  # a small alphabet repeats more in any text
    excess = size * repeat - 1
    text_chi = (free + (n - 1) * excess - F.col("chi")) / F.sqrt(2 * free + 4 * (n - 1) * excess * (1 + excess))
    text_change = (F.col("changes") - (n - 1) * TEXT_CHANGE) / F.sqrt((n - 1) * F.lit(TEXT_CHANGE * (1 - TEXT_CHANGE)))
    out = out.withColumn("like_random", like).withColumn("p", _normal_tail((text_chi + text_change) / math.sqrt(2)))
    return out.drop("_alphabet", "_s", "_k", "_n", "_mean", "_c")


def discoveries(tested: DataFrame, rate: float = 0.01) -> DataFrame:
    """Runs that look random and whose p-value the Benjamini-Hochberg rule
    passes at false-discovery ``rate``, over all runs and pieces tested.

    P-values are rounded up to steps, so the rule needs only a histogram of at
    most ``MOST_STEPS`` rows; rounding up never admits more.
    """
    step = F.least(F.greatest(F.floor(-F.log10(F.greatest("p", F.lit(1e-300))) * STEPS_A_DECADE), F.lit(0)), F.lit(MOST_STEPS))
    stepped = tested.withColumn("_step", step.cast("int"))
    counts = dict(stepped.groupBy("_step").count().collect())
    total, above, cut = sum(counts.values()), 0, None
    for s in sorted(counts, reverse=True):
        above += counts[s]
        if total * 10 ** (-s / STEPS_A_DECADE) <= rate * above:
            cut = s
    return stepped.filter(F.lit(False) if cut is None else F.col("like_random") & (F.col("_step") >= cut)).drop("_step")


def scan_secrets(docs: DataFrame, rate: float = 0.01, id_col: str = "doc_id", text_col: str = "text",
                 shapes: Sequence[tuple] = SHAPES) -> DataFrame:
    """One row per document: ``id_col`` and ``spans``, an array of (start,
    order, kind, end) sorted by start and kind, in code points.

    Kinds are those of ``shapes`` and "random". Null and empty texts have no
    spans; repeated rows are scanned each; other columns are ignored. Texts
    are read once; all that is kept of them is the matches.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    run = f"(?<![{RUN_CHARS}])[{RUN_CHARS}]{{{RUN_LENGTH},}}"
    columns = [_found(F.col("_text"), _ONLY_LONG.get(kind, pattern)).alias(kind) for kind, pattern, *_ in shapes]
    scanned = docs.select(id_col, text.alias("_text"))
    scanned = stored(scanned.select(F.monotonically_increasing_id().alias("row"), id_col, *columns,
                                    _found(F.col("_text"), run).alias("random")), "secret-matches")
    kinds = [k for k, *_ in shapes] + ["random"]
    spans = None
    for kind in kinds:
        places = _places(scanned, kind)
        if kind == "random":
            places = _apart(discoveries(stored(randomness(pieces(places)), "secret-tests"), rate))
        else:
            pattern, group, least = next(s[1:] for s in shapes if s[0] == kind)
            places = places.filter(F.length(F.regexp_extract("match", pattern, group)) >= least)
        places = places.select("row", F.col("start").cast("long").alias("start"), F.lit(kinds.index(kind)).alias("order"),
                               F.lit(kind).alias("kind"), F.col("end").cast("long").alias("end"))
        spans = places if spans is None else spans.unionByName(places)
    per_row = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "order", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start: bigint, order: int, kind: string, end: bigint>>")
    return scanned.select("row", id_col).join(per_row, "row", "left").select(id_col, F.coalesce("spans", none).alias("spans"))
