"""License scan by diagonal voting, with DataFrame functions only.

Every rolling word k-gram of a text is hashed and joined with the positions of
the templates' k-grams. A match votes for the diagonal (place in the text
minus place in the template) on which a copy of the template would lie; votes
are added up per diagonal, neighbouring diagonals are merged (words put in or
left out shift the rest of a copy to another one), and a span counts if its
verified votes cover enough of the template.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import ALNUM_WORD, ascii_lower, stored


@dataclass(frozen=True)
class Template:
    """Words that announce a license. ``exact`` templates (phrases) must stand
    word for word; others need ``coverage`` of their k-grams."""

    name: str
    label: str
    text: str
    exact: bool = False
    coverage: float = 0.6


#: Phrases of the base. Fixed values.
PHRASES = (
    Template("phrase-gpl", "gpl", "gnu general public license", exact=True),
    Template("phrase-apache", "apache", "apache license", exact=True),
    Template("phrase-cc-by", "cc-by", "cc by", exact=True),
    Template("phrase-mit", "mit", "mit license", exact=True),
)
#: Names that identify a license. They must stand whole: a word less and they
#: would name another version. Fixed values.
NAMES = tuple(Template(f"name-{k}", label, text, coverage=1.0) for k, (label, text) in enumerate((
    ("gpl-3.0", "gnu general public license version 3"), ("gpl-3.0", "gnu general public license v3"),
    ("gpl-3.0", "gnu gpl version 3"), ("gpl-3.0", "gnu gpl v3"),
    ("gpl-2.0", "gnu general public license version 2"), ("gpl-2.0", "gnu general public license v2"),
    ("gpl-2.0", "gnu gpl version 2"), ("gpl-2.0", "gnu gpl v2"),
    ("lgpl", "gnu lesser general public license"), ("agpl", "gnu affero general public license"),
    ("apache-2.0", "apache license version 2 0"), ("apache-2.0", "apache license 2 0"),
    ("bsd-3-clause", "bsd 3 clause"), ("bsd-2-clause", "bsd 2 clause"),
    ("mpl-2.0", "mozilla public license 2 0"), ("mpl-2.0", "mozilla public license version 2 0"),
    ("epl-2.0", "eclipse public license 2 0"), ("epl-2.0", "eclipse public license v 2 0"),
    ("cc-by", "creative commons attribution 4 0"), ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-nc", "cc by nc"), ("cc-by-nc", "creative commons attribution noncommercial"), ("cc0-1.0", "cc0 1 0 universal"),
)))
#: License identifiers of source files, without their "-only" and "-or-later",
#: and the label of each. Fixed values.
SPDX = (("GPL-2.0", "gpl-2.0"), ("GPL-3.0", "gpl-3.0"), ("LGPL-2.1", "lgpl"), ("LGPL-3.0", "lgpl"), ("AGPL-3.0", "agpl"),
        ("MIT", "mit"), ("Apache-2.0", "apache-2.0"), ("BSD-2-Clause", "bsd-2-clause"), ("BSD-3-Clause", "bsd-3-clause"),
        ("MPL-2.0", "mpl-2.0"), ("ISC", "isc"), ("EPL-2.0", "epl-2.0"), ("CC-BY-4.0", "cc-by"), ("CC-BY-SA-4.0", "cc-by-sa"),
        ("CC0-1.0", "cc0-1.0"), ("Unlicense", "unlicense"))
IDENTIFIERS = tuple(Template(f"spdx-{name}", label, "spdx license identifier " + name.lower().replace("-", " ").replace(".", " "), coverage=1.0)
                    for name, label in SPDX)
#: Sentences of licenses and of their notices. Fixed values.
NOTICES = (
    Template("apache-2-notice", "apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of "
             "the license at http www apache org licenses license 2 0"),
    Template("mit-notice", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files the software to deal in the software without restriction"),
    Template("mit-condition", "mit", "the above copyright notice and this permission notice shall be included in all copies or "
             "substantial portions of the software"),
    Template("isc-notice", "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
             "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("gpl-notice", "gpl", "this program is free software you can redistribute it and or modify it under the terms of "
             "the gnu general public license as published by the free software foundation"),
    Template("bsd-notice", "bsd", "redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met"),
    Template("bsd-3-condition", "bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to "
             "endorse or promote products derived from this software without specific prior written permission"),
    Template("mpl-notice", "mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("cc-by-notice", "cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("unlicense-notice", "unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Words of a k-gram: templates of under ``LONG_WORDS`` words have 2, others 4.
SHORT_GRAM, LONG_GRAM, LONG_WORDS = 2, 4, 9
#: Diagonals this close belong to one copy wherever their votes lie.
MERGE_DIAGONALS = 3


def _gram(t: Template) -> int:
    return SHORT_GRAM if t.exact or len(t.text.split()) < LONG_WORDS else LONG_GRAM


def template_positions(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per template k-gram: its hash, words, place and template. Its
    size is the templates', a library constant."""
    rows = []
    for t in templates:
        words, k = t.text.split(), _gram(t)
        if len(words) < k:
            raise ValueError(f"template {t.name} has fewer than {k} words")
        grams = len(words) - k + 1
        rows += [F.struct(*[F.lit(v).alias(name) for name, v in (
            ("k", k), ("gram", " ".join(words[i : i + k])), ("place", i), ("template", t.name), ("label", t.label),
            ("exact", t.exact), ("template_words", len(words)), ("grams", grams), ("coverage", t.coverage))]) for i in range(grams)]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    word = lambda i: F.split_part("gram", F.lit(" "), F.lit(i))
    g2 = lambda i: F.xxhash64(word(i), word(i + 1))
    return table.withColumn("hash", F.when(F.col("k") == SHORT_GRAM, g2(1)).otherwise(F.xxhash64(g2(1), g2(3))))


def _candidates(words: Column, hashes: Column, k: int, wanted: list[int]) -> Column:
    """(k, position, hash, words) of the rolling hashes that some template has."""
    at = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.get(hashes, i).isin(wanted))
    return F.when(F.size(hashes) > 0, F.transform(at, lambda i: F.struct(
        F.lit(k).alias("k"), i.alias("position"), F.get(hashes, i).alias("hash"),
        F.concat_ws(" ", F.slice(words, i + 1, F.lit(k))).alias("gram"))))


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = PHRASES + NAMES + IDENTIFIERS + NOTICES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_words and ``places``, an array of
    (template, label, exact, first word, words, coverage), in order.

    Words are runs of ASCII digits, letters (A-Z folded) and anything beyond
    ASCII. Null and empty texts have no words and no places; repeated rows are
    scanned each; other columns are ignored. Texts are read once; what is kept
    of them is the k-grams that occur in a template. A text of many copies of a
    template gives one place per copy.

    A diagonal's votes go to the same copy as those before them in the text if
    the diagonals are at most ``MERGE_DIAGONALS`` apart; or if they go on in the
    template where those ended, with fewer words put in between than half the
    template has.
    """
    spark = docs.sparkSession
    positions = template_positions(spark, templates)
    known = {(r["k"], r["hash"]) for r in positions.select("k", "hash").distinct().collect()}
    split = docs.select(id_col, F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(ALNUM_WORD), F.lit(0)).alias("w"))
    tail = lambda of, n: F.slice(of, n + 1, F.greatest(F.size(of) - n, F.lit(0)))
    split = split.withColumn("g2", F.slice(F.zip_with("w", tail(F.col("w"), 1), lambda a, b: F.xxhash64(a, b)), 1, F.greatest(F.size("w") - 1, F.lit(0))))
    split = split.withColumn("g4", F.slice(F.zip_with("g2", tail(F.col("g2"), 2), lambda a, b: F.xxhash64(a, b)), 1, F.greatest(F.size("w") - 3, F.lit(0))))
    found = [_candidates(F.col("w"), F.col(g), k, [h for kk, h in known if kk == k] or [0])
             for g, k in (("g2", SHORT_GRAM), ("g4", LONG_GRAM))]
    empty = F.array().cast("array<struct<k: int, position: int, hash: bigint, gram: string>>")
    scanned = stored(split.select(F.monotonically_increasing_id().alias("row"), id_col, F.size("w").cast("long").alias("n_words"),
                                  F.concat(*[F.coalesce(f, empty) for f in found]).alias("grams")), "license-grams")

    grams = scanned.filter(F.size("grams") > 0).select("row", F.explode("grams").alias("g")).select("row", "g.*")
    votes = grams.join(F.broadcast(positions), ["k", "hash", "gram"])  # the words too: a vote is verified
    diagonals = (votes.withColumn("diagonal", F.col("position") - F.col("place"))
                 .groupBy("row", "template", "label", "exact", "template_words", "grams", "coverage", "diagonal")
                 .agg(F.count(F.lit(1)).alias("votes"), F.min("position").alias("first"), F.max("position").alias("last"),
                      F.min("place").alias("from"), F.max("place").alias("to"),
                      F.max("k").alias("k")))
    whole = diagonals.filter(F.col("exact") & (F.col("votes") == F.col("grams")))
    exact = whole.select("row", "template", "label", "exact", F.col("first").cast("long").alias("first"),
                         F.col("template_words").cast("long").alias("words"), F.lit(1.0).alias("part"))
    by = Window.partitionBy("row", "template").orderBy("first", "diagonal")
    shift = F.abs(F.col("diagonal") - F.lag("diagonal").over(by))
    goes_on = (F.col("from") > F.lag("to").over(by)) & (F.col("first") - F.lag("last").over(by) - F.col("k") < F.col("template_words") / 2)
    same = F.coalesce((shift <= MERGE_DIAGONALS) | goes_on, F.lit(False))
    copies = (diagonals.filter(~F.col("exact")).withColumn("copy", F.sum((~same).cast("int")).over(by))
              .groupBy("row", "template", "label", "exact", "grams", "coverage", "copy")
              .agg(F.least(F.sum("votes"), F.col("grams")).alias("votes"), F.min("first").alias("first"),
                   F.max(F.col("last") + F.col("k")).alias("end")))
    part = F.col("votes") / F.col("grams")
    loose = copies.filter(part >= F.col("coverage")).select(
        "row", "template", "label", "exact", F.col("first").cast("long").alias("first"),
        (F.col("end") - F.col("first")).cast("long").alias("words"), part.cast("double").alias("part"))
    places = exact.unionByName(loose).groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("first", "words", "template", "label", "exact", "part"))).alias("places"))
    none = F.array().cast("array<struct<first: bigint, words: bigint, template: string, label: string, exact: boolean, part: double>>")
    return scanned.join(places, "row", "left").select(id_col, "n_words", F.coalesce("places", none).alias("places"))
