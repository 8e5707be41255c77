"""Registered queries of the training-data operators, with DuckDB SQL for the
ones that SQL can express. Each applies its operator to whole tables and
derives the digest columns from the operator's own output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (decontaminate, license_scan, line_dedup, merkle, minhash, mixing, quality_rules, secret_scan, sharding, simhash, spelling,
                        token_count, toxicity)
from strata.llm.common import read_table, stored


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["exact"])
    names = lambda places: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))))
    starts = F.transform(base, lambda p: p["first"])
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names(F.col("places")).alias("labels"),
                        F.coalesce(F.array_max(F.transform("places", lambda p: p["part"])), F.lit(0.0)).alias("score"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", number("assign"), number("access"), number("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), number("random"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stored(simhash.fingerprints(read_table(spark, sf_dir, "documents"), shingle_words=3), "simhash-prints")
    found = simhash.near_duplicates(prints, max_distance=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    records = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    return sharding.shard_slots(records, ["doc_id"], 16).withColumn("law", F.lit("key"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    lexicon = toxicity.learn_lexicon(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, lexicon).select(
        "doc_id", (~toxicity.in_training(F.col("doc_id"))).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_hits")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                    public_tokenizers.PATTERN, max_tokens=1024)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.concat_ws(",", F.col("dropped").cast("array<string>")).alias("dropped"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.match_benchmark(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
                        F.size("near_items").cast("long").alias("n_near"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    units = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("units"))
    mixed = mixing.mix_units(units, ["doc_id"])
    n, extra = F.col("units"), F.pmod("copies", "units")
    row = F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("row")
    return (mixed.select("*", row).withColumn("times", F.floor(F.col("copies") / n) + F.when(F.col("row") <= extra, 1).otherwise(0))
            .select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).cast("long").alias("taken")))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read_table(spark, sf_dir, "documents"), minhash.Banding(shingle_words=5, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(read_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], group="source", order="doc_id",
                           changed={"text": tampered}, fanout=3)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.word_runs(read_table(spark, sf_dir, "documents"), min_length=7)
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    seen = runs.withColumn("h", h).select(F.when(F.col("h") % 31 == 0, spelling.without(F.col("run"), F.col("h") % F.length("run"))).otherwise(F.col("run")).alias("word"))
    words = seen.filter(F.length("word") >= 7).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return spelling.spelling_variants(stored(words, "spelling-words"), ratio=10).select("word", "n", "n_near", "form", "form_n", "root")


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_secret_scan, op3_quality_rules, op4_simhash, op5_sharding, op6_toxicity, op7_token_counts,
                                   op8_line_dedup, op9_decontamination, op10_mixing, op11_minhash, op12_merkle_manifest,
                                   op13_spelling_variants)}

_WORDS9 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_WORDS11 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
#: Unsigned CRC-32 in SQL: the remainders of single bytes, and a text's bytes folded over them.
_CRC_TABLE = """crc_steps AS (SELECT b, b AS v, 0 AS k FROM (SELECT unnest(range(256)) AS b)
                   UNION ALL
                   SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM crc_steps WHERE k < 8),
     crc_table AS (SELECT list(v ORDER BY b) AS remainders FROM crc_steps WHERE k = 8)"""


def _crc(text: str) -> str:
    data = f"list_transform(range(strlen({text})), lambda i: ('0x' || substring(hex({text}), 2 * i::INT + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda a, b: xor(a // 256, remainders[xor(a, b) % 256 + 1])), 4294967295)"


def _leaf(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


ORACLES = {
    "op9_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS9} AS w FROM documents),
     b AS (SELECT CASE WHEN item_id IS NULL THEN 'null' ELSE item_id::VARCHAR END AS item, {_WORDS9} AS w FROM benchmark),
     bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT n FROM bw),
     dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
     hit AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
     places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
     items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r),
     terms AS (SELECT DISTINCT g, unnest(string_split(g, ' ')) AS term FROM bw),
     dp AS (SELECT r, p, term FROM (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS term FROM d) SEMI JOIN terms USING (term)),
     freq AS (SELECT term, count(*) AS f FROM dp GROUP BY term),
     ranked AS (SELECT g, term, row_number() OVER (PARTITION BY g ORDER BY coalesce(f, 0), term) AS k FROM terms LEFT JOIN freq USING (term)),
     owned AS (SELECT DISTINCT x.term AS t1, y.term AS t2, z.term AS t3, item
               FROM ranked x JOIN ranked y ON y.g = x.g AND x.k < y.k JOIN ranked z ON z.g = y.g AND y.k < z.k AND z.k <= 4 JOIN bw ON bw.g = x.g),
     met AS (SELECT DISTINCT r, t1, t2, t3 FROM dp JOIN (SELECT DISTINCT t1, t2, t3 FROM owned) ON dp.term = t1
             WHERE EXISTS (SELECT 1 FROM dp o WHERE o.r = dp.r AND o.term = t2 AND o.p BETWEEN dp.p - 30 AND dp.p + 30)
               AND EXISTS (SELECT 1 FROM dp o WHERE o.r = dp.r AND o.term = t3 AND o.p BETWEEN dp.p - 30 AND dp.p + 30)),
     near AS (SELECT r, count(DISTINCT item) AS n_near FROM met JOIN owned USING (t1, t2, t3) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r) LEFT JOIN near USING (r)
""",
    "op11_minhash": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS11} AS w FROM documents),
     sh AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g
            FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
     n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
     common AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.r < y.r GROUP BY x.r, y.r),
     links AS (SELECT a, b FROM common JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
     arcs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
     reach AS (SELECT r, r AS other FROM d UNION SELECT reach.r, arcs.b FROM reach JOIN arcs ON arcs.a = reach.other),
     least AS (SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.r = reach.other GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN least USING (r) LEFT JOIN n USING (r)
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE {_CRC_TABLE},
     d AS (SELECT coalesce('s' || source, 'n') AS src, doc_id, {_leaf("text")} AS leaf,
                  CASE WHEN {_crc("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS other
           FROM documents, crc_table),
     placed AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY src) AS cnt FROM d),
     nodes AS (SELECT 0 AS lvl, src, pos, leaf AS h, cnt FROM placed
               UNION ALL
               SELECT lvl + 1, src, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (cnt + 2) // 3 FROM nodes WHERE cnt > 1 GROUP BY lvl, src, pos // 3, cnt),
     subroots AS (SELECT src, h AS subroot, lvl AS height, row_number() OVER (ORDER BY src) - 1 AS pos, count(*) OVER () AS cnt FROM nodes WHERE cnt = 1),
     tops AS (SELECT 0 AS lvl, pos, subroot AS h, cnt FROM subroots
              UNION ALL
              SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (cnt + 2) // 3 FROM tops WHERE cnt > 1 GROUP BY lvl, pos // 3, cnt),
     top AS (SELECT h AS root FROM tops WHERE cnt = 1),
     steps AS (SELECT p.src, p.pos AS leaf_pos, n.lvl, coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos < p.pos // (3 ** n.lvl)::BIGINT), '') AS before,
                      coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos > p.pos // (3 ** n.lvl)::BIGINT), '') AS after
               FROM placed p JOIN nodes n ON n.src = p.src AND n.cnt > 1 AND n.pos // 3 = p.pos // (3 ** (n.lvl + 1))::BIGINT
               GROUP BY p.src, p.pos, n.lvl),
     top_steps AS (SELECT s.src, s.height + t.lvl AS lvl, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (WHERE t.pos < s.pos // (3 ** t.lvl)::BIGINT), '') AS before,
                          coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (WHERE t.pos > s.pos // (3 ** t.lvl)::BIGINT), '') AS after
                   FROM subroots s JOIN tops t ON t.cnt > 1 AND t.pos // 3 = s.pos // (3 ** (t.lvl + 1))::BIGINT
                   GROUP BY s.src, s.height, t.lvl),
     every AS (SELECT * FROM steps UNION ALL SELECT p.src, p.pos, t.lvl, t.before, t.after FROM placed p JOIN top_steps t USING (src)),
     folded AS (SELECT src, pos, 0 AS lvl, other AS h FROM placed
                UNION ALL
                SELECT f.src, f.pos, f.lvl + 1, sha256(e.before || f.h || e.after) FROM folded f JOIN every e ON e.src = f.src AND e.leaf_pos = f.pos AND e.lvl = f.lvl),
     ends AS (SELECT src, pos, max_by(h, lvl) AS folded_root FROM folded GROUP BY src, pos),
     proofs AS (SELECT src, leaf_pos AS pos, string_agg(before || after, '' ORDER BY lvl) AS proof FROM every GROUP BY src, leaf_pos)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN (SELECT src, subroot FROM subroots) USING (src) JOIN ends USING (src, pos) LEFT JOIN proofs USING (src, pos), top
""",
    "op13_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE},
     runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run
              FROM documents),
     hashed AS (SELECT run, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc_table WHERE length(run) >= 7),
     seen AS (SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
     words AS (SELECT word, count(*) AS n FROM seen WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
     cuts AS (SELECT word, i, substring(word, 1, i) || substring(word, i + 2) AS rest FROM (SELECT word, unnest(range(0, length(word)))::INT AS i FROM words)),
     near AS (SELECT x.word AS a, y.word AS b FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
              UNION SELECT x.word, y.word FROM cuts x JOIN words y ON x.rest = y.word
              UNION SELECT y.word, x.word FROM cuts x JOIN words y ON x.rest = y.word),
     ranked AS (SELECT a AS word, b, o.n AS other_n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY o.n DESC, b) AS k
                FROM near JOIN words o ON o.word = near.b),
     found AS (SELECT words.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * n THEN b END AS form,
                      CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
               FROM words LEFT JOIN ranked ON ranked.word = words.word AND k = 1),
     walk AS (SELECT word, word AS root, form AS next FROM found UNION ALL SELECT walk.word, found.word, found.form FROM walk JOIN found ON found.word = walk.next)
SELECT found.word, n, n_near, found.form, form_n, walk.root FROM found JOIN walk ON walk.word = found.word AND walk.next IS NULL
""",
}
