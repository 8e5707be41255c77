"""Operators that relate documents to each other, against brute force."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import common, components, decontaminate, line_dedup, mixing, queries, sharding, simhash
from tests.conftest import SF_SMALL
from tests.llm.test_row_operators import LONG, frame, odd_cases


def classes(n, edges):
    """Root of each of n nodes under union-find."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


# ---- connected components --------------------------------------------------

@pytest.mark.parametrize("shape", ["path", "stars", "random", "none"])
def test_components_match_union_find(spark, shape):
    rnd = random.Random(4)
    n = 200
    order = list(range(n))
    rnd.shuffle(order)
    edges = {"path": list(itertools.pairwise(order)), "stars": [(i % 5, i) for i in range(n)],
             "random": [(rnd.randrange(n), rnd.randrange(n)) for _ in range(120)], "none": []}[shape]
    df = spark.createDataFrame(edges + edges[:3], "a bigint, b bigint")
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    want = classes(n, edges)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: want[x] for x in linked}


def test_numbering_is_gapless(spark):
    rows = [(i % 3, i) for i in range(500)] + [(1, None)] * 300 + [(None, 5)] * 40  # hot repeated rows, a null group
    df = spark.createDataFrame(rows, "g int, k int")
    got = collections.defaultdict(list)
    for r in common.numbered(df, "g", ["k"], "slot", rows_per_bucket=50).collect():
        got[r.g].append(r.slot)
    assert {g: sorted(v) for g, v in got.items()} == {g: list(range(n)) for g, n in collections.Counter(r[0] for r in rows).items()}


def test_one_key_of_many_rows_is_dealt_over_the_buckets(spark):
    df = spark.range(20_000).select(F.lit(1).alias("g"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.xxhash64("id").alias("text"))
    out = common.numbered(df, "g", ["k"], "slot", rows_per_bucket=1000)
    slots = [r.slot for r in out.collect()]
    assert sorted(slots) == list(range(20_000))
    hot = sorted(r.slot for r in out.filter("k is null").collect())
    runs = 1 + sum(b != a + 1 for a, b in itertools.pairwise(hot))
    assert runs >= 20  # the null key's rows stand in each of the 20 buckets


# ---- SimHash ---------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_brute_force(spark):
    texts = ["A b C d É f", "a b", "one", "", None, " \t", "x y z " * 40, "the quick brown fox " * 3 + "\x1c jumps", LONG]
    got = {r.doc_id: r.fingerprint % 2**64 for r in simhash.fingerprints(frame(spark, texts)).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("distance,bucket", [(2, 32), (2, 3), (1, 3), (0, 32)])
def test_linking_matches_brute_force(spark, distance, bucket):
    rnd = random.Random(distance)
    prints = []
    for _ in range(12):  # dense clusters around centres, and chains from one to the next
        centre = rnd.getrandbits(64)
        for _ in range(20):
            x = centre
            for _ in range(rnd.randrange(4)):
                x ^= 1 << rnd.randrange(64)
            prints.append(x)
    prints += [0, 0, 1, 3, 2**63, 2**64 - 1] + prints[:10]
    rows = [(i, simhash._signed(x)) for i, x in enumerate(prints)]
    df = common.stored(spark.createDataFrame(rows, "doc_id bigint, fingerprint bigint"), "prints")
    edges = simhash.close_pairs(df.select("fingerprint").distinct(), distance, bucket)
    roots = {r.node: r.root for r in components.connected_components(edges).collect()}
    got = {}
    for i, x in rows:
        got.setdefault(roots.get(x, x), []).append(i)
    pairs = [(i, j) for i, j in itertools.combinations(range(len(prints)), 2) if (prints[i] ^ prints[j]).bit_count() <= distance]
    want = collections.defaultdict(list)
    for i, root in enumerate(classes(len(prints), pairs)):
        want[root].append(i)
    assert sorted(map(sorted, got.values())) == sorted(want.values())


@pytest.mark.parametrize("distance,masks", [(0, 1), (1, 4), (2, 10)])
def test_close_fingerprints_share_a_mask_and_others_hardly_meet(distance, masks):
    found = simhash.block_masks(distance)
    assert len(found) == masks
    for bits in itertools.combinations(range(64), distance):  # whichever bits differ, some mask has none of them
        assert any(not m & sum(1 << b for b in bits) for m in found)
    # unrelated fingerprints a bucket at 10^8, against the size from which midpoints are taken
    assert max(10**8 / 2 ** m.bit_count() for m in found) < simhash.PAIRWISE_BUCKET / 10_000


def test_component_ids_and_survivors(spark):
    docs = frame(spark, ["same text here now", "same text here now", "other words entirely apart", None, "", "same text here now", "same text here now"],
                 [5, 3, 8, 1, None, 3, None])
    found = simhash.near_duplicates(common.stored(simhash.fingerprints(docs), "p"))
    assert sorted((str(r.doc_id), r.component_id) for r in found.collect()) == \
        [("1", 1), ("3", 3), ("3", 3), ("5", 3), ("8", 8), ("None", 1), ("None", 3)]
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 8]
    assert simhash.deduplicate(docs.filter("doc_id < 0")).count() == 0


# ---- sharding --------------------------------------------------------------

def test_rendezvous_law(spark):
    docs = frame(spark, [f"t{i}" for i in range(4000)] + ["x", "x"], [*range(4000), None, None])
    rows = sharding.shard_slots(docs.select("doc_id", "text"), ["doc_id"], 16).collect()
    assert len(rows) == 4002 and all(r.grown_shard in (r.shard, 16) for r in rows)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    sizes = collections.Counter(r.shard for r in rows)
    assert min(sizes.values()) > 190 and max(sizes.values()) < 310
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    moved = sum(r.grown_shard == 16 for r in rows)
    assert 150 < moved < 330


def test_weighted_shards_and_all_columns(spark):
    docs = frame(spark, ["t"] * 6000).withColumn("shard", F.lit("old"))
    out = sharding.assign_shards(docs, ["doc_id"], 3, [1.0, 2.0, 3.0])
    share = {r.shard: r["count"] / 6000 for r in out.groupBy("shard").count().collect()}
    assert all(abs(share[k] - w / 6) < 0.03 for k, w in enumerate((1, 2, 3)))
    assert set(out.columns) == set(docs.columns)
    heavier = sharding.assign_shards(docs, ["doc_id"], 3, [1.0, 2.0, 4.0]).select("doc_id", F.col("shard").alias("after"))
    changed = out.join(heavier, "doc_id").filter("shard != after")
    assert changed.count() > 0 and changed.filter("after != 2").count() == 0  # records move to the heavier shard only
    assert sharding.assign_shards(docs.filter("doc_id < 0"), ["doc_id"], 3).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(docs, ["doc_id"], 2, [1.0])


# ---- decontamination -------------------------------------------------------

def brute_matches(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            iw = words(item_text)
            for k in range(max(1, len(iw) - size + 1) if iw else 0):
                window = iw[k : k + size]
                for s in range(len(w) - len(window) + 1):
                    if w[s : s + len(window)] == window:
                        hit |= set(range(s, s + len(window)))
                        found.add("null" if item is None else str(item))
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def contamination_case(spark):
    rnd = random.Random(9)
    vocabulary = [f"w{k}" for k in range(30)] + ["é", "Ab"]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [(i, text(rnd.choice([3, 9, 10, 25]))) for i in range(30)] + [(30, ""), (31, None), (None, text(12)), (5, text(11)), (40, "solo")]
    docs = []
    for i in range(60):
        parts = [text(rnd.randrange(30))]
        if i % 3 == 0:
            parts += [rnd.choice(items)[1] or "", text(5)]
        if i % 7 == 0:
            parts += ["solo", (rnd.choice(items)[1] or "").upper()]
        docs.append((i, ", ".join(parts)))
    docs += [(100, None), (101, ""), (102, LONG + " solo")]
    return docs, items, spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("words_a_pass", [200_000, 60])
def test_matches_equal_brute_force(spark, words_a_pass):
    docs, items, df, bench = contamination_case(spark)
    found = decontaminate.match_benchmark(df, bench, words_a_pass=words_a_pass).collect()
    got = {r.doc_id: (r.n_words, sum(s.words for s in r.spans), list(r["items"])) for r in found}
    assert got == brute_matches(docs, items) and len(found) == len(docs)


def test_proximity_and_removal(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    shuffled = "kappa filler alpha gamma beta delta theta epsilon eta iota zeta"
    docs = frame(spark, [item, shuffled, "alpha " + "filler " * 200 + "beta " + "filler " * 200 + "gamma", "clean words", None, item], [1, 2, 3, 4, 5, 1])
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = {r.doc_id: (list(r["items"]), list(r.near_items)) for r in decontaminate.match_benchmark(docs, bench).collect()}
    assert got == {1: (["7"], ["7"]), 2: ([], ["7"]), 3: ([], []), 4: ([], []), 5: ([], [])}
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 5]
    assert decontaminate.decontaminate(docs, bench.filter("item_id < 0")).count() == 6
    assert decontaminate.decontaminate(docs.filter("doc_id < 0"), bench).count() == 0


def test_proximity_is_the_same_in_any_segments(spark, monkeypatch):
    rnd = random.Random(12)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [(k, " ".join(rnd.sample(vocabulary, 12))) for k in range(20)]
    docs, copies = [(i, text(200)) for i in range(40)], {}
    for k, item in items:
        for place in range(12):  # each word replaced in turn, the original elsewhere in the corpus or nowhere
            words = item.split()
            words[place] = "replaced" if place % 2 else rnd.choice(vocabulary)
            copies[100 + 20 * k + place] = str(k)
            docs.append((100 + 20 * k + place, " ".join(words)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    near = lambda d, **kw: {r.doc_id: list(r.near_items) for r in decontaminate.match_benchmark(d, bench, **kw).collect()}
    one = near(df.coalesce(1))
    assert all(item in one[doc] for doc, item in copies.items())
    assert near(df.repartition(40)) == one and near(df.repartition(3), words_a_pass=60) == one


# ---- line dedup ------------------------------------------------------------

def brute_lines(docs, similarity=0.8):
    shingles = lambda line: frozenset(m[1] for m in re.finditer(r"(?s)(?<!\S)(?=(\S.{0,11}))", line))
    lines = [(i, n, raw.strip(" ").lower()) for i, text in docs for n, raw in enumerate((text or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    distinct = list(dict.fromkeys(x[2] for x in lines))
    sets = [shingles(x) for x in distinct]
    edges = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
             if sets[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    root = dict(zip(distinct, classes(len(distinct), edges)))
    seen, dropped = set(), collections.defaultdict(list)
    for i, n, line in lines:
        if root[line] in seen:
            dropped[i].append(n)
        seen.add(root[line])
    return {i: (sum(1 for x in lines if x[0] == i), dropped[i]) for i, _ in docs}


@pytest.mark.parametrize("bucket", [16, 2])
def test_line_classes_match_brute_force(spark, bucket):
    rnd = random.Random(6)
    base = [" ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(30)) for _ in range(8)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randrange(6)):
            words = rnd.choice(base).split()
            if rnd.random() < 0.5:
                words[rnd.randrange(30)] = "changed" + str(rnd.randrange(1000))
            line = " ".join(words)
            lines.append(line.upper() if rnd.random() < 0.2 else "  " + line)
        docs.append((i, "\n".join(lines + [""] * rnd.randrange(2))))
    docs += [(60, None), (61, ""), (62, "\n\n"), (63, "short\nshort\nSHORT")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_lines, list(r.dropped)) for r in line_dedup.dedup_lines(df, line_dedup.Matching(pairwise_bucket=bucket)).collect()}
    assert got == brute_lines(docs)


def test_line_dedup_takes_odd_rows(spark):
    out = line_dedup.dedup_lines(odd_cases(spark))
    rows = {(r.doc_id, r.n_lines, len(r.dropped)) for r in out.collect()}
    assert {(1, 0, 0), (2, 1, 0), (3, 1, 0)} <= rows or {(1, 0, 0), (2, 0, 0), (3, 1, 0)} <= rows
    assert sum(d for _, n, d in [(r.doc_id, r.n_lines, len(r.dropped)) for r in out.collect()]) >= 2  # "same text" stays once
    assert line_dedup.dedup_lines(odd_cases(spark).filter("doc_id < 0")).count() == 0


def test_every_character_shingles(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again and again"),
                                  (2, "the quick brown fox jumps over the lazy dog again and agaim"), (3, "nothing alike in here at all")],
                                 "doc_id bigint, text string")
    got = {r.doc_id: list(r.dropped) for r in line_dedup.dedup_lines(docs, line_dedup.Matching(shingle="(?=(.{5}))")).collect()}
    assert got == {1: [], 2: [0], 3: []}


def dense_lines(docs, similarity=0.8):
    """Lines to drop of documents of one line each, on five characters from
    every place, all pairs compared."""
    sets = [frozenset(line[i : i + 5] for i in range(max(1, len(line) - 4))) for line in (text.strip(" ").lower() for _, text in docs)]
    root = classes(len(sets), [(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
                               if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])])
    return {doc: [] if root[k] == k else [0] for k, (doc, _) in enumerate(docs)}


def test_urls_spaceless_and_typo_lines(spark):
    rnd = random.Random(11)
    typo = "fourteen common words stand in this line and one of them has a typo"
    han = "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(60))
    lines = ["https://www.example.com/news/2021/a.html", "https://www.other.org/shop?id=9", typo, typo.replace("stand", "stamd"),
             han, han[:12] + "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(48)), han[:59] + "\u4e01",
             "id,1234567890,aaaa,bbbb,cccc", "id,1234567890,xxxx,yyyy,zzzz", "abc", "abd", "ABC", "\U0001F642" * 9, "\U0001F642" * 8 + "\U0001F643"]
    docs = list(enumerate(lines))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: list(r.dropped) for r in line_dedup.dedup_lines(df).collect()}
    assert got == dense_lines(docs)
    assert sorted(i for i, dropped in got.items() if dropped) == [3, 6, 11]


def test_chains_in_one_large_bucket(spark):
    rnd = random.Random(13)

    def with_changes(line, places):
        return "".join(chr(ord("A") + k) if k in places else c for k, c in enumerate(line))

    lines = []
    for _ in range(2):
        leader = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=100))
        chain = [with_changes(leader, range(10, 10 + 10 * k, 5)) for k in (1, 2, 3, 4)]  # each like the next only
        lines += [leader, *[with_changes(leader, [40 + 3 * k]) for k in range(20)], *chain]
    how = line_dedup.WHOLE_LINES
    texts = spark.createDataFrame(list(enumerate(lines)), "id bigint, line string")
    members = texts.select(F.lit(1).cast("long").alias("key"), F.lit(len(lines)).cast("long").alias("n"), "id",
                           F.when(F.col("id") % 25 == 0, 100).otherwise(1).cast("long").alias("lines"))
    found = components.connected_components(line_dedup.similar_pairs(members, how, texts))
    roots = {r.node: r.root for r in found.collect()}
    shingles = [frozenset(line[i : i + 5] for i in range(96)) for line in lines]
    alike = lambda a, b: len(shingles[a] & shingles[b]) >= how.similarity * len(shingles[a] | shingles[b])
    assert alike(0, 21) and alike(21, 22) and not alike(0, 22)
    want = classes(len(lines), [(a, b) for a, b in itertools.combinations(range(len(lines)), 2) if alike(a, b)])
    assert [roots.get(k, k) for k in range(len(lines))] == want


def test_line_sets_keys_and_pairs_are_those_of_python_sets():
    how, rnd = line_dedup.WHOLE_LINES, random.Random(17)
    lines = ["", "a", "abcd", "abcde", "aaaaaaaa", "aaaaaaa", "\U0001F642" * 9, "x" * 70_000 + "y", "caf\u00e9 au lait"]
    lines += ["".join(rnd.choices("abc ", k=rnd.randrange(1, 200))) for _ in range(300)]
    sets = [{line[i : i + 5] for i in range(max(1, len(line) - 4))} if line else set() for line in lines]
    row, h = line_dedup.shingle_sets(lines, how)
    hashed = [set(h[row == k].tolist()) for k in range(len(lines))]
    assert [len(s) for s in hashed] == [len(s) for s in sets]
    assert all(len(hashed[a] & hashed[b]) == len(sets[a] & sets[b]) for a in range(20) for b in range(len(lines)))
    keys = line_dedup.band_keys(row, h, len(lines), how)
    assert [len(k) for k in keys] == [0 if not s else 1 if len(s) < 4 else how.bands for s in sets]
    assert keys[4].tolist() == keys[5].tolist() and keys[1].tolist() != keys[2].tolist()  # equal sets of different lines
    alone = line_dedup.band_keys(*line_dedup.shingle_sets(lines[9:10], how), 1, how)
    assert keys[9].tolist() == alone[0].tolist()  # whatever lines stand beside it
    pairs = [(a, b) for a in lines[1:60] for b in (a + "z", a[:-2], rnd.choice(lines[1:])) if b]
    want = [len(x & y) >= 0.8 * len(x | y) for x, y in (({p[i : i + 5] for i in range(max(1, len(p) - 4))} for p in pair) for pair in pairs)]
    assert line_dedup.alike(*map(list, zip(*pairs)), how).tolist() == want and 20 < sum(want) < len(want)


def test_empty_ranges_ask_filled_ones_in_turn():
    how, rnd = line_dedup.WHOLE_LINES, random.Random(31)
    lines = ["abcdef", "abcdefgh", *("".join(rnd.choices("abcd ", k=n)) for n in (6, 8, 9, 12, 20, 40, 90, 400))]
    row, h = line_dedup.shingle_sets(lines, how)
    bins, probes, got = how.bands * how.rows, line_dedup._probes(how.bands * how.rows), line_dedup.band_keys(row, h, len(lines), how)
    for k in range(len(lines)):
        least = {}
        for x in sorted(h[row == k].tolist()):
            least.setdefault((x >> 16) * bins >> 32, x)
        minima = [least[b] if b in least else next((least[a] for a in probes[:, b].tolist() if a in least), 0) for b in range(bins)]
        keys = []
        for band in range(how.bands):
            key = (band + 1) * int(line_dedup._STIR) % 2**64
            for x in minima[band * how.rows : (band + 1) * how.rows]:
                key = (key ^ x) * int(line_dedup._TURN) % 2**64
                key ^= key >> 31
            keys.append(key - 2**64 if key >> 63 else key)
        whole = xxhash.xxh64_intdigest(np.array(keys, np.int64).tobytes()) >> 1
        assert got[k].tolist() == ([whole] if (row == k).sum() < 4 else keys)


def test_texts_of_lines_are_read_without_python(spark):
    texts = ["  One LINE \n\n \n\u0130x \u03a3\u0391\u03a3 \n\ttab ", None, "", "one line\nother\n"]
    lines = {x for text in texts for x in (line.strip(" ").lower() for line in (text or "").split("\n")) if x}
    wanted = spark.createDataFrame([(line_dedup.line_id(x),) for x in sorted(lines) if x != "other"], "id long")
    found = line_dedup._texts(spark.createDataFrame([(x,) for x in texts], "text string"), common.stored(wanted, "wanted"), "text")
    assert {(r.id, r.line) for r in found.collect()} == {(line_dedup.line_id(x), x) for x in lines if x != "other"}
    assert found.count() == 3 and "InArrow" not in found._jdf.queryExecution().toString()


def test_lines_at_the_threshold_meet():
    how, rnd, met, near = line_dedup.WHOLE_LINES, random.Random(19), 0, 0
    for _ in range(1500):
        line = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=rnd.randrange(30, 300)))
        at = sorted(rnd.sample(range(len(line)), max(1, len(line) // 60)))
        other = "".join("0" if i in at else c for i, c in enumerate(line))
        if line_dedup.alike([line], [other], how)[0]:
            keys = line_dedup.band_keys(*line_dedup.shingle_sets([line, other], how), 2, how)
            near, met = near + 1, met + bool(set(keys[0].tolist()) & set(keys[1].tolist()))
    assert near > 500 and met >= 0.995 * near


def test_buckets_of_unlike_lines_lose_no_link(spark):
    """One bucket over the pairwise size, whose links avoid its centre."""
    rnd = random.Random(23)
    lines = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=80)) for _ in range(50)]
    lines += [line[:70] + "0123456789"[k % 10] + line[71:] for k, line in enumerate(lines[:40])]
    texts = spark.createDataFrame(list(enumerate(lines)), "id bigint, line string")
    members = texts.select(F.lit(1).cast("long").alias("key"), F.lit(len(lines)).cast("long").alias("n"), "id", F.lit(1).cast("long").alias("lines"))
    roots = {r.node: r.root for r in components.connected_components(line_dedup.similar_pairs(members, line_dedup.WHOLE_LINES, texts)).collect()}
    assert roots == {k: k % 50 for k in (*range(40), *range(50, 90))}


def test_bitmaps_rule_out_no_similar_pair(spark):
    how, rnd, pairs = line_dedup.WHOLE_LINES, random.Random(29), []
    for k in range(600):
        line = "".join(rnd.choices("abcdefghij ", k=rnd.choice([1, 4, 30, 80, 300, 1500])))
        at = set(rnd.sample(range(len(line)), rnd.randrange(1 + len(line) // 40)))
        near = "".join("0" if i in at else c for i, c in enumerate(line)) + "xyzw"[: rnd.randrange(5)] * rnd.randrange(1 + len(line) // 30)
        pairs.append((line, near if k % 2 else "".join(rnd.choices("abcdefghij ", k=len(line)))))
    sets = [[{x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in pair] for pair in pairs]
    bits = [line_dedup.parity_bits(*line_dedup.shingle_sets([x], how), 1)[0] for pair in pairs for x in pair]
    assert all(64 * len(b) >= len(s) and len(b) & (len(b) - 1) == 0 for b, s in zip(bits, itertools.chain(*sets)))
    for k, (x, y) in enumerate(sets):
        if len(bits[2 * k]) == len(bits[2 * k + 1]):
            assert sum(int(w).bit_count() for w in (bits[2 * k] ^ bits[2 * k + 1]).view("uint64")) <= len(x ^ y)
    texts = spark.createDataFrame([(k, x) for k, x in enumerate(itertools.chain(*pairs))], "id bigint, line string")
    met = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(len(pairs))], "a bigint, b bigint")
    prints = line_dedup._prints(texts, how)
    left = {r.a // 2 for r in line_dedup.possible_pairs(met, prints.union(prints), how).collect()}  # repeats of an id give no more rows
    alike = {k for k, (x, y) in enumerate(sets) if len(x & y) >= 0.8 * len(x | y)}
    assert len(alike) > 100 and alike <= left
    assert len(left - alike) < 0.15 * (len(pairs) - len(alike))
    assert line_dedup.possible_pairs(met, prints.union(prints), how).count() == len(left)


def test_texts_are_read_for_lines_that_may_pair_only(spark):
    rnd = random.Random(31)
    lines = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=120)) for _ in range(20)]
    lines += [lines[3][:60] + "0" + lines[3][61:], "", lines[3]]
    frame = spark.createDataFrame(list(enumerate(lines)), "id bigint, line string")
    members = spark.createDataFrame([(1, 21, k) for k in range(21)], "key bigint, n bigint, id bigint")
    asked = []

    def texts(wanted):
        asked.extend(sorted(r.id for r in wanted.collect()))
        return frame.join(wanted, "id", "left_semi")

    found = line_dedup.similar_pairs(members, line_dedup.WHOLE_LINES, texts, line_dedup._prints(frame, line_dedup.WHOLE_LINES))
    assert [(r.a, r.b) for r in found.collect()] == [(3, 20)] and asked == [3, 20]


@pytest.mark.parametrize("most", [32, 1024])
def test_large_buckets_by_bitmaps_and_by_rarest_shingles(spark, most):
    """Pairs whose links avoid the centre, in one bucket on either side of ``bitmap_bucket``."""
    rnd = random.Random(37)
    lines = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=80)) for _ in range(30)]
    lines += [line[:70] + "0" + line[71:] for line in lines[:20]]
    texts = spark.createDataFrame(list(enumerate(lines)), "id bigint, line string")
    members = texts.select(F.lit(1).cast("long").alias("key"), F.lit(len(lines)).cast("long").alias("n"), "id")
    how = line_dedup.Matching(shingle=5, bitmap_bucket=most)
    roots = {r.node: r.root for r in components.connected_components(line_dedup.similar_pairs(members, how, texts)).collect()}
    assert roots == {k: k % 30 for k in (*range(20), *range(30, 50))}


def test_texts_beyond_the_broadcast_bound_shuffle_few_other_lines(spark, monkeypatch):
    ids = spark.range(20_000).select(F.xxhash64("id").alias("id"), F.col("id").alias("n"))
    wanted = ids.filter("n % 40 = 7").select("id")
    passed = {r.n for r in line_dedup._maybe_in(ids, wanted).select("n").collect()}
    assert set(range(7, 20_000, 40)) <= passed and len(passed) < 500 + 0.02 * 19_500
    crowded = {r.n for r in line_dedup._maybe_in(ids, wanted, max_bytes=256).select("n").collect()}  # too few bits: others pass, none is lost
    assert passed < crowded
    monkeypatch.setattr(line_dedup, "broadcast_if_small", lambda df: df)
    docs = spark.createDataFrame([("\n".join(f"Line {k % 900} of the text" for k in range(at, at + 30)),) for at in range(0, 3000, 10)], "text string")
    wanted = spark.createDataFrame([(line_dedup.line_id(f"line {k} of the text"),) for k in range(0, 900, 50)], "id long")
    found = line_dedup._texts(docs, wanted, "text")
    assert {r.line for r in found.collect()} == {f"line {k} of the text" for k in range(0, 900, 50)} and found.count() == 18
    scan = found._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")
    assert any("BroadcastHashJoin" in below and "LeftSemi" in below and "xxhash64" in below for below in scan)  # lines go before the shuffle


def test_pairs_of_buckets_are_made_in_passes(spark):
    """No pass has many more rows than asked for, no bucket is cut, and pairs that bitmaps rule out are in no join's result."""
    how, rnd = line_dedup.WHOLE_LINES, random.Random(41)
    lines = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=90)) for _ in range(40)]
    lines += [line[:50] + "0" + line[51:] for line in lines[:10]]
    own = line_dedup._prints(spark.createDataFrame(list(enumerate(lines)), "id bigint, line string"), how)
    buckets = {key: rnd.sample(range(50), 20) for key in range(-30, 30)} | {30: range(50)}
    members = spark.createDataFrame([(key, len(b), k) for key, b in buckets.items() for k in b], "key bigint, n bigint, id bigint")
    centres = spark.createDataFrame([(30, 3)], "key bigint, id bigint")
    rows = []

    def pairs(some):
        rows.append(some.count())
        return line_dedup.near_pairs(some, own, centres, how)

    got = sorted((r.a, r.b) for r in line_dedup._in_passes(members, 150, pairs, "line-test").collect())
    assert len(rows) == 9 and sum(rows) == 60 * 20 + 50 and max(rows) <= 2 * 150
    assert got == sorted({(k, k + 40) for k in range(10) if k == 3 or any(k in b and k + 40 in b for key, b in buckets.items() if key < 30)})
    assert line_dedup.near_pairs(members, own, centres, how).distinct().count() == len(got)
    placed = members.filter("key < 30").withColumn("part", F.when(F.col("id") % 40 == 4, 0).otherwise(F.col("id")))
    assert {(r.a, r.b) for r in line_dedup.bucket_pairs(placed, own, how).collect()} == {p for p in got if p[0] != 4 and p in {
        (k, k + 40) for k in range(10) for key, b in buckets.items() if key < 30 and k in b and k + 40 in b}}


def test_line_repeats_over_tasks_and_null_ids(spark):
    text = "one line that stands in many documents\n\nanother line, in all of them as well"
    docs = [(k if k % 5 else None, text if k % 3 else text + " but for this") for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    got = [(r.doc_id, r.n_lines, list(r.dropped)) for r in line_dedup.dedup_lines(df).collect()]
    assert len(got) == 40 and all(n == 2 for _, n, _ in got)
    assert sorted((doc, dropped) for doc, _, dropped in got if dropped != [0, 2]) == [(1, []), (3, [0])]


# ---- mixing ----------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        rate = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > most * sizes[s]}
        if not over:
            target |= {s: rate * weight[s] for s in free}
            break
        target |= {s: most * sizes[s] for s in over}
        free -= over
    return target


def test_targets_match_brute_force(spark):
    rnd = random.Random(8)
    for n in (1, 2, 7, 40):
        sizes = {f"s{k}é" if k % 2 else f"S{k}": rnd.randrange(0, 5000) for k in range(n)} | {None: 300, "": 10}
        df = spark.createDataFrame([(s, v, 1) for s, v in sizes.items()], "source string, size bigint, units bigint")
        got = {r.source: r.target for r in mixing.source_targets(df, (5, 2, 1)).collect()}
        assert got == pytest.approx(brute_targets(sizes))
    assert mixing.source_targets(df.filter("size < 0"), (5, 2, 1)).count() == 0


def test_flight_keeps_totals_and_expectations():
    rnd = np.random.default_rng(3)
    x = rnd.integers(1, 400, 60).astype(float)
    p = rnd.uniform(0.05, 0.95, 60)
    runs = np.array([mixing.flight(p, x, np.random.default_rng(k)) for k in range(1500)])
    assert np.allclose(runs.sum(axis=1), p.sum()) and np.allclose(runs @ x, p @ x)
    assert ((runs > 0) & (runs < 1)).sum(axis=1).max() <= 2
    assert np.abs(runs.mean(axis=0) - p).max() < 0.06
    same = mixing.flight(np.full(9, 0.5), np.full(9, 7.0), np.random.default_rng(1))
    assert ((same > 0) & (same < 1)).sum() <= 1
    settled = mixing.settle(p, x, np.random.default_rng(1))
    assert set(np.unique(settled)) <= {0.0, 1.0} and abs(settled @ x - p @ x) < 5


def mixing_units(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "c", None]), rnd.choice([0, 3, 50, 400, 2000])) for i in range(900)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, source string, size bigint, units bigint")


def test_mix_meets_targets_and_reruns_agree(spark):
    rows, units = mixing_units(spark)
    mixed = mixing.mix_units(units, ["doc_id"]).collect()
    assert len(mixed) == 900 and max(r.copies for r in mixed) <= 2
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in mixed:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        size[r.source] += r.size
    assert all(abs(taken[s] - target[s]) < 250 for s in target)
    assert target == pytest.approx(brute_targets(size))
    plain = sorted((r.doc_id, r.copies) for r in mixed)
    again = mixing.mix_units(units.repartition(7), ["doc_id"])
    assert sorted((r.doc_id, r.copies) for r in again.collect()) == plain
    blocks = mixing.balanced_copies(units, mixing.source_targets(units, (5, 2, 1)), ["doc_id"], units_a_block=20).collect()
    for s in target:
        # tiny blocks leave few units to land on: within half the largest document
        assert abs(sum(r.copies * r.size for r in blocks if r.source == s) - target[s]) <= 1000


def test_mix_documents_repeats_whole_rows(spark):
    docs = frame(spark, ["one two three", "four", None, "", "five six", "five six", "five six"], [1, 2, 3, None, 9, 9, 9])
    docs = docs.withColumn("copies", F.lit("mine")).withColumn("units", F.lit(1))
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns and max(r["count"] for r in out.filter("doc_id < 9").groupBy("doc_id").count().collect()) <= 2
    assert out.filter("doc_id = 9").count() in (3, 4, 5, 6)
    assert out.exceptAll(docs.union(docs)).count() == 0
    assert mixing.mix_documents(docs.filter("doc_id < 0")).count() == 0


# ---- pipeline and queries --------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = common.read_table(spark, SF_SMALL, "documents")
    ids = lambda d: collections.Counter(r.doc_id for r in d.collect())
    state, seen = docs, {}
    for name, stage in P.STAGES:
        after = common.stored(stage(spark, state, SF_SMALL), "stage")
        if name != "sharding":
            assert after.schema.simpleString() == docs.schema.simpleString(), name
        if name in ("toxicity", "near_duplicates", "decontamination"):
            assert not ids(after) - ids(state)
        seen[name], state = ids(after), after
    prints = collections.Counter(r.component_id for r in simhash.near_duplicates(
        common.stored(simhash.fingerprints(docs.filter(F.col("doc_id").isin(list(seen["toxicity"])))), "p")).collect())
    assert len(seen["near_duplicates"]) == len(prints)
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in common.read_table(spark, SF_SMALL, "benchmark").collect()]
    hit = {d for d, (_, n, _) in brute_matches([(d, texts[d]) for d in seen["near_duplicates"]], items).items() if n}
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) == hit
    assert seen["sharding"] == seen["mixing"] and state.columns == [*docs.columns, "shard"]
    assert ids(P.run(spark, SF_SMALL)) == seen["sharding"]


def test_pipeline_of_an_empty_table(spark):
    import corpus_pipeline as P

    empty = common.read_table(spark, SF_SMALL, "documents").filter("doc_id < 0")
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


@pytest.mark.parametrize("name", ["op4_simhash", "op5_sharding", "op8_line_dedup", "op9_decontamination", "op10_mixing"])
def test_queries_return_every_document(spark, name):
    docs = common.read_table(spark, SF_SMALL, "documents")
    rows = queries.QUERIES[name](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_decontamination_matches_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(queries.ORACLES["op9_decontamination"]).df().sort_values("doc_id")
    got = queries.QUERIES["op9_decontamination"](spark, SF_SMALL).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and want["n_near"].sum() > want["n_items"].sum() > 0
    got = got[list(want.columns)].sort_values("doc_id")
    assert got.values.tolist() == want.values.tolist()
