"""MinHash near-duplicates, Merkle manifest and spelling variants against brute
force, on odd rows, and their SQL."""

import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from strata.llm import merkle, minhash, queries, spelling

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, lang string, n_chars long, id string, key string, grp string, word string, position int"


def docs(spark, rows):
    """Documents with extra columns named like the operators' own."""
    filled = [(i, t, s, l, n, "x", "y", "z", "w", 1) for i, t, s, l, n in rows]
    return spark.createDataFrame(filled, DOCS)


# ---- MinHash ---------------------------------------------------------------

def near_texts(seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([6, 9, 12, 60, 200]))]
        for _ in range(rng.choice([1, 2, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out


def word_sets(texts, k=5):
    out = []
    for text in texts:
        w = (text or "").lower().split()
        out.append({" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def least_reachable(ids, sets, percent=85):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(ids)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            parent[find(a)] = find(b)
    groups = {}
    for k in range(len(ids)):
        groups.setdefault(find(k), []).append(ids[k])
    return [min((i for i in groups[find(k)] if i is not None), default=None) for k in range(len(ids))]


@pytest.mark.parametrize("pairwise", [0, 32])
def test_minhash_components_match_brute_force(spark, pairwise):
    texts = near_texts() + ["", None, " \t\n", "one two", "ONE two", "one  two", "a" * 30_000] + ["copy of a text that is there very often"] * 40
    ids = list(range(len(texts)))
    ids[3] = None
    random.Random(1).shuffle(ids)
    frame = docs(spark, [(i, t, "s", "en", 1) for i, t in zip(ids, texts)])
    how = minhash.Banding(pairwise_bucket=pairwise)
    got = minhash.near_duplicates(frame, how).collect()
    sets = word_sets(texts)
    want = least_reachable(ids, sets)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got) == \
        sorted((str(i), len(s), str(c), i == c) for i, s, c in zip(ids, sets, want))


def test_minhash_chain_in_a_crowded_bucket(spark):
    """x is like the centre's copy, but not like the centre: the link that only
    the rarest shingles find."""
    rng = random.Random(8)
    base = [f"b{k}" for k in range(300)]
    texts = []
    for k in range(60):  # a chain: each text replaces a few words of the one before
        texts.append(" ".join(base))
        for _ in range(4):
            base[rng.randrange(300)] = f"r{k}-{rng.random()}"
    frame = docs(spark, [(k, t, "s", "en", 1) for k, t in enumerate(texts)])
    for pairwise in (2, 64):
        got = minhash.near_duplicates(frame, minhash.Banding(pairwise_bucket=pairwise))
        assert [r["component_id"] for r in got.orderBy("doc_id").collect()] == least_reachable(list(range(60)), word_sets(texts))


def test_densified_bins_meet_as_often_as_sets_overlap():
    rng = np.random.default_rng(4)
    for size, part in ((12, 0.5), (200, 0.8), (2000, 0.85)):
        agree = []
        for _ in range(40):
            union = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            common = round(size * part)
            a, b = np.unique(union[:common]), np.unique(union)
            agree.append((minhash.one_permutation(a, 384) == minhash.one_permutation(b, 384)).mean())
        assert abs(np.mean(agree) - part) < 0.06


def test_minhash_of_an_empty_table(spark):
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


# ---- Merkle ----------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return levels


def brute_manifest(rows, changed):
    leaf = lambda r: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names]) if names else []
    out = []
    for at, g in enumerate(names):
        for index, r in enumerate(groups[g]):
            proof = []
            for levels, k in ((trees[g], index), (top, at)):
                for below in levels[:-1]:
                    run = k // 3 * 3
                    proof.append((k - run, below[run:k] + below[k + 1 : run + 3]))
                    k //= 3
            folded = merkle.fold(leaf(changed(r)), proof)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], sha("".join("".join(s) for _, s in proof)), folded, folded == top[-1][0]))
    return out


def manifest_rows(n, seed=5):
    rng = random.Random(seed)
    sources = [None, "", "hot", "hot", "hot", "b", "é"] + [f"s{k}" for k in range(9)]
    rows = [(rng.randrange(n), rng.choice(sources), rng.choice(["en", None]), rng.choice([3, None]), rng.choice(["a\nb", "", None, "é" * 5, "x" * 40_000]))
            for _ in range(n)]
    return rows + [rows[0]] * 7 + [(None, "hot", None, None, None)] * 3


@pytest.mark.parametrize("block_levels", [0, 1, 2, 6])
def test_manifest_matches_brute_force(spark, block_levels):
    rows = manifest_rows(150)
    frame = docs(spark, [(i, t, s, l, n) for i, s, l, n, t in rows]).repartition(5)
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = merkle.manifest(frame, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))},
                            block_levels=block_levels)

    def changed(r):
        if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            return (*r[:4], r[4].replace("\n", ""))
        return r

    got = [tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(brute_manifest(rows, changed), key=key)


def test_proofs_fold_to_the_root(spark):
    frame = docs(spark, [(i, t, s, l, n) for i, s, l, n, t in manifest_rows(60)])
    found = merkle.manifest(frame, ["doc_id", "text"], block_levels=1, with_proof=True).collect()
    assert len({r["root"] for r in found}) == 1 and all(r["verified"] for r in found)
    for r in found:
        assert merkle.fold(r["leaf"], [(s["place"], s["siblings"]) for s in r["proof"]]) == r["root"]
        assert hashlib.sha256("".join("".join(s["siblings"]) for s in r["proof"]).encode()).hexdigest() == r["proof_sha256"]


def test_manifest_of_one_row_and_of_none(spark):
    one = merkle.manifest(docs(spark, [(4, None, None, None, None)]), ["doc_id", "text"]).first()
    assert one["leaf"] == one["subroot"] == one["root"] == sha("1:4-") and one["proof_sha256"] == sha("") and one["verified"]
    assert merkle.manifest(docs(spark, []), ["doc_id", "text"]).count() == 0


# ---- spelling --------------------------------------------------------------

def is_one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def brute_variants(counts, ratio=10):
    near = {w: [o for o in counts if is_one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root))
    return sorted(out, key=str)


VOCABULARY = ["", "a", "aa", "ab", "aaa", "aab", "éa", "banana", "banna", "bananas", "banana\U0001F600", "bananà", "ananab", "b" * 300, "b" * 299, "b" * 298 + "a"]


@pytest.mark.parametrize("how", [spelling.Alphabet(), spelling.Alphabet(symbols=2, crowded=3), spelling.Alphabet(symbols=1, crowded=0)])
def test_variants_match_brute_force(spark, how):
    rng = random.Random(2)
    counts = {w: rng.choice([1, 2, 20, 300, 4000]) for w in VOCABULARY}
    for _ in range(300):
        counts["".join(rng.choice("abcàé") for _ in range(rng.randrange(3, 8)))] = rng.choice([1, 9, 10, 99, 100, 1000])
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.spelling_variants(words, how=how).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got), key=str) == brute_variants(counts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé\U00010000", max_size=8), min_size=2, max_size=12, unique=True), st.sampled_from([1, 2, 8, 64]))
def test_neighbourhoods_hold_every_pair_once(words, symbols):
    keys = spelling.reduced_keys(words, symbols).tolist()
    near = [[] for _ in words]
    for places, found in spelling.neighbour_keys(words, symbols):
        for place, key in zip(places.tolist(), found.tolist()):
            near[place].append(key)
    assert all(len(set(n)) == len(n) for n in near)
    for a, b in itertools.combinations(range(len(words)), 2):
        if is_one_edit(words[a], words[b]):
            assert keys[a] == keys[b] or (keys[a] in near[b]) + (keys[b] in near[a]) == 1


def test_runs_and_deletions(spark):
    text = "Straße-STRASSE naïveté a1bcdefghij élèvesÿ×÷ " + "z" * 20_000
    found = spelling.word_runs(docs(spark, [(1, text, "s", "en", 1), (2, None, None, None, None), (3, "", "", "", 0)]), 7)
    assert sorted(r["run"] for r in found.collect()) == sorted(["strasse", "naïveté", "bcdefghij", "élèvesÿ×÷", "z" * 20_000])
    cut = spark.range(1).select(*[spelling.without(F.lit("héllo"), F.lit(k)).alias(str(k)) for k in range(5)]).first()
    assert list(cut) == ["éllo", "hllo", "hélo", "hélo", "héll"]


def test_spelling_of_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0


# ---- SQL -------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_minhash", "op12_merkle_manifest", "op13_spelling_variants"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    cursor = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, cursor.fetchall()))
