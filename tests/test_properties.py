"""Property tests: BI semantics on random small models against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.exact import avg_fixed
from strata.operators import semantic as sem
from strata.plans import reports

games_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 5),
                              st.one_of(st.none(), st.integers(0, 400).map(lambda c: c / 4))),
                    min_size=1, max_size=12)
bridge_st = st.lists(st.tuples(st.integers(0, 11), st.integers(0, 6)), max_size=30)
dim_names = ["x", "y", "x", "z", "w"]  # keys 0..4; 5 and 6 have no member


def _model(spark, games, bridge):
    g = spark.createDataFrame([(i, n, r, w) for i, (n, r, w) in enumerate(games)],
                              "id bigint, name string, num_of_reviews bigint, weighted_rating double")
    dim = spark.createDataFrame(list(enumerate(dim_names)), "k bigint, label string")
    b = spark.createDataFrame(bridge or [(0, 0)], "g bigint, k bigint")
    if not bridge:
        b = b.limit(0)
    return sem.SemanticModel(g, "id", {"d": sem.Dimension("d", dim, "k", "label", b, "g", "k")})


def _brute_labels(games, bridge):
    pairs = {(dim_names[k] if k < len(dim_names) else None, gid) for gid, k in bridge if gid < len(games)}
    out = {}
    for label, gid in pairs:
        out.setdefault(label, []).append(games[gid])
    return out


def _top5(values):
    vals = [v for v in values.values() if v is not None]
    kept = {k for k, v in values.items() if v is not None and sum(1 for x in vals if x > v) < 5}
    return kept


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(games=games_st, bridge=bridge_st)
def test_top_labels_match_brute_force(spark, games, bridge):
    model = _model(spark, games, bridge)
    groups = _brute_labels(games, bridge)
    reviews = {k: sum(r for _, r, _ in v) for k, v in groups.items()}
    got = {r.label: r.sum_reviews for r in reports.top_labels(model, "d", "reviews").collect()}
    assert set(got) == _top5(reviews) and all(got[k] == reviews[k] for k in got)
    ratings = {}
    for k, v in groups.items():
        cents = [round(w * 100) for _, _, w in v if w is not None]
        ratings[k] = (sum(cents) / (len(cents) * 100)) if cents else None
    got = {r.label: r.avg_weighted_rating for r in reports.top_labels(model, "d", "rating").collect()}
    assert set(got) == _top5(ratings) and all(got[k] == ratings[k] for k in got)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(games=games_st, bridge=bridge_st, pick=st.sampled_from(["x", "y", "z", "w"]))
def test_propagation_matches_brute_force(spark, games, bridge, pick):
    model = _model(spark, games, bridge)
    keys = {k for k, n in enumerate(dim_names) if n == pick}
    want = sorted({gid for gid, k in bridge if k in keys and gid < len(games)})
    got = sorted(r.id for r in sem.propagate(model, {"d": [pick]}).collect())
    assert got == want
    assert reports.game_count(sem.propagate(model, {"d": [pick]})).first().n_items == len(want)


def test_avg_fixed_is_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "x double").repartition(3)
    assert df.agg(avg_fixed(F.col("x")).alias("a")).first().a == 0.2


vals_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 6)), st.one_of(st.none(), st.sampled_from("abc"))),
                   min_size=0, max_size=25)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=vals_st)
def test_column_tests_match_brute_force(spark, data):
    from strata.operators import quality as Q

    df = spark.createDataFrame(data, "k int, s string")
    counts = {}
    for k, _ in data:
        if k is not None:
            counts[k] = counts.get(k, 0) + 1
    assert sorted(tuple(r) for r in Q.unique(df, "k").collect()) == sorted((k, n) for k, n in counts.items() if n > 1)
    assert Q.not_null(df, "s").count() == sum(1 for _, s in data if s is None)
    assert Q.accepted_range(df, "k", 0, 4).count() == sum(1 for k, _ in data if k is not None and not 0 <= k <= 4)
    assert Q.accepted_values(df, "s", ["a", "b"]).count() == sum(1 for _, s in data if s is not None and s not in "ab")
    res = {r.check: r.failures for r in Q.run_checks(df, [Q.Check("unique", "k"), Q.Check("not_null", "s")]).collect()}
    assert res == {"unique:k": sum(1 for n in counts.values() if n > 1),
                   "not_null:s": sum(1 for _, s in data if s is None)}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(secs=st.lists(st.integers(-4_000_000_000, 4_000_000_000), min_size=1, max_size=50))
def test_epoch_to_date_matches_python(spark, secs):
    import datetime as dt

    from strata.functions.scalars import epoch_to_date

    df = spark.createDataFrame([(s,) for s in secs], "s bigint")
    got = {r.s: r.d for r in df.select("s", epoch_to_date("s").alias("d")).collect()}
    epoch = dt.date(1970, 1, 1)
    assert all(got[s] == epoch + dt.timedelta(days=s // 86400) for s in secs)
