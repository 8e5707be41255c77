from strata.operators import quality as Q
from tests.conftest import rows


def _df(spark):
    return spark.createDataFrame(
        [(1, "a", 50.0, "Alpha"), (1, "b", 101.0, "Beta"), (2, None, None, "Rumored"), (None, "d", -1.0, "Nope"),
         (None, "e", 3.0, None)],
        "id bigint, name string, rating double, status string")


def test_unique_ignores_nulls(spark):
    assert rows(Q.unique(_df(spark), "id")) == [(1, 2)]
    assert Q.unique(_df(spark), ["id", "name"]).count() == 0


def test_row_checks(spark):
    df = _df(spark)
    assert rows(Q.not_null(df, "name"), "id") == [(2,)]
    assert rows(Q.accepted_range(df, "rating", 0, 100), "rating") == [(-1.0,), (101.0,)]
    assert rows(Q.accepted_range(df, "rating", 0, 100, inclusive=False), "rating") == [(-1.0,), (101.0,)]
    assert rows(Q.accepted_range(df, "rating", 3, None, inclusive=False), "rating") == [(-1.0,), (3.0,)]
    assert rows(Q.accepted_values(df, "status", ["Alpha", "Beta", "Rumored"]), "status") == [("Nope",)]


def test_suite_one_pass_and_assert(spark):
    df = _df(spark)
    checks = [Q.Check("unique", "id"), Q.Check("not_null", "id"),
              Q.Check("accepted_range", "rating", {"min_value": 0, "max_value": 100}),
              Q.Check("accepted_values", "status", {"values": ["Alpha", "Beta", "Rumored"]})]
    res = Q.run_checks(df, checks, "t")
    got = {r.check: r.failures for r in res.collect()}
    assert got == {"unique:id": 1, "not_null:id": 2, "accepted_range:rating": 2, "accepted_values:status": 1}
    try:
        Q.assert_checks(res)
        raise RuntimeError("expected failure")
    except AssertionError as e:
        assert "not_null:id=2" in str(e)
    ok = Q.run_checks(df.filter("id = 2"), checks, "t")
    Q.assert_checks(ok)


def test_uniqueness_checks_share_one_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "a", None), (None, "b", 2.0), (None, None, -0.5)] * 2 + [(3, "c", 7.0)],
                               "id bigint, name string, x double")
    checks = [Q.Check("unique", "id"), Q.Check("not_null", "x"), Q.Check("unique", ("id", "name")), Q.Check("unique", "x")]
    out = Q.run_checks(df, checks, "t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = {r.pos: (r.check, r.failures) for r in out.collect()}
    assert got == {i: (c.name, Q.unique(df, c.column).count() if c.kind == "unique" else df.filter("x is null").count()) for i, c in enumerate(checks)}
    assert plan.count("Exchange hashpartitioning") == 1
    none = Q.run_checks(df.filter("id = 9"), checks, "t")
    assert [r.failures for r in none.collect()] == [0, 0, 0, 0]
