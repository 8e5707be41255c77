from strata.operators.flatten import flatten_bridge
from tests.conftest import rows


def test_flatten_semantics(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None), (4, [None]), (5, [300]), (1, [1, 2])],
                               "id bigint, arr array<int>")
    out = flatten_bridge(df, "id", "arr", "key")
    assert out.schema["key"].dataType.simpleString() == "bigint"
    got = rows(out)
    # duplicates of owner rows are kept, NULL/empty arrays give nothing, NULL element -> NULL key
    assert got == sorted([(1, 1), (1, 2), (1, 1), (1, 2), (4, None), (5, 300)],
                         key=lambda t: tuple((x is None, str(x)) for x in t))


def test_flatten_plan_has_no_shuffle(spark):
    df = spark.createDataFrame([(1, [1, 2])], "id bigint, arr array<int>")
    plan = flatten_bridge(df, "id", "arr", "key")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" in plan
