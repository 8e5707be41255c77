import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import topn
from strata.operators.rating import bayesian_prior, exact_median, with_weighted_rating


def test_weighted_rating_formula(spark):
    data = [(1, 80.0, 10), (2, 60.0, 2), (3, None, 5), (4, 90.0, 0), (5, 70.0, 4)]
    df = spark.createDataFrame(data, "id bigint, rating double, reviews bigint")
    mean, median = bayesian_prior(df, "rating", "reviews")
    # prior over rated rows with reviews > 0: ratings 80, 60, 70; counts 10, 2, 4
    assert mean.first()[0] == 70.0
    assert median.first()[0] == 4.0
    out = {r.id: r.weighted_rating for r in with_weighted_rating(df).collect()}
    m, c = 70.0, 4.0
    assert out[1] == round((c * m + 80 * 10) / (c + 10), 2)
    assert out[2] == round((c * m + 60 * 2) / (c + 2), 2)
    assert out[3] is None  # NULL rating stays NULL
    assert out[4] == 70.0  # no reviews: the prior mean


def test_weighted_rating_runs_prior_once(spark):
    df = spark.createDataFrame([(1, 80.0, 10)], "id bigint, rating double, reviews bigint")
    plan = with_weighted_rating(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert plan.count("functions=[sum(cast(rating") == 1


def test_exact_median_matches_statistics(spark):
    import statistics

    rnd = random.Random(3)
    for n in (1, 2, 7, 200):
        vals = [float(rnd.randint(0, 40)) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double").repartition(4)
        assert exact_median(df, "v").first().median == statistics.median(vals)
    assert exact_median(spark.createDataFrame([], "v double"), "v").first().median is None


def _brute_rank(values, n, dense):
    out = []
    for v in values:
        if v is None:
            continue
        better = {x for x in values if x is not None and x > v} if dense else \
            [x for x in values if x is not None and x > v]
        r = len(better) + 1
        if r <= n:
            out.append((v, r))
    return sorted(out)


def test_top_n_with_ties_matches_rank(spark):
    rnd = random.Random(7)
    for trial in range(6):
        vals = [rnd.choice([None, 1, 2, 3, 5, 5, 8, 8, 8, 13]) for _ in range(rnd.randint(1, 40))]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v int").repartition(3)
        for n in (1, 3, 5, 25):
            got = sorted((r.v, r.rk) for r in topn.top_n_with_ties(df, "v", n, rank_col="rk").collect())
            assert got == _brute_rank(vals, n, dense=False), (vals, n)


def test_dense_top_n_matches_dense_rank(spark):
    df = spark.createDataFrame([(1, 9.0), (2, 9.0), (3, 7.0), (4, 5.0), (5, None)], "id int, s double")
    got = sorted((r.id, r.rk) for r in topn.dense_top_n(df, "s", 2, rank_col="rk").collect())
    assert got == [(1, 1), (2, 1), (3, 2)]


def test_tie_at_boundary_returns_more_rows(spark):
    df = spark.createDataFrame([("a", 10), ("b", 9), ("c", 8), ("d", 7), ("e", 6), ("f", 6)], "k string, v int")
    assert sorted(r.k for r in topn.top_n_with_ties(df, "v", 5).collect()) == list("abcdef")


def test_topn_plan_avoids_global_window_over_input(spark):
    df = spark.range(0, 1000).select((F.col("id") % 97).alias("v"))
    plan = topn.top_n_with_ties(df, "v", 5, rank_col="rk")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    # the only window runs over the <= n distinct threshold values, after an aggregate
    w = Window.orderBy(F.col("v").desc())
    naive = df.withColumn("r", F.rank().over(w))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in naive


def test_dense_rank_all_matches_window(spark):
    rnd = random.Random(11)
    vals = [rnd.choice([None] + list(range(60))) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v int").repartition(5)
    got = {r.id: r.rk for r in topn.dense_rank_all(df, "v", rank_col="rk").collect()}
    distinct = sorted({v for v in vals if v is not None}, reverse=True)
    want = {i: (None if v is None else distinct.index(v) + 1) for i, v in enumerate(vals)}
    assert got == want
    asc = {r.id: r.rk for r in topn.dense_rank_all(df, "v", ascending=True, rank_col="rk").collect()}
    assert all(asc[i] == (None if v is None else sorted(distinct).index(v) + 1) for i, v in enumerate(vals))
    plan = topn.dense_rank_all(df, "v")._jdf.queryExecution().executedPlan().toString()
    # local ranks are read from one materialization, never recomputed
    assert "_local" in plan and "FileScan parquet" in plan and "row_number" not in plan


def test_materialized_float_metrics(spark):
    df = spark.createDataFrame([(i % 13, 0.1 * (i % 7)) for i in range(400)], "g int, x double").repartition(6)
    per = df.groupBy("g").agg(F.sum("x").alias("s"))
    got = topn.top_n_with_ties(per, "s", 3, rank_col="rk", materialize=True)
    want = per.withColumn("rk", F.rank().over(Window.orderBy(F.col("s").desc()))).filter("rk <= 3")
    assert sorted((r.g, r.rk) for r in got.collect()) == sorted((r.g, r.rk) for r in want.collect())


def test_hot_values_rank_alike_over_partitions(spark):
    """One value on most rows, spread over several sorted partitions."""
    from pyspark.sql import Window

    df = spark.range(4000).select("id", F.when(F.col("id") % 4 > 0, 5).when(F.col("id") % 40 == 0, None).otherwise(F.col("id") % 13).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = topn.dense_rank_all(df, "v")
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, ranked.collect())) == sorted(map(str, df.withColumn(
            "rank", F.when(F.col("v").isNotNull(), F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("bigint"))).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert "SortMergeJoin" not in plan and plan.count("Join") == 1  # the one with a row per partition
