"""File sizes of sized writes, and day folders that a calendar filter prunes."""

import os

from pyspark.sql import functions as F

from strata.plans import gold
from strata.sources import catalog as C
from strata.sources import runs
from strata.sources import snapshot as snap
from strata.sources.calendar import calendar
from tests.conftest import rows


def _sizes(folder):
    return [os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet")]


def _skewed(spark, n=60_000):
    """Random text: one task holds nearly all rows, thirty hold a few."""
    text = F.concat_ws("", *[F.sha2(F.concat_ws("-", "id", F.lit(k)), 256) for k in range(4)])
    large = spark.range(n, numPartitions=1).select("id", text.alias("text"))
    return large.union(spark.range(n, n + 30, numPartitions=30).select("id", text.alias("text")))


def test_skewed_input_gives_even_files(spark, tmp_path):
    df, target = _skewed(spark), 2 << 20
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    plain = snap.land_snapshot(df, str(tmp_path / "plain"), "20240101", "a")
    sized = snap.land_snapshot(df, str(tmp_path / "sized"), "20240101", "a", target_file_bytes=target)
    assert max(_sizes(plain)) > 3 * target and len(_sizes(plain)) > 30
    found = _sizes(sized)
    assert max(found) < 1.6 * target and len(found) <= sum(found) // target * 3 + 2
    assert spark.read.parquet(sized).count() == df.count()
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_skewed_folders_give_few_files_each(spark, tmp_path):
    df = _skewed(spark).repartition(16).withColumn("day", F.when(F.col("id") % 100 == 0, F.col("id") % 7).otherwise(99))
    version = runs.stage(df, str(tmp_path / "silver" / "t"), "x", ["day"], 2 << 20)
    files = {d: len(_sizes(os.path.join(version, d))) for d in os.listdir(version) if d.startswith("day=")}
    assert files.pop("day=99") >= 3 and set(files.values()) == {1}
    assert max(_sizes(version)) < 1.6 * (2 << 20)


def test_calendar_filter_prunes_day_folders(spark, tmp_path):
    fact = spark.range(3000).select("id", F.col("id").alias("fk_game"), F.lit(1).alias("fk_popularity_type"), F.lit(0.5).alias("popularity_score"),
                                    F.when(F.col("id") % 50 > 0, F.expr("date_add(date'2024-01-01', cast(id % 60 as int))")).alias("date_measured_at"))
    base = str(tmp_path)
    runs.commit(spark, base, "x", {"gold/fct": gold.stage_popularity(fact, f"{base}/gold/fct", "x")})
    stored = C.read_current(spark, f"{base}/gold/fct")
    wanted = gold.measured_on(stored, calendar(spark, as_of="2024-01-15"), F.col("IsWeekend"))
    assert "dynamicpruning" in wanted._jdf.queryExecution().executedPlan().toString()
    days = spark.range(60).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d")).filter("weekday(d) >= 5")
    assert rows(wanted, "id") == rows(fact.join(days, F.col("date_measured_at") == F.col("d"), "left_semi"), "id")
    scan = _scan_metrics(wanted)
    assert scan["numFiles"] == days.count() < len(_sizes(f"{base}/gold/fct"))


def _scan_metrics(df):
    """Metrics of the one file scan of an executed frame."""
    run = df._jdf.queryExecution()
    run.toRdd().count()
    todo, out = [run.executedPlan()], {}
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            for name in ("numFiles", "numPartitions"):
                out[name] = node.metrics().apply(name).value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return out
