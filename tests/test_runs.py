"""Run-level commits and loads of days whose files differ."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import catalog as C
from strata.sources import runs
from strata.sources import snapshot as snap
from tests.conftest import rows

CONTRACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType())])


def _land(spark, base, day, entities, n):
    for e in entities:
        snap.land_snapshot(spark.range(n).select("id", F.lit(e).alias("name"), F.lit(1.5).alias("score")), base, day, e)


def test_a_run_is_seen_whole_or_not_at_all(spark, tmp_path):
    base, entities = str(tmp_path), ["a", "b", "c"]
    contracts = {e: CONTRACT for e in entities}
    _land(spark, base, "20240101", entities, 1)
    roots = snap.load_all(spark, base, "20240101", contracts, base)
    _land(spark, base, "20240102", ["a", "b"], 2)  # c is missing
    with pytest.raises(Exception):
        snap.load_all(spark, base, "20240102", contracts, base, parallel=1)
    assert [snap.read_bronze(spark, roots[e]).count() for e in entities] == [1, 1, 1]
    reader = runs.current(spark, base)  # a reader that began before the next run
    _land(spark, base, "20240102", ["c"], 2)
    snap.load_all(spark, base, "20240102", contracts, base)
    assert [snap.loaded_rows(reader.read(spark, f"bronze/{e}")).count() for e in entities] == [1, 1, 1]
    now = runs.current(spark, base)
    assert now.tag == "20240102" and [snap.read_bronze(spark, roots[e]).count() for e in entities] == [2, 2, 2]
    with pytest.raises(FileNotFoundError):
        now.read(spark, "bronze/other")


def test_aborted_manifest_blocks_nothing(spark, tmp_path):
    base = str(tmp_path)
    _land(spark, base, "20240101", ["a"], 3)
    root = snap.load_entity(spark, base, "20240101", "a", CONTRACT, base)
    first = runs.current(spark, base)
    os.makedirs(f"{base}/_runs/{first.number + 1:010d}/_temporary/0")  # begun, never committed
    assert snap.read_bronze(spark, root).count() == 3
    _land(spark, base, "20240102", ["a"], 4)
    snap.load_entity(spark, base, "20240102", "a", CONTRACT, base)
    assert snap.read_bronze(spark, root).count() == 4 and runs.current(spark, base).number == first.number + 2
    os.makedirs(f"{root}/versions/20240103-dead")  # what a run that died had staged
    gone = runs.recover(spark, base)
    assert sorted(os.path.basename(g) for g in gone) == [f"{first.number + 1:010d}", "20240103-dead"]
    assert snap.read_bronze(spark, root).count() == 4 and runs.recover(spark, base) == []


def test_commits_carry_other_tables_and_prune(spark, tmp_path):
    base = str(tmp_path)
    for n in (1, 2, 3, 4):
        runs.commit(spark, base, f"t{n}", {"silver/x": runs.stage(spark.range(n), f"{base}/silver/x", f"t{n}")})
        if n == 1:
            runs.commit(spark, base, "y", {"silver/y": runs.stage(spark.range(9), f"{base}/silver/y", "y")})
    now = runs.current(spark, base)
    assert now.read(spark, "silver/x").count() == 4 and now.read(spark, "silver/y").count() == 9
    assert sorted(p.split("-")[0] for p in os.listdir(f"{base}/silver/x/versions")) == ["t3", "t4"]
    assert len(os.listdir(f"{base}/silver/y/versions")) == 1
    C.publish(spark.range(7), f"{base}/silver/y", "alone")  # a single table of a run: a commit of its own
    assert C.read_current(spark, f"{base}/silver/y").count() == 7 and C.read_current(spark, f"{base}/silver/x").count() == 4
    with pytest.raises(ValueError):
        runs.commit(spark, base, "none", {})


def test_a_commit_that_another_overtook_is_written_again(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    a, b = (runs.stage(spark.range(n), f"{base}/silver/{t}", t) for n, t in ((2, "a"), (3, "b")))
    add, raced = runs._add, []

    def slow(spark_, base_, number, tag, tables):
        if not raced:  # while this manifest is being written, another commit gets the next number through
            raced.append(1)
            os.makedirs(f"{base}/_runs/{number:010d}/_temporary")
            runs.commit(spark, base, "b", {"silver/b": b})
            shutil.rmtree(f"{base}/_runs/{number:010d}")
        return add(spark_, base_, number, tag, tables)

    monkeypatch.setattr(runs, "_add", slow)
    runs.commit(spark, base, "a", {"silver/a": a})
    assert set(runs.current(spark, base).tables) == {"silver/a", "silver/b"}


def test_failed_daily_run_moves_no_table(spark, monkeypatch):
    from strata.plans import daily
    from tests.test_daily import _land_all

    base = tempfile.mkdtemp(prefix="strata-failed-run-")
    _land_all(spark, base, "20240101")
    daily.run_daily(spark, base, "20240101", base, fail_on_test=False)
    before = runs.current(spark, base)
    assert len(before.tables) == 9 + 13
    _land_all(spark, base, "20240102", n_games=5)
    build = daily.SV.build_silver

    def broken(bronze):
        models = build(bronze)
        return models | {"clean_platform": models["clean_platform"].withColumn("name", F.raise_error(F.lit("broken")))}

    monkeypatch.setattr(daily.SV, "build_silver", broken)
    with pytest.raises(Exception, match="broken"):
        daily.run_daily(spark, base, "20240102", base, fail_on_test=False)
    assert runs.current(spark, base) == before
    assert snap.read_bronze(spark, f"{base}/bronze/raw_games").count() == 4  # the first day's, like every other table


def _mixed_day(spark, base, day="20240101"):
    path = snap.snapshot_path(base, day, "a")
    part = lambda values, schema: spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(path)
    part([(1, "one", 0.5), (2, "two", 1.5)], "id bigint, name string, score double")
    part([("3", "three", "2.5"), ("x", "four", "3.5")], "ID string, name string, score string")
    part([(5, 4.5)], "id int, Score float")
    part([(6, "six", 5.5, True)], "id bigint, name string, score double, extra boolean")
    return path


def test_mixed_type_day_loads(spark, tmp_path):
    base = str(tmp_path)
    path = _mixed_day(spark, base)
    with open(f"{path}/part-broken.parquet", "wb") as f:
        f.write(b"PAR1 this is no footer")
    open(f"{path}/part-empty.parquet", "wb").close()
    root = snap.load_entity(spark, base, "20240101", "a", CONTRACT, base)
    assert rows(snap.read_bronze(spark, root), "id", "name", "score") == [
        (1, "one", 0.5), (2, "two", 1.5), (3, "three", 2.5), (5, None, 4.5), (6, "six", 5.5)]
    bad = sorted((r["name"], r[snap.BAD_REASON].split(":")[0]) for r in snap.read_bronze(spark, root, quarantined=True).collect() if r["name"]) + sorted(
        r[snap.BAD_REASON].split(":")[0] for r in snap.read_bronze(spark, root, quarantined=True).collect() if not r["name"])
    assert bad == [("four", "id"), "unreadable file part-broken.parquet", "unreadable file part-empty.parquet"]


def test_uniform_day_is_one_scan_and_unreadable_days_fail(spark, tmp_path):
    base = str(tmp_path)
    _land(spark, base, "20240101", ["a"], 5)
    plan = snap.read_day(spark, snap.snapshot_path(base, "20240101", "a"), CONTRACT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    path = snap.snapshot_path(base, "20240102", "a")
    os.makedirs(path)
    with pytest.raises(FileNotFoundError):
        snap.load_entity(spark, base, "20240102", "a", CONTRACT, base)
    with open(f"{path}/x.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(FileNotFoundError):
        snap.load_entity(spark, base, "20240102", "a", CONTRACT, base)
