import tempfile

from strata import schemas as SC
from strata.plans.daily import run_daily
from strata.sources import snapshot as snap
from strata.streaming.snapshots import load_new_snapshots
from tests.conftest import rows


def _land_all(spark, base, run_date, n_games=3):
    games = spark.createDataFrame(
        [(i, f"Game {i}", 1700006400 if i != 2 else None, [1], 1, [1, 2], [1], 80.0 + i, 10 * i, [1], i, 1)
         for i in range(1, n_games + 1)] + [(1, "Game 1", 1700006400, [1], 1, [1, 2], [1], 85.0, 10, [1], 1, 1)],
        "ID bigint, NAME string, first_release_date bigint, game_modes array<bigint>, game_type bigint, "
        "genres array<bigint>, platforms array<bigint>, total_rating double, total_rating_count bigint, "
        "franchises array<bigint>, hypes bigint, game_status bigint")
    lookup = spark.createDataFrame([(1, "One", 0), (2, "Two", 86400)], "id bigint, name string, created_at bigint")
    gtype = spark.createDataFrame([(1, "Main", 0)], "id bigint, type string, created_at bigint")
    status = spark.createDataFrame([(1, "Released"), (2, "Alpha")], "id bigint, status string")
    poptype = spark.createDataFrame([(1, "Hours watched")], "id bigint, name string")
    pop = spark.createDataFrame([(1, 1, 1, 5.5, 1700006400), (2, 1, 2, 1.0, 1700006400), (3, 2, 1, 2.0, 0)],
                                "id bigint, game_id bigint, popularity_type bigint, value double, calculated_at bigint")
    frames = {"raw_games": games, "raw_gamemode": lookup, "raw_genre": lookup, "raw_platform": lookup,
              "raw_franchise": lookup, "raw_gametype": gtype, "raw_gamestatus": status, "raw_poptype": poptype,
              "raw_popprimitive": pop}
    for e, df in frames.items():
        snap.land_snapshot(df, base, run_date, e)


def test_daily_run_twice_is_stable(spark):
    base = tempfile.mkdtemp(prefix="strata-run-")
    _land_all(spark, base, "20240101")
    first = run_daily(spark, base, "20240101", base, fail_on_test=False)
    fact1 = rows(first.gold["fct_games"])
    second = run_daily(spark, base, "20240101", base, fail_on_test=False)
    assert rows(second.gold["fct_games"]) == fact1
    assert "Weighted rating" in second.gold["fct_games"].columns
    tests = {(r.table, r.check): r.failures for r in second.tests.collect()}
    assert len(tests) == 66
    # game 1 appears with two different ratings -> unique id fails; game 1 has two popularity rows
    assert tests[("clean_games", "unique:id")] == 1
    assert tests[("clean_popprimitive", "unique:fk_game")] == 1
    assert tests[("clean_gamestatus", "accepted_values:status")] == 0
    assert sum(tests.values()) == 2
    genre_bridge = second.silver["clean_bridge_genre"]
    assert genre_bridge.count() == 2 * 4  # 4 raw game rows x 2 genres, duplicates kept


def test_stream_loads_latest_snapshot(spark):
    base = tempfile.mkdtemp(prefix="strata-stream-")
    ckpt = tempfile.mkdtemp(prefix="strata-stream-ckpt-")
    contract = SC.RAW_GAMESTATUS
    schema = "id bigint, status string"
    for day, labels in (("20240101", ["Alpha"]), ("20240102", ["Alpha", "Beta"])):
        snap.land_snapshot(spark.createDataFrame(list(enumerate(labels)), schema), base, day, "raw_gamestatus")
    file_schema = spark.read.parquet(snap.snapshot_path(base, "20240101", "raw_gamestatus")).schema
    load_new_snapshots(spark, base, "raw_gamestatus", file_schema, contract, base, ckpt)
    bronze = snap.read_bronze(spark, f"{base}/bronze/raw_gamestatus")
    assert rows(bronze, "id", "status") == [(0, "Alpha"), (1, "Beta")]
    snap.land_snapshot(spark.createDataFrame([(7, "Offline")], schema), base, "20240103", "raw_gamestatus")
    load_new_snapshots(spark, base, "raw_gamestatus", file_schema, contract, base, ckpt)
    assert rows(snap.read_bronze(spark, f"{base}/bronze/raw_gamestatus"), "id", "status") == [(7, "Offline")]


def test_day_with_two_files_ends_complete(spark):
    base, ckpt = tempfile.mkdtemp(prefix="strata-parts-"), tempfile.mkdtemp(prefix="strata-parts-ckpt-")
    day = snap.snapshot_path(base, "20240102", "raw_gamestatus")
    status = lambda ids: spark.createDataFrame([(i, f"s{i}") for i in ids], "id bigint, status string").coalesce(1)
    load = lambda: load_new_snapshots(spark, base, "raw_gamestatus", status([1]).schema, SC.RAW_GAMESTATUS, base, ckpt)
    status([1, 2]).write.parquet(day)
    load()
    status([3]).write.mode("append").parquet(day)  # the rest of the day's files
    load()
    assert rows(snap.read_bronze(spark, f"{base}/bronze/raw_gamestatus"), "id") == [(1,), (2,), (3,)]
    status([9]).write.parquet(snap.snapshot_path(base, "20240101", "raw_gamestatus"))  # a late older day
    load()
    assert rows(snap.read_bronze(spark, f"{base}/bronze/raw_gamestatus"), "id") == [(1,), (2,), (3,)]


def test_gold_views_persist_in_the_catalog(spark):
    base = tempfile.mkdtemp(prefix="strata-views-")
    _land_all(spark, base, "20240401")
    run = run_daily(spark, base, "20240401", base, fail_on_test=False, catalog=True)
    other = spark.newSession()
    for name, frame in run.gold.items():
        assert rows(other.table(f"gold.{name}")) == rows(frame), name
        assert other.table(f"gold.{name}").columns == frame.columns


def test_command_line_run(spark):
    from strata.plans.daily import main

    base = tempfile.mkdtemp(prefix="strata-cli-")
    _land_all(spark, base, "20240105")
    # the fixture has two failing checks (duplicate game id, two popularity rows for one game)
    assert main(["--landing", base, "--run-date", "20240105", "--warehouse", base]) == 1
    assert main(["--landing", base, "--run-date", "20240105", "--warehouse", base, "--no-fail-on-test"]) == 0


def test_run_on_arrival(spark):
    from strata.sources import catalog as C
    from strata.streaming.snapshots import run_on_arrival

    base = tempfile.mkdtemp(prefix="strata-arrival-")
    ckpt = tempfile.mkdtemp(prefix="strata-arrival-ckpt-")
    _land_all(spark, base, "20240201", n_games=2)
    run_on_arrival(spark, base, base, ckpt)
    assert C.read_current(spark, f"{base}/silver/clean_games").count() == 3  # 2 games + 1 conflicting row
    _land_all(spark, base, "20240202", n_games=4)
    run_on_arrival(spark, base, base, ckpt)
    assert C.read_current(spark, f"{base}/silver/clean_games").count() == 5


def test_bucketed_silver_joins_without_shuffle(spark):
    base = tempfile.mkdtemp(prefix="strata-bucket-")
    _land_all(spark, base, "20240301")
    run = run_daily(spark, base, "20240301", base, fail_on_test=False, catalog=True, game_buckets=4)
    games, bridge = run.silver["clean_games"], run.silver["clean_bridge_genre"]
    joined = bridge.join(games, bridge.fk_game == games.id)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 12  # game 1 has two silver rows (conflicting ratings)
