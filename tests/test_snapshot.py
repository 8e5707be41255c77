import os
import tempfile

import pytest
from pyspark.sql import types as T

from strata.sources import catalog as C
from strata.sources import snapshot as snap
from tests.conftest import rows

CONTRACT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("total_rating", T.DecimalType(5, 2)),
    T.StructField("missing", T.LongType()),
])


def test_union_pages(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3,)], "a int")
    c = spark.createDataFrame([("x",)], "c string")
    empty = spark.createDataFrame([], T.StructType([]))
    out = snap.union_pages([a, b, empty, c])
    assert out.columns == ["a", "b", "c"]
    assert rows(out) == [(1, 2, None), (3, None, None), (None, None, "x")]
    with pytest.raises(ValueError):
        snap.union_pages([empty])


def test_align_case_extra_missing(spark):
    df = spark.createDataFrame([(1, "A", "70.5", "junk")], "ID bigint, Name string, TOTAL_RATING string, extra string")
    out = snap.align_to_schema(df, CONTRACT)
    assert out.columns == ["id", "name", "total_rating", "missing"]
    r = out.first()
    assert (r.id, r.name, float(r.total_rating), r.missing) == (1, "A", 70.5, None)


def test_bad_rows_quarantined(spark):
    df = spark.createDataFrame([(1, "ok", "70"), (2, "x" * 300, "50"), (3, "fine", "not a number")],
                               "id bigint, name string, total_rating string")
    reasons = {r.id: r[snap.BAD_REASON] for r in snap.flag_bad_rows(df, CONTRACT).collect()}
    assert reasons[1] is None
    assert reasons[2] == "name: longer than 255"
    assert reasons[3].startswith("total_rating: not decimal")


def test_land_and_reload_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="strata-land-")
    df = spark.createDataFrame([(1, "A", "10.25"), (2, "B", "bad")], "id bigint, name string, total_rating string")
    path = snap.land_snapshot(df, base, "20240101", "raw_games")
    assert path.endswith("/raw/20240101/raw_games.parquet")
    files = os.listdir(path)
    assert any(f.endswith(".zstd.parquet") for f in files)
    for _ in range(2):
        out = snap.load_all(spark, base, "20240101", {"raw_games": CONTRACT}, base)
    table = snap.read_bronze(spark, out["raw_games"])
    assert table.columns == [f.name for f in CONTRACT.fields]
    assert rows(table, "id", "name") == [(1, "A")]
    assert rows(snap.read_bronze(spark, out["raw_games"], quarantined=True), "id") == [(2,)]
    again = snap.read_snapshot(spark, base, "20240101", "raw_games", CONTRACT)
    assert again.count() == 2


def test_catalog_helpers(spark, tmp_path):
    assert C.schema_name(" gold ", "silver") == "gold" and C.schema_name(None, "silver") == "silver"
    assert [r.top_n for r in C.top_n_choices(spark).collect()] == [1, 3, 5, 10, 25, 50, 100, 1000]
    assert [r.aspect for r in C.aspect_choices(spark).orderBy("sort_order").collect()][0] == "Platforms"
    assert C.selected_value(["x"]) == "x" and C.selected_value(["x", "y"], 10) == 10
    assert C.selected_value(None, 10) == 10
    df = spark.createDataFrame([(1,)], "a int")
    view = C.materialize(df, "gold", "t", kind="view")
    assert C.ref(spark, "gold", "t").count() == 1 and view.count() == 1
    tbl = C.materialize(df, "silver", "t", kind="table", base=str(tmp_path))
    assert tbl.count() == 1 and os.path.isdir(tmp_path / "silver" / "t" / "versions")
    assert C.read_current(spark, str(tmp_path / "silver" / "t")).count() == 1


def test_read_json_pages_merges_by_name(spark, tmp_path):
    import json

    pages = [[{"id": 1, "name": "A", "genres": [1, 2]}], [{"id": 2, "total_rating": 80.5}], []]
    paths = []
    for i, page in enumerate(pages):
        p = tmp_path / f"page{i}.json"
        p.write_text(json.dumps(page))
        paths.append(str(p))
    df = snap.read_pages(spark, paths)
    assert set(df.columns) == {"id", "name", "genres", "total_rating"}
    got = {r.id: (r.name, r.total_rating) for r in df.collect()}
    assert got == {1: ("A", None), 2: (None, 80.5)}


def test_failed_load_keeps_current_table(spark):
    base = tempfile.mkdtemp(prefix="strata-atomic-")
    good = spark.createDataFrame([(1, "A", "10.5")], "id bigint, name string, total_rating string")
    snap.land_snapshot(good, base, "20240101", "raw_games")
    root = snap.load_all(spark, base, "20240101", {"raw_games": CONTRACT}, base)["raw_games"]
    before = rows(snap.read_bronze(spark, root), "id", "name")
    with pytest.raises(Exception):
        snap.load_all(spark, base, "20240102", {"raw_games": CONTRACT}, base)  # snapshot missing
    assert rows(snap.read_bronze(spark, root), "id", "name") == before == [(1, "A")]


def test_lossy_and_nested_conversions_are_bad(spark):
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("tags", T.ArrayType(T.LongType()))])
    df = spark.createDataFrame([(1.0, ["1", "2"]), (1.7, ["3"]), (3.0, ["1", "x", "3"]), (4.0, None), (None, ["1", None])],
                               "id double, tags array<string>")
    got = [r[snap.BAD_REASON] for r in snap.flag_bad_rows(df, contract).collect()]
    assert got == [None, "id: not bigint", "tags: not array<bigint>", None, None]


def test_failed_publish_keeps_the_old_version(spark, tmp_path):
    from pyspark.sql import functions as F

    root = str(tmp_path / "t")
    C.publish(spark.range(3), root, "one")
    with pytest.raises(Exception):
        C.publish(spark.range(4).select(F.raise_error(F.lit("broken")).alias("id")), root, "two")
    assert C.read_current(spark, root).count() == 3
    # a pointer that was begun but never committed is not read either
    os.makedirs(f"{root}/_pointers/0000000001/_temporary/0")
    assert C.read_current(spark, root).count() == 3
    C.publish(spark.range(5), root, "three")  # it blocks no later version: the next free number is taken
    assert C.read_current(spark, root).count() == 5


def test_old_versions_are_pruned(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        C.publish(spark.range(n), root, f"v{n}")
    assert C.read_current(spark, root).count() == 4
    assert sorted(x.split("-")[0] for x in os.listdir(f"{root}/versions")) == ["v3", "v4"]
    assert C.version_tag(C.current_version(spark, root)) == "v4"


def test_published_views_are_seen_by_other_sessions(spark):
    C.materialize(spark.range(7).toDF("n"), "gold", "shared_view", kind="view")
    assert C.ref(spark.newSession(), "gold", "shared_view").count() == 7


def test_shared_folder_is_required_off_local_masters(spark, monkeypatch):
    from strata import session

    class Context:
        master, getCheckpointDir = "yarn", staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scratch_is_released(spark):
    from strata.session import materialize_shared, release_scratch

    df = materialize_shared(spark.range(5), "gone")
    folder = df.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(folder)
    release_scratch(spark)
    assert not os.path.isdir(folder)
