from pyspark.sql import functions as F

from strata.operators import semantic as sem
from tests.conftest import rows


def _model(spark):
    games = spark.createDataFrame(
        [(1, "Alpha", 10, 2), (2, "Beta", 20, 2), (3, "Alpha", 5, 99), (4, "Gamma", 7, 1)],
        "id bigint, name string, reviews bigint, fk_type bigint")
    genre = spark.createDataFrame([(1, "RPG"), (2, "Shooter"), (3, "RPG")], "gid bigint, gname string")
    # duplicated bridge rows, two genre ids with the same name, and a key (9) with no genre
    bridge = spark.createDataFrame([(1, 1), (1, 1), (1, 3), (2, 2), (3, 9)], "fk_game bigint, fk_genre bigint")
    gtype = spark.createDataFrame([(1, "Main"), (2, "DLC")], "fk_type bigint, tname string")
    dims = {
        "genre": sem.Dimension("genre", genre, "gid", "gname", bridge, "fk_game", "fk_genre"),
        "type": sem.Dimension("type", gtype, "fk_type", "tname"),
    }
    return sem.SemanticModel(games, "id", dims)


def test_game_counts_once_per_label(spark):
    m = _model(spark)
    out = sem.metric_by_label(m, "genre", {"reviews": F.sum("reviews")})
    # game 1 has three bridge rows to two RPG ids -> counted once; key 9 -> blank group
    assert rows(out) == [("RPG", 10), ("Shooter", 20), (None, 5)]


def test_blank_group_optional(spark):
    m = _model(spark)
    m.dims["genre"].include_blank = False
    assert rows(sem.metric_by_label(m, "genre", {"n": F.count("id")})) == [("RPG", 1), ("Shooter", 1)]


def test_many_to_one_dimension(spark):
    m = _model(spark)
    out = sem.metric_by_label(m, "type", {"n": F.count("id")})
    assert rows(out) == [("DLC", 2), ("Main", 1), (None, 1)]


def test_propagate_semi_joins_do_not_duplicate(spark):
    m = _model(spark)
    facts = sem.propagate(m, {"genre": ["RPG"], "type": ["DLC"]})
    assert rows(facts, "id") == [(1,)]
    facts = sem.propagate(m, {"genre": None}, F.col("reviews") > 6)
    assert rows(facts, "id") == [(1,), (2,), (4,)]


def test_label_values_under_filter(spark):
    m = _model(spark)
    facts = sem.propagate(m, {"type": ["DLC"]})
    assert rows(sem.label_values(m, "genre", facts)) == [("RPG",), ("Shooter",)]


def test_lookup_keeps_unmatched(spark):
    facts = spark.createDataFrame([(1, 1), (2, 7)], "id bigint, fk bigint")
    dim = spark.createDataFrame([(1, "Released")], "sid bigint, status string")
    out = sem.lookup(facts, dim, "fk", "sid", ["status"])
    assert rows(out, "id", "status") == [(1, "Released"), (2, None)]
    # an estimated size within the bound is broadcast; an unknown one is left to the planner
    small = spark.range(1, 2).selectExpr("id AS sid", "'Released' AS status")
    plan = sem.lookup(facts, small, "fk", "sid", ["status"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_hot_game_in_bridge_is_reduced_before_shuffle(spark):
    games = spark.createDataFrame([(i, f"g{i % 7}", i) for i in range(60)], "id bigint, name string, reviews bigint")
    genre = spark.createDataFrame([(k, f"genre{k % 4}") for k in range(12)], "gid bigint, gname string")
    # game 0 holds a third of all bridge rows
    hot = [(0, k % 12) for k in range(300)]
    rest = [(i, (i * 7 + j) % 12) for i in range(1, 60) for j in range(10)]
    bridge = spark.createDataFrame(hot + rest, "fk_game bigint, fk_genre bigint").repartition(8)
    m = sem.SemanticModel(games, "id", {"genre": sem.Dimension("genre", genre, "gid", "gname", bridge,
                                                               "fk_game", "fk_genre")})
    out = {r.label: r.n for r in sem.metric_by_label(m, "genre", {"n": F.count("id")}).collect()}
    # brute force: distinct (label, game) pairs
    pairs = {(f"genre{k % 4}", g) for g, k in hot + rest}
    want = {}
    for label, _ in pairs:
        want[label] = want.get(label, 0) + 1
    assert out == want
    plan = sem.label_pairs(m, "genre")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    spread = [k for k, line in enumerate(lines) if "Exchange hashpartitioning(" in line and "id#" in line and "_dk#" in line]
    assert spread and all("HashAggregate" in lines[k + 1] for k in spread), "no partial aggregate below the first shuffle"


def test_one_way_dimension_lists_all_labels(spark):
    m = _model(spark)
    m.dims["type"].both_directions = False
    facts = sem.propagate(m, {"genre": ["Shooter"]})
    assert rows(sem.label_values(m, "type", facts)) == [("DLC",), ("Main",)]
    m.dims["type"].both_directions = True
    assert rows(sem.label_values(m, "type", facts)) == [("DLC",)]


def test_filter_matrix_context():
    from strata.plans.reports import context_for

    sel = {"game_mode": ["Battle Royale"], "status": ["Released"], "popularity_type": ["Peak"], "top_n": [25]}
    assert context_for("top3_rated", sel) == {"game_mode": ["Battle Royale"], "status": ["Released"]}
    assert context_for("most_wishlisted", sel) == {}
    assert set(context_for("popularity_rank", sel)) == {"status", "popularity_type", "top_n"}
