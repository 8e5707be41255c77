"""Filter propagation over a declared relationship graph, and collated names."""

import random

import pytest
from pyspark.sql import functions as F

from strata.functions.text import IGNORE_CASE, group_by_name
from strata.operators import semantic as sem
from strata.operators.relations import Relationship, RelationshipGraph, model_graph
from strata.plans import reports
from tests.conftest import rows

LINKS = [("sales", "product", "products", "id", False), ("products", "kind", "kinds", "id", True), ("tags", "product", "products", "id", True),
         ("tags", "tag", "labels", "id", True), ("returns", "sale", "sales", "id", True)]


def _brute(data, filters, links, target):
    """Filters travel edge by edge until nothing changes, on lists of dicts."""
    def reduced(name, came):
        kept = [r for r in data[name] if name not in filters or filters[name](r)]
        hit = name in filters
        for link in links:
            many, mk, one, ok, both = link
            if link is came or name not in (many, one):
                continue
            far, mine, theirs = (one, mk, ok) if name == many else (many, ok, mk)
            if far == many and not both:
                continue
            other, touched = reduced(far, link)
            if touched:
                keys = {r[theirs] for r in other} - {None}
                kept, hit = [r for r in kept if r[mine] in keys], True
        return kept, hit

    return reduced(target, None)[0]


@pytest.mark.parametrize("seed", range(4))
def test_reduction_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    pick = lambda n: rng.choice([*range(n), None, 99])
    data = {
        "kinds": [{"id": k, "v": rng.randrange(3)} for k in range(4)],
        "products": [{"id": k, "kind": pick(4), "v": rng.randrange(3)} for k in range(12)],
        "labels": [{"id": k, "v": rng.randrange(3)} for k in range(5)],
        "tags": [{"product": 3 if k % 3 == 0 else pick(12), "tag": pick(5), "v": rng.randrange(3)} for k in range(60)],
        "sales": [{"id": k, "product": pick(12), "v": rng.randrange(3)} for k in range(40)],
        "returns": [{"sale": pick(40), "v": rng.randrange(3)} for k in range(15)],
    }
    frames = {n: spark.createDataFrame([tuple(r.values()) for r in rs], ", ".join(f"{c} long" for c in rs[0])) for n, rs in data.items()}
    graph = RelationshipGraph(frames, [Relationship(*link) for link in LINKS])
    for chosen in (["labels"], ["kinds", "returns"], ["sales"], ["tags", "products"], []):
        kept = graph.reduce({n: F.col("v") <= 1 for n in chosen})
        for name in data:
            want = _brute(data, {n: (lambda r: r["v"] <= 1) for n in chosen}, LINKS, name)
            assert rows(kept[name]) == sorted((tuple(r.values()) for r in want), key=lambda t: tuple((x is None, str(x)) for x in t)), (chosen, name)
    assert not graph.reaches("sales", "products") and graph.reaches("labels", "sales") and graph.reaches("products", "returns")


def test_graph_is_checked(spark):
    t = spark.range(1)
    with pytest.raises(ValueError, match="unknown table"):
        RelationshipGraph({"a": t}, [Relationship("a", "id", "b", "id")])
    with pytest.raises(ValueError, match="second path"):
        RelationshipGraph({"a": t, "b": t}, [Relationship("a", "id", "b", "id"), Relationship("b", "id", "a", "id")])
    with pytest.raises(ValueError, match="unknown table"):
        RelationshipGraph({"a": t}).reduce({"z": F.lit(True)})


def test_only_tables_on_a_filters_way_are_built_and_joined(spark):
    def never():
        raise AssertionError("built though no filter needs it")

    graph = RelationshipGraph({"fact": spark.range(9), "a": spark.range(3), "b": never},
                              [Relationship("fact", "id", "a", "id"), Relationship("fact", "id", "b", "id")])
    kept = graph.reduce({"a": F.col("id") > 1}, ["fact"])["fact"]
    assert rows(kept) == [(2,)]
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def _model(spark):
    games = spark.createDataFrame([(1, "Alpha", 10, 80.0), (2, "ALPHA", 20, 60.0), (3, "Éa", 5, 10.0), (4, "éA", 7, 20.0), (5, None, 1, 5.0), (6, "Ea", 9, 30.0)],
                                  "id long, name string, num_of_reviews long, weighted_rating double").withColumn("status", F.lit("x"))
    genre = spark.createDataFrame([(1, "rpg"), (2, "RPG"), (3, "Shooter")], "gid long, gname string")
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 3), (4, 9)], "fk_game long, fk_genre long")
    popularity = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 4.0), (77, 8.0)], "fk_game long, popularity_score double")
    dims = {"game_mode": sem.Dimension("game_mode", genre, "gid", "gname", bridge, "fk_game", "fk_genre")}
    return sem.SemanticModel(games, "id", dims, {"popularity": sem.RelatedFact(popularity, "fk_game")})


def test_names_that_differ_by_case_are_one(spark):
    m = _model(spark)
    assert rows(group_by_name(m.fact, "name", {"n": F.count("id")}, IGNORE_CASE)) == [("ALPHA", 2), ("Ea", 1), ("Éa", 2), (None, 1)]
    assert len(rows(group_by_name(m.fact, "name", {"n": F.count("id")}))) == 6
    # game 1 has both spellings of a label and counts once
    assert rows(sem.metric_by_label(m, "game_mode", {"reviews": F.sum("num_of_reviews")}, collation=IGNORE_CASE)) == [("RPG", 30), ("Shooter", 5), (None, 7)]
    top = reports.top_rated(m, None, None, n=2, collation=IGNORE_CASE)
    assert [tuple(r) for r in top.collect()] == [("ALPHA", 70.0, 30, "RPG"), ("Ea", 30.0, 9, None)] or \
        [tuple(r)[:3] for r in top.collect()] == [("ALPHA", 70.0, 30), ("Ea", 30.0, 9)]
    assert rows(reports.popularity_by_name(m, {}, IGNORE_CASE).selectExpr("name", "cast(popularity_score as int)")) == [("ALPHA", 3), ("Éa", 4), (None, 8)]
    labels = reports.top_labels(m, "game_mode", "reviews", 1, collation=IGNORE_CASE)
    assert rows(labels) == [("RPG", 30)]


def test_a_models_graph_reaches_its_related_fact(spark):
    graph = model_graph(_model(spark))
    kept = graph.reduce({"game_mode": F.lower("gname") == "rpg"})
    assert rows(kept["popularity"], "fk_game") == [(1,), (2,)] and rows(kept["fact"], "id") == [(1,), (2,)]
    assert rows(graph.reduce({"popularity": F.col("popularity_score") > 3}, ["game_mode"])["game_mode"], "gid") == [(3,)]
