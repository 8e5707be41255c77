import datetime as dt

from pyspark.sql import functions as F

from strata.plans import gold, reports, silver
from tests.conftest import rows

RAW = ("id bigint, name string, game_type bigint, game_status bigint, total_rating double, "
       "total_rating_count bigint, hypes bigint, first_release_date bigint, franchises array<bigint>, "
       "genres array<bigint>, platforms array<bigint>, game_modes array<bigint>")


def _raw(spark):
    data = [
        (1, "Alpha", 0, 1, 70.0, 0, None, 1700006400, [1, 2], [1], [1], [1]),
        (1, "Alpha", 0, 1, 70.0, 0, None, 1700006400, [1, 2], [1], [1], [1]),  # exact duplicate
        (2, "Beta", 0, 2, 95.0, 0, 5, None, [], None, [1], [1]),
        (3, "Gamma", 1, 99, 0.0, 9, 5, None, None, [None], [2], [2]),
        (4, "Delta", 1, 1, None, None, 3, -1, [300], [2], [2], [1]),
    ]
    return spark.createDataFrame(data, RAW)


def test_clean_games_rules(spark):
    clean = silver.clean_games(_raw(spark))
    got = {r.id: r for r in clean.collect()}
    assert len(got) == 4 and clean.count() == 4  # duplicates collapsed
    assert got[1].num_of_reviews == 1 and got[1].wishlist_count == 0
    assert got[2].num_of_reviews == 0  # rating at 95: no repair
    assert got[3].num_of_reviews == 0  # reviews but rating 0
    assert got[4].num_of_reviews == 0 and got[4].average_rating is None
    assert got[1].date_first_release == dt.date(2023, 11, 15)
    assert got[4].date_first_release == dt.date(1969, 12, 31)


def test_bridges_keep_duplicates(spark):
    s = silver.build_silver({"raw_games": _raw(spark)})
    fr = rows(s["clean_bridge_franchise"])
    assert fr == [(1, 1), (1, 1), (1, 2), (1, 2), (4, 300)]
    assert rows(s["clean_bridge_genre"]) == [(1, 1), (1, 1), (3, None), (4, 2)]


def test_fact_and_reports(spark):
    status = spark.createDataFrame([(1, "Released"), (2, "Alpha")], "id bigint, status string")
    fact = gold.fct_games(silver.clean_games(_raw(spark)), status)
    got = {r.id: r for r in fact.collect()}
    assert got[3].status is None  # unknown status id
    assert got[4].weighted_rating is None
    # prior: rated rows with reviews > 0 -> only id 1 (rating 70, 1 review)
    assert got[1].weighted_rating == 70.0 and got[2].weighted_rating == round((70 + 0) / 1, 2)
    pub = gold.build_gold({"clean_games": silver.clean_games(_raw(spark)), "clean_gamestatus": status},
                          display=True)
    assert "Weighted rating" in pub["fct_games"].columns


def test_most_wishlisted_tie_takes_first_name(spark):
    fact = spark.createDataFrame(
        [(1, "B", 10, None), (2, "A", 10, None), (3, "C", 50, dt.date(2020, 1, 1)), (4, "D", 3, None)],
        "id bigint, name string, wishlist_count bigint, date_first_release date")
    assert rows(reports.most_wishlisted(fact)) == [("A", 10)]
    top = reports.wishlist_top(fact, 1)
    assert rows(top) == [("A", 10), ("B", 10)]


def test_scatter_and_count(spark):
    fact = spark.createDataFrame([(1, "b", 3, 7.5), (2, "a", 3, 7.5), (3, "c", 1, None)],
                                 "id bigint, name string, num_of_reviews bigint, average_rating double")
    assert rows(reports.scatter_points(fact)) == [(3, 7.5, "a")]
    assert reports.game_count(fact).first().n_items == 3


def _popularity_model(spark):
    from strata.operators import semantic as sem

    games = spark.createDataFrame([(1, "A", "on"), (2, "B", "on"), (3, "A", "on"), (4, "C", "off"), (5, "D", None)],
                                  "id bigint, name string, status string")
    pop = spark.createDataFrame(
        [(1, "t", 0.001), (3, "t", 0.0000123), (2, "t", 0.004), (4, "t", 9.0), (2, "u", 5.0), (9, "t", 1.0), (5, "x", 1.0)],
        "g bigint, ty string, popularity_score double")
    types = spark.createDataFrame([("t", "Type T"), ("u", "Type U")], "ty string, label string")
    related = sem.RelatedFact(pop, "g", {"popularity_type": sem.Dimension("popularity_type", types, "ty", "label")})
    return sem.SemanticModel(games, "id", {}, {"popularity": related})


def test_popularity_rank_by_name_keeps_small_scores(spark):
    m = _popularity_model(spark)
    ranked = {r.name: (r.popularity_score, r.popularity_rank) for r in
              reports.popularity_rank(m, {"status": ["on"], "popularity_type": ["Type T"], "top_n": [2]}).collect()}
    # games 1 and 3 share a name: their scores add up; status "off" is out
    assert ranked == {"B": (0.004, 1), "A": (0.0010123, 2)}
    flags = {r.name: (r.popularity_rank, r.is_top_n) for r in
             reports.popularity_flags(m, {"popularity_type": ["Type T"], "top_n": [1]}).collect()}
    assert flags == {"C": (1, 1), None: (2, 0), "B": (3, 0), "A": (4, 0)}  # game 9 is unknown: the blank name
    default = reports.popularity_rank(m, {"popularity_type": ["Type T"]})
    assert default.count() == 4


def test_facts_restrict_each_other(spark):
    from strata.operators import semantic as sem

    m = _popularity_model(spark)
    assert rows(sem.propagate(m, {"popularity_type": ["Type U"]}), "id") == [(2,)]
    assert rows(reports.types_with_known_status(m)) == [("Type T",), ("Type U",)]
    none = m.fact.filter("status is null")
    assert rows(sem.related_labels(m, "popularity", "popularity_type", none)) == [(None,)]  # type x has no member


def test_drill_levels(spark):
    from strata.sources.calendar import calendar

    fact = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 4, 1)), (3, None), (4, dt.date(1901, 1, 1))],
                                 "id bigint, date_first_release date")
    cal = calendar(spark, "2024-01-01", "2024-12-31", as_of="2024-06-15")
    out = reports.drill_by_release(fact, cal, ["Year", "QuarterName"], {"n": F.count("id")})
    got = sorted((r.Year or 0, r.QuarterName or "", r.drill_level, r.n) for r in out.collect())
    assert (0, "", 0, 4) in got and (2024, "", 1, 2) in got and (2024, "Q2", 2, 1) in got
    days = reports.drill_by_release(fact, cal, ["Year", "Date"], {"n": F.count("id")}).filter("drill_level = 2")
    # no date, and a date outside the calendar: one blank member
    assert {(r.Year, r.Date, r.n) for r in days.collect()} >= {(None, None, 2)}
    assert "1901" not in str(days.collect())


def test_case_insensitive_first_name_is_opt_in(spark):
    fact = spark.createDataFrame([(1, "a", 10, None), (2, "B", 10, None)],
                                 "id bigint, name string, wishlist_count bigint, date_first_release date")
    assert reports.most_wishlisted(fact).first().name == "B"  # code-point order
    out = reports.most_wishlisted(fact, collation="UNICODE_CI")
    assert out.first().name == "a"
    assert out.schema["name"].dataType.simpleString() == "string"


def test_dimension_switch_needs_one_selection(spark):
    from strata.operators import semantic as sem

    fact = spark.createDataFrame([(1, "a", 3, 7.5)], "id bigint, name string, num_of_reviews bigint, weighted_rating double")
    model = sem.SemanticModel(fact, "id", {"t": sem.Dimension("t", None, "name")})
    mapping = {"Types": "t", "Other": "t"}
    assert reports.top_labels_for_aspect(model, mapping, None) is None
    assert reports.top_labels_for_aspect(model, mapping, ["Types", "Other"]) is None
    assert rows(reports.top_labels_for_aspect(model, mapping, ["Types"])) == [("a", 3)]
