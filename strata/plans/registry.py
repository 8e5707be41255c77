"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator family of the survey, each run over whole tables.

The matching DuckDB SQL lives in :mod:`strata.plans.oracles`; column names
agree one to one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import scalars as S
from strata.functions.exact import sum_exact
from strata.operators import quality as Q
from strata.operators import semantic as sem
from strata.functions.text import IGNORE_CASE
from strata.operators.flatten import flatten_bridge
from strata.operators.relations import model_graph
from strata.operators.summarize import summarize
from strata import schemas as SC
from strata.plans import gold, reports, silver
from strata.plans.daily import run_daily
from strata.plans.data_tests import SILVER_CHECKS, run_silver_checks
from strata.plans import standins as st
from strata.session import materialize_shared, scratch_path
from strata.sources import catalog
from strata.sources import snapshot as snap
from strata.sources.calendar import CALENDAR_COLUMNS, DATE_HIERARCHY, DEFAULT_END, DEFAULT_START, calendar

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str) -> st.Tables:
    return st.Tables(spark, sf_dir)


# ---- medallion models ------------------------------------------------------

def q_weighted_rating(spark, sf_dir):
    """Q2 flagship: game fact with the Bayesian weighted rating."""
    return st.item_fact(_t(spark, sf_dir))


def with_position(df, order):
    """``df`` with the place (from 1) of each row in ``order``: a range sort,
    numbered inside partitions and shifted by what earlier ones hold."""
    ordered = materialize_shared(df.orderBy(*order).withColumn("_part", F.spark_partition_id()), "ordered")
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (ordered.withColumn("_row", inside).join(F.broadcast(offsets), "_part")
            .withColumn("position", F.col("_offset") + F.col("_row")).drop("_part", "_row", "_offset"))


def q_clean_items(spark, sf_dir):
    """Q1: cleaned, deduplicated games from the overlapping-page snapshot."""
    return st.clean_items(_t(spark, sf_dir))


def q_status_lookup(spark, sf_dir):
    """Games per status label; unknown status ids form the NULL group."""
    fact = st.item_fact(_t(spark, sf_dir))
    return fact.groupBy("status").agg(F.count("id").alias("n_items"))


def q_epoch_to_date(spark, sf_dir):
    """F1 on event instants shifted so that some fall before 1970."""
    ev = _t(spark, sf_dir).events
    secs = (S.timestamp_to_epoch("ts") - F.lit(1705000000)).alias("epoch_s")
    return ev.select("event_id", secs).select("event_id", "epoch_s", S.epoch_to_date("epoch_s").alias("d"))


def q_bridge_flatten(spark, sf_dir):
    """Franchise bridge from the raw snapshot's id arrays (duplicates,
    NULL/empty arrays and NULL elements included)."""
    return st.franchise_bridge(_t(spark, sf_dir))


def q_embedding_flatten(spark, sf_dir):
    """J3 on float arrays: one row per embedding component."""
    emb = _t(spark, sf_dir).embeddings
    return flatten_bridge(emb, "vec_id", "embedding", "component", key_type=None)


def q_popularity_fact(spark, sf_dir):
    """Popularity measurements with the measuring day as a UTC date."""
    pop = _t(spark, sf_dir).events
    raw = pop.select(F.col("event_id").alias("id"), F.col("user_id").alias("game_id"),
                     F.col("event_type").alias("popularity_type"), "value",
                     S.timestamp_to_epoch("ts").alias("calculated_at"))
    return silver.clean_popularity(raw, type_as_id=False)


def q_dim_platform(spark, sf_dir):
    """Q1b + Q2c: the platform lookup (supplier; created = epoch of its first
    shipment) cleaned to a UTC date and published with display names."""
    t = _t(spark, sf_dir)
    first = t.lineitem.groupBy("l_suppkey").agg(F.min("l_shipdate").alias("_first"))
    raw = (t.supplier.join(first, F.col("s_suppkey") == F.col("l_suppkey"), "left")
             .select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                     S.timestamp_to_epoch("_first").alias("created_at")))
    return gold.with_display_names(silver.clean_lookup(raw), gold.DISPLAY_NAMES["dim_platform"])


def q_fct_daily_popularity(spark, sf_dir):
    """The popularity fact published with display names."""
    clean = q_popularity_fact(spark, sf_dir)
    return gold.with_display_names(gold.fct_daily_popularity(clean), gold.DISPLAY_NAMES["fct_daily_popularity"])


def q_popularity_by_weekday(spark, sf_dir):
    """The popularity fact written by day and read back for a calendar
    selection (weekends) whose days alone are read: measurements per type and
    day, with the exact sum of their scores."""
    base = scratch_path(spark, "popularity")
    version = gold.stage_popularity(q_popularity_fact(spark, sf_dir), f"{base}/gold/fct_daily_popularity", "all")
    catalog.runs.commit(spark, base, "all", {"gold/fct_daily_popularity": version})
    fact = catalog.read_current(spark, f"{base}/gold/fct_daily_popularity")
    rows = gold.measured_on(fact, calendar(spark, as_of=st.AS_OF), F.col("IsWeekend"))
    return rows.groupBy(gold.DAY, "fk_popularity_type").agg(
        F.count("id").alias("n_measured"), sum_exact(F.col("popularity_score")).cast("double").alias("sum_score"))


# ---- ingest ----------------------------------------------------------------

def q_union_pages(spark, sf_dir):
    """Three pages of parts with different columns, unioned by name."""
    part = _t(spark, sf_dir).part
    pages = [
        part.filter(F.col("p_size") <= 10).select("p_partkey", "p_name", "p_brand"),
        part.filter((F.col("p_size") > 10) & (F.col("p_size") <= 30)).select("p_partkey", "p_name", "p_type"),
        part.filter(F.col("p_size") > 30).select("p_partkey", "p_retailprice"),
    ]
    return snap.union_pages(pages)


CUSTOMER_CONTRACT = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.LongType()),
    T.StructField("c_acctbal", T.DecimalType(12, 2)),
    T.StructField("c_phone", T.StringType()),
])


def q_schema_align(spark, sf_dir):
    """A customer file with upper/mixed-case names, an extra column and a
    missing one, matched to the contract."""
    c = _t(spark, sf_dir).customer
    file_like = c.select(F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_name").alias("C_Name"),
                         F.col("c_nationkey").alias("c_NATIONKEY"), F.col("c_acctbal").alias("C_ACCTBAL"),
                         F.col("c_mktsegment").alias("C_MKTSEGMENT"))
    return snap.align_to_schema(file_like, CUSTOMER_CONTRACT)


DOCUMENT_CONTRACT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("half", T.LongType()),
    T.StructField("codes", T.ArrayType(T.LongType())),
])


def q_bad_rows(spark, sf_dir):
    """S3: documents against a contract that some break: texts over 255
    characters (measured whole), sizes that are no number, halves that are no
    whole number, lists with an element that is no number. One row per
    document with its quarantine reason."""
    docs = _t(spark, sf_dir).documents
    file_like = docs.select(
        "doc_id", "text", "lang",
        F.when(F.col("n_chars") < 400, "few").otherwise(F.col("n_chars").cast("string")).alias("size"),
        (F.col("n_chars") / 2).cast("double").alias("half"),
        F.array(F.substring("source", 4, 10), F.when(F.col("lang") == "de", "x").otherwise("7")).alias("codes"))
    flagged = snap.flag_bad_rows(file_like, DOCUMENT_CONTRACT)
    return flagged.select("doc_id", "lang", F.col(snap.BAD_REASON).alias("bad_reason"))


ORDERS_CONTRACT = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])


def q_snapshot_reload(spark, sf_dir):
    """Land the orders snapshot for a run date, load it twice
    with full refresh into bronze, read the bronze table back."""
    orders = _t(spark, sf_dir).orders
    base = scratch_path(spark, "landing")
    snap.land_snapshot(orders, base, "20240615", "orders")
    contracts = {"orders": ORDERS_CONTRACT}
    for _ in range(2):  # reloading the same day must give the same table
        roots = snap.load_all(spark, base, "20240615", contracts, base)
    return snap.read_bronze(spark, roots["orders"])


def q_mixed_day_load(spark, sf_dir):
    """S3 S4 on files: one day's orders arrive in parts that disagree. Finished
    orders have the contract's types; open ones come as text under upper-case
    names; those in process have no price, and text keys of which some are no
    numbers; a last file is no Parquet file at all. Every row, loaded or
    quarantined, with its reason (of the file, without its random name)."""
    orders = _t(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    base = scratch_path(spark, "mixed-day")
    path = snap.snapshot_path(base, "20240615", "orders")
    status = lambda s: orders.filter(F.col("o_orderstatus") == s)
    key = F.concat(F.when(F.col("o_orderpriority") == "5-LOW", "no. ").otherwise(""), F.col("o_orderkey").cast("string"))
    snap.land_snapshot(status("F"), base, "20240615", "orders")
    status("O").select(*[F.col(c).cast("string").alias(c.upper()) for c in orders.columns]).write.mode("append").parquet(path)
    status("P").select(key.alias("o_orderkey"), F.col("o_custkey").cast("int").alias("o_custkey"), "o_orderstatus", "o_orderpriority").write.mode("append").parquet(path)
    orders.select("o_orderpriority").distinct().coalesce(1).write.mode("append").text(path)
    contract = T.StructType([f for f in ORDERS_CONTRACT if f.name != "o_orderdate"])
    root = snap.load_all(spark, base, "20240615", {"orders": contract}, base)["orders"]
    loaded = snap.read_bronze(spark, root).withColumn("bad_reason", F.lit(None).cast("string"))
    bad = snap.read_bronze(spark, root, quarantined=True).withColumnRenamed(snap.BAD_REASON, "bad_reason")
    reason = F.regexp_replace("bad_reason", "(?s)^(unreadable file).*", "$1")
    return loaded.unionByName(bad).withColumn("bad_reason", reason)


MEDALLION_RUN_DATE = "20240615"


def q_medallion_run(spark, sf_dir):
    """S1-S9 + Q1/Q2 end to end: land the derived snapshots of all nine
    entities, run the daily pipeline (contract load, silver tables, gold views
    with display names) and return the published game fact."""
    base = scratch_path(spark, "medallion")
    for entity, frame in st.raw_entities(_t(spark, sf_dir)).items():
        snap.land_snapshot(frame, base, MEDALLION_RUN_DATE, entity)
    run_daily(spark, base, MEDALLION_RUN_DATE, base, contracts=SC.BRONZE_CONTRACTS, display_names=True, fail_on_test=False)
    return catalog.ref(spark, catalog.schema_name(None, "gold"), "fct_games")  # S9: named read


def _gold_model(name: str):
    def run(spark, sf_dir):
        raw = st.raw_entities(_t(spark, sf_dir))
        needed = {"raw_games" if "bridge" in name else "raw_" + name.removeprefix("dim_")}
        silver_models = silver.build_silver({k: v for k, v in raw.items() if k in needed})
        return gold.build_gold(silver_models, display=True)[name]
    run.__doc__ = f"Q1b/Q1d/Q2c: {name} from its raw entity, cleaned and published with display names."
    return run


def q_dq_all_models(spark, sf_dir):
    """The whole suite, 66 checks over the 13 silver models."""
    models = silver.build_silver(st.raw_entities(_t(spark, sf_dir)))
    return run_silver_checks({k: materialize_shared(v, k) for k, v in models.items()})


# ---- report queries --------------------------------------------------------

def q_top3_rated(spark, sf_dir):
    """Q5: top-3 names by weighted rating under the mode slicer."""
    t = _t(spark, sf_dir)
    model = st.item_model(t)
    return reports.top_rated(model, {"game_mode": st.MODE_SELECTION}, None, n=3)


def q_top3_rated_ties(spark, sf_dir):
    """Q5, tie-rich: the average as displayed in whole points, so several
    names share a place and all of them are kept."""
    model = st.item_model(_t(spark, sf_dir))
    return reports.top_rated(model, {"game_mode": st.MODE_SELECTION}, None, n=3, display_scale=0)


def q_popularity_rank(spark, sf_dir):
    """Q6: game names by dense popularity rank under the status and type
    slicers, the default ten kept."""
    model = st.item_model(_t(spark, sf_dir))
    return reports.popularity_rank(model, {"status": st.STATUS_SELECTION, "popularity_type": st.POPULARITY_TYPE,
                                           "game_mode": st.MODE_SELECTION})


def q_popularity_flags(spark, sf_dir):
    """Every game name's summed score with its dense rank and top-N
    flag, for one popularity type."""
    model = st.item_model(_t(spark, sf_dir))
    return reports.popularity_flags(model, {"popularity_type": st.POPULARITY_TYPE, "top_n": [st.TOP_N]})


def _top_labels(aspect: str, metric: str):
    def run(spark, sf_dir):
        model = st.item_model(_t(spark, sf_dir))
        return reports.top_labels_for_aspect(model, st.ASPECT_TO_DIM, [aspect], metric, 5)
    run.__doc__ = f"Q7/Q8/Q9: top-5 {aspect} by {metric}, ties kept."
    return run


def _top_labels_in_status(aspect: str, metric: str):
    def run(spark, sf_dir):
        model = st.item_model(_t(spark, sf_dir))
        visual = "top5_by_rating" if metric == "rating" else "top5_by_reviews"
        context = reports.context_for(visual, {"status": st.STATUS_SELECTION, "game_mode": st.MODE_SELECTION, "aspect": [aspect]})
        facts = reports.facts_in_context(model, None, context["status"])
        return reports.top_labels_for_aspect(model, st.ASPECT_TO_DIM, context["aspect"], metric, 5, facts)
    run.__doc__ = f"Q7/Q8/Q9 under the status slicer (the mode slicer doesn't reach it): top-5 {aspect} by {metric}."
    return run


def q_status_list(spark, sf_dir):
    """Q15: status slicer values; unknown statuses are its blank."""
    return st.item_fact(_t(spark, sf_dir)).select("status").distinct()


def q_genre_list(spark, sf_dir):
    """Q15: genre labels under the status slicer."""
    model = st.item_model(_t(spark, sf_dir))
    return reports.slicer_values(model, "genre", reports.facts_in_context(model, None, st.STATUS_SELECTION))


def q_wishlist_order(spark, sf_dir):
    """L1: the wishlist table in its display order, with each row's position
    in the ordered result."""
    top = reports.wishlist_top(st.item_fact(_t(spark, sf_dir)), 25)
    order = [F.col("wishlist_count").desc(), F.col("name")]
    return with_position(top, order)


def q_top3_rated_order(spark, sf_dir):
    """L1: the top-3 visual in its display order (average down, then name),
    with each row's position; averages as displayed, so places are shared."""
    top = reports.top_rated(st.item_model(_t(spark, sf_dir)), {"game_mode": st.MODE_SELECTION}, None, n=3, display_scale=0)
    return with_position(top, [F.col("avg_weighted_rating").desc(), F.col("name")])


def q_popularity_rank_order(spark, sf_dir):
    """L1: the rank table in its display order (rank up, then name), with each
    row's position."""
    top = reports.popularity_rank(st.item_model(_t(spark, sf_dir)), {"status": st.STATUS_SELECTION, "popularity_type": st.POPULARITY_TYPE})
    return with_position(top, [F.col("popularity_rank"), F.col("name")])


def q_most_wishlisted(spark, sf_dir):
    """Q4: most wishlisted unreleased game."""
    return reports.most_wishlisted(st.item_fact(_t(spark, sf_dir)))


def q_wishlist_top5(spark, sf_dir):
    """Q12: top-5 unreleased names by wishlist."""
    return reports.wishlist_top(st.item_fact(_t(spark, sf_dir)), 5)


def q_scatter_points(spark, sf_dir):
    """Q10: rating vs reviews points."""
    return reports.scatter_points(st.item_fact(_t(spark, sf_dir)))


def q_item_count(spark, sf_dir):
    """Q11: games under the status slicer."""
    model = st.item_model(_t(spark, sf_dir))
    return reports.game_count(reports.facts_in_context(model, None, st.STATUS_SELECTION))


def q_filter_propagation(spark, sf_dir):
    """Status, mode and genre filters meet on the game fact."""
    model = st.item_model(_t(spark, sf_dir))
    facts = sem.propagate(model, {"game_mode": st.MODE_SELECTION, "genre": st.GENRE_SELECTION},
                          F.col("status").isin(st.STATUS_SELECTION))
    return facts.select("id", "name", "status")


def _graph_filters():
    return {"game_mode bridge": F.col("o_orderpriority").isin(st.MODE_SELECTION), "genre": F.col("n_name").isin(st.GENRE_SELECTION),
            "fact": F.col("status").isin(st.STATUS_SELECTION)}


def q_graph_popularity(spark, sf_dir):
    """J6 over the declared relationships: mode, genre and status filters
    reach the popularity measurements through bridges and games."""
    graph = model_graph(st.item_model(_t(spark, sf_dir)))
    rows = graph.reduce(_graph_filters(), ["popularity"])["popularity"]
    return rows.select("id", "fk_game", "fk_popularity_type")


def q_graph_counts(spark, sf_dir):
    """J6 over the declared relationships: rows of every table of the model
    that survive a popularity-type filter and a mode filter at once."""
    graph = model_graph(st.item_model(_t(spark, sf_dir)))
    kept = graph.reduce({"popularity_type": F.col("type_label").isin(st.POPULARITY_TYPE),
                         "game_mode bridge": F.col("o_orderpriority").isin(st.MODE_SELECTION)})
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, df in kept.items()]
    return functools.reduce(DataFrame.unionByName, counts)


def _respelled_model(t):
    """The item model with the games' names in capitals where their reviews
    are odd: names that differ only by case, as sources spell them."""
    fact = st.item_fact(t)
    odd = F.col("num_of_reviews") % 2 == 1
    return st.item_model(t, fact.withColumn("name", F.when(odd, F.upper("name")).otherwise(F.col("name"))))


def q_top3_rated_collated(spark, sf_dir):
    """Q5 ignoring case (A4 A5 A7 L1): names that differ by case are one."""
    return reports.top_rated(_respelled_model(_t(spark, sf_dir)), {"game_mode": st.MODE_SELECTION}, None, n=3, collation=IGNORE_CASE)


def q_popularity_rank_collated(spark, sf_dir):
    """Q6 ignoring case (A4 W1 L1): measurements of names that differ by case
    are summed and ranked as one."""
    model = _respelled_model(_t(spark, sf_dir))
    return reports.popularity_rank(model, {"status": st.STATUS_SELECTION, "popularity_type": st.POPULARITY_TYPE}, collation=IGNORE_CASE)


def q_wishlist_top5_collated(spark, sf_dir):
    """Q12 ignoring case (A4 L1 L2)."""
    return reports.wishlist_top(_respelled_model(_t(spark, sf_dir)).fact, 5, collation=IGNORE_CASE)


def q_scatter_points_collated(spark, sf_dir):
    """Q10 ignoring case (A7): each point's first name in the BI tool's order
    (shown in small letters, as several spellings may come first)."""
    points = reports.scatter_points(_respelled_model(_t(spark, sf_dir)).fact, collation=IGNORE_CASE)
    return points.withColumn("name", F.lower("name"))


def q_types_with_status(spark, sf_dir):
    """Q13: popularity types measured for games with a known status."""
    return reports.types_with_known_status(st.item_model(_t(spark, sf_dir)))


def q_label_lists(spark, sf_dir):
    """Q15: game-mode slicer values under the status slicer."""
    model = st.item_model(_t(spark, sf_dir))
    facts = reports.facts_in_context(model, None, ["EUROPE"])
    return reports.slicer_values(model, "game_mode", facts)


def q_calendar_dim(spark, sf_dir):
    """Q3: every day of the calendar with its number of orders; orders of
    other days, or of none, are in the blank member."""
    orders = _t(spark, sf_dir).orders
    day = F.to_date("o_orderdate")
    known = F.when(day.between(F.lit(DEFAULT_START), F.lit(DEFAULT_END)), day)
    per_day = orders.groupBy(known.alias("_day")).agg(F.count(F.lit(1)).alias("n_orders"))
    cal = calendar(spark, as_of=st.AS_OF)
    return cal.join(per_day, F.col("Date") == F.col("_day"), "full_outer").select(
        *CALENDAR_COLUMNS, F.coalesce("n_orders", F.lit(0).cast("bigint")).alias("n_orders"))


def q_drill_by_date(spark, sf_dir):
    """Q14: games by release date over the whole hierarchy (year > quarter >
    month > short month > day), all levels at once."""
    t = _t(spark, sf_dir)
    fact = st.item_fact(t)
    cal = calendar(spark, as_of=st.AS_OF)
    return reports.drill_by_release(fact, cal, DATE_HIERARCHY, {
        "n_items": F.count("id"),
        "sum_reviews": F.sum("num_of_reviews").cast("bigint"),
        "sum_wishlist": F.sum("wishlist_count").cast("bigint"),
    })


LINEITEM_SUMMARY = {
    "l_orderkey": "count",
    "l_quantity": "sum",
    "l_extendedprice": "sum",
    "l_discount": "avg",
    "l_linenumber": "none",
    "l_shipdate": "none",
}


def q_default_summary(spark, sf_dir):
    """Each column's default summarization, by return flag and status."""
    li = _t(spark, sf_dir).lineitem
    out = summarize(li, ["l_returnflag", "l_linestatus"], LINEITEM_SUMMARY)
    return out.select("l_returnflag", "l_linestatus", "count_l_orderkey", "sum_l_quantity",
                      F.round("sum_l_extendedprice", 2).alias("sum_l_extendedprice"),
                      F.round("avg_l_discount", 6).alias("avg_l_discount"))


def q_fact_summary(spark, sf_dir):
    """A14 on the game fact: its model-defined default summaries by status
    (2-decimal weighted ratings summed, then rounded back to cents)."""
    fact = st.item_fact(_t(spark, sf_dir))
    meta = {k: v for k, v in gold.DEFAULT_SUMMARY["fct_games"].items() if k != "average_rating"}
    out = summarize(fact, ["status"], meta)
    return out.withColumn("sum_weighted_rating", F.round("sum_weighted_rating", 2))


def q_popularity_summary(spark, sf_dir):
    """A14 on the popularity fact: count of measurements and summed score per
    popularity type, as its metadata defines. Scores are summed exactly and
    never rounded: they go down to a millionth."""
    events = st.popularity(_t(spark, sf_dir))
    fact = gold.fct_daily_popularity(events.withColumn("date_measured_at", F.to_date("ts")))
    return summarize(fact, ["fk_popularity_type"], gold.DEFAULT_SUMMARY["fct_daily_popularity"], exact=["popularity_score"])


# ---- data tests ------------------------------------------------------------

def q_dq_unique(spark, sf_dir):
    """Repeated (order, line number) keys of lineitem."""
    return Q.unique(_t(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


def q_dq_not_null(spark, sf_dir):
    """Cleaned games without a rating."""
    return Q.not_null(st.clean_items(_t(spark, sf_dir)), "average_rating").select("id", "name")


def q_dq_range(spark, sf_dir):
    """D3: event values outside [0, 400]."""
    return Q.accepted_range(_t(spark, sf_dir).events, "value", 0, 400).select("event_id", "value")


def q_dq_values(spark, sf_dir):
    """Orders whose status is not one of the accepted values."""
    return Q.accepted_values(_t(spark, sf_dir).orders, "o_orderstatus", ["F", "O"]) \
        .select("o_orderkey", "o_orderstatus")


# the silver games checks, plus release date present (fails for unreleased items)
CLEAN_GAMES_CHECKS = SILVER_CHECKS["clean_games"] + [Q.Check("not_null", "date_first_release")]


def q_dq_suite(spark, sf_dir):
    """The cleaned-games test suite in one aggregation pass + one group-by."""
    return Q.run_checks(st.clean_items(_t(spark, sf_dir)), CLEAN_GAMES_CHECKS, "clean_items")


QUERIES: dict[str, Query] = {
    "weighted_rating": q_weighted_rating,
    "clean_items": q_clean_items,
    "status_lookup": q_status_lookup,
    "epoch_to_date": q_epoch_to_date,
    "bridge_flatten": q_bridge_flatten,
    "embedding_flatten": q_embedding_flatten,
    "popularity_fact": q_popularity_fact,
    "fct_daily_popularity": q_fct_daily_popularity,
    "dim_platform": q_dim_platform,
    "union_pages": q_union_pages,
    "schema_align": q_schema_align,
    "bad_rows": q_bad_rows,
    "snapshot_reload": q_snapshot_reload,
    "medallion_run": q_medallion_run,
    "top3_rated": q_top3_rated,
    "top3_rated_ties": q_top3_rated_ties,
    "popularity_rank": q_popularity_rank,
    "popularity_flags": q_popularity_flags,
    "top5_aspect_rating": _top_labels("Genres", "rating"),
    "top5_aspect_reviews": _top_labels("Genres", "reviews"),
    "top5_platform_rating": _top_labels("Platforms", "rating"),
    "top5_mode_reviews": _top_labels("Game modes", "reviews"),
    "top5_franchise_reviews": _top_labels("Franchises", "reviews"),
    "top5_game_type_rating": _top_labels("Game types", "rating"),
    "most_wishlisted": q_most_wishlisted,
    "wishlist_top5": q_wishlist_top5,
    "scatter_points": q_scatter_points,
    "item_count": q_item_count,
    "filter_propagation": q_filter_propagation,
    "types_with_status": q_types_with_status,
    "label_lists": q_label_lists,
    "calendar_dim": q_calendar_dim,
    "drill_by_date": q_drill_by_date,
    "default_summary": q_default_summary,
    "fact_summary": q_fact_summary,
    "popularity_summary": q_popularity_summary,
    "dq_unique": q_dq_unique,
    "dq_not_null": q_dq_not_null,
    "dq_range": q_dq_range,
    "dq_values": q_dq_values,
    "dq_suite": q_dq_suite,
    "dq_all_models": q_dq_all_models,
    "dim_franchise": _gold_model("dim_franchise"),
    "dim_gamemode": _gold_model("dim_gamemode"),
    "dim_gametype": _gold_model("dim_gametype"),
    "dim_genre": _gold_model("dim_genre"),
    "dim_poptype": _gold_model("dim_poptype"),
    "dim_bridge_franchise": _gold_model("dim_bridge_franchise"),
    "dim_bridge_gamemode": _gold_model("dim_bridge_gamemode"),
    "dim_bridge_genre": _gold_model("dim_bridge_genre"),
    "dim_bridge_platform": _gold_model("dim_bridge_platform"),
    "top5_genre_rating_status": _top_labels_in_status("Genres", "rating"),
    "top5_mode_reviews_status": _top_labels_in_status("Game modes", "reviews"),
    "status_list": q_status_list,
    "genre_list": q_genre_list,
    "wishlist_order": q_wishlist_order,
    "mixed_day_load": q_mixed_day_load,
    "popularity_by_weekday": q_popularity_by_weekday,
    "top3_rated_order": q_top3_rated_order,
    "popularity_rank_order": q_popularity_rank_order,
    "graph_popularity": q_graph_popularity,
    "graph_counts": q_graph_counts,
    "top3_rated_collated": q_top3_rated_collated,
    "popularity_rank_collated": q_popularity_rank_collated,
    "wishlist_top5_collated": q_wishlist_top5_collated,
    "scatter_points_collated": q_scatter_points_collated,
}
