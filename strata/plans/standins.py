"""The game model expressed on the driver's TPC-H-like tables.

The shipped data has no games, so the same operators run on an item
catalogue that Spark derives from ``part`` and ``lineitem``; its size grows
with both tables. Every NULL, zero, duplicate and unknown key the cleaning
rules exist for comes from a data condition, never from a key-number rule:

* raw snapshot -- two overlapping "pages" of parts (sizes <= 30 and >= 21), so
  parts of size 21-30 arrive twice, as identical rows;
* ``total_rating`` -- mean of ``discount * 1000`` over the part's lines with
  quantity > 45 (NULL when there are none; 0 when all such lines had no
  discount);
* ``total_rating_count`` -- returned ('R') lines among those with quantity >
  40 (NULL when there are no such lines, 0 when none returned);
* ``hypes`` -- summed quantity of open lines with quantity >= 48 (NULL when none);
* ``first_release_date`` -- epoch of the first ship date of a non-returned
  ('N') line with quantity > 40; parts without one are "unreleased";
* ``game_status`` -- size div 8, looked up in ``region`` (5 and 6 are unknown);
* ``game_type`` -- the brand number, looked up in ``nation`` (25 is unknown);
* ``franchises`` -- an id array built from the part's own row: NULL for sizes
  above 45, empty for 41-45, else [size div 10, size div 8, size div 10]
  whose last element is NULL for prices from 990 up.

Dimensions of the semantic model: platform = supplier and genre = supplier
nation (both many-to-many through ``lineitem``), game mode = order priority
(many-to-many through ``lineitem`` and ``orders``), franchise = region via the
flattened array, game type = nation (many-to-one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import timestamp_to_epoch
from strata.operators import semantic as sem
from strata.plans import gold, silver
from strata.session import materialize_shared

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Report slicer selections used by the registered queries.
MODE_SELECTION = ["1-URGENT"]
GENRE_SELECTION = ["NATION_9"]
STATUS_SELECTION = ["AFRICA", "ASIA"]
POPULARITY_TYPE = ["PURCHASE"]
TOP_N = 25
AS_OF = "1998-06-15"  # inside the order dates: every relative-date flag takes both values

# dimension-switch labels -> stand-in dimensions
ASPECT_TO_DIM = {
    "Platforms": "platform",
    "Franchises": "franchise",
    "Game modes": "game_mode",
    "Genres": "genre",
    "Game types": "game_type",
}


class Tables:
    """Lazy readers for the driver's parquet tables, for one query: each table
    is resolved once and its frame reused, which also lets the planner
    recognise repeated scans of it. A layer that the query reads twice is
    written once (:meth:`layer`); nothing outlives the instance."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def layer(self, name: str, build) -> DataFrame:
        layers = self.__dict__.setdefault("_layers", {})
        if name not in layers:
            layers[name] = materialize_shared(build(), name)
        return layers[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        frames = self.__dict__.setdefault("_frames", {})
        if name not in frames:
            frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return frames[name]


def item_measures(lineitem: DataFrame) -> DataFrame:
    """Per-part raw measures from its lines (one partially aggregated group-by)."""
    q = F.col("l_quantity")
    return lineitem.groupBy(F.col("l_partkey")).agg(
        F.avg(F.when(q > 45, F.round(F.col("l_discount") * 100) * 10)).alias("total_rating"),
        F.sum(F.when(q > 40, F.when(F.col("l_returnflag") == "R", 1).otherwise(0))).cast("bigint")
         .alias("total_rating_count"),
        F.sum(F.when((F.col("l_linestatus") == "O") & (q >= 48), q.cast("bigint"))).cast("bigint")
         .alias("hypes"),
        timestamp_to_epoch(F.min(F.when((F.col("l_returnflag") == "N") & (q > 40), F.col("l_shipdate"))))
         .alias("first_release_date"),
    )


def franchise_array():
    size, price = F.col("p_size"), F.col("p_retailprice")
    div10, div8 = F.floor(size / 10).cast("bigint"), F.floor(size / 8).cast("bigint")
    return (F.when(size > 45, F.lit(None).cast("array<bigint>"))
             .when(size > 40, F.array().cast("array<bigint>"))
             .otherwise(F.array(div10, div8, F.when(price >= 990, F.lit(None)).otherwise(div10)))
             .cast("array<bigint>"))


def raw_items(t: Tables) -> DataFrame:
    """The bronze-shaped games snapshot, overlapping pages included."""
    part = t.part.select(
        F.col("p_partkey").cast("bigint").alias("id"),
        F.col("p_name").alias("name"),
        F.substring("p_brand", 7, 10).cast("bigint").alias("game_type"),
        F.floor(F.col("p_size") / 8).cast("bigint").alias("game_status"),
        franchise_array().alias("franchises"),
        F.col("p_size"),
    )
    items = part.join(item_measures(t.lineitem), part["id"] == F.col("l_partkey"), "left").drop("l_partkey")
    # Each row is emitted once per page holding it (page 1: size <= 30,
    # page 2: size >= 21): the union of both pages in a single pass.
    size = F.col("p_size")
    pages = F.filter(F.array(F.lit(1), F.lit(2)),
                     lambda pg: ((pg == 1) & (size <= 30)) | ((pg == 2) & (size >= 21)))
    return items.withColumn("_page", F.explode(pages)).drop("_page", "p_size")


def raw_entities(t: Tables) -> dict[str, DataFrame]:
    """Bronze-shaped snapshots of all nine entities. Games carry all four id
    arrays (each built from the part's own row); game modes are the order
    priorities, genres and game types the nations, platforms the suppliers,
    franchises and statuses the regions, popularity types the event types,
    measurements the events."""
    size = F.col("p_size")
    extra = t.part.select(
        F.col("p_partkey").alias("_key"),
        F.when(size <= 40, F.array((F.floor(size / 10) + 1).cast("bigint"))).alias("game_modes"),
        F.array(F.substring("p_brand", 7, 10).cast("bigint"), F.floor(size / 3).cast("bigint")).alias("genres"),
        F.when(size > 5, F.array(size.cast("bigint"), F.ascii("p_name").cast("bigint"))).otherwise(F.array().cast("array<bigint>")).alias("platforms"))
    games = raw_items(t)
    games = games.join(extra, games["id"] == extra["_key"]).drop("_key")
    first_order = timestamp_to_epoch(F.min("o_orderdate")).alias("created_at")
    first_event = timestamp_to_epoch(F.min("ts")).alias("created_at")
    nation = t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"),
                             (F.col("n_regionkey") * 86400).cast("bigint").alias("created_at"))
    first_ship = t.lineitem.groupBy("l_suppkey").agg(F.min("l_shipdate").alias("_first"))
    return {
        "raw_games": games,
        "raw_gamemode": t.orders.groupBy("o_orderpriority").agg(first_order).select(
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("id"), F.col("o_orderpriority").alias("name"), "created_at"),
        "raw_genre": nation,
        "raw_gametype": nation.withColumnRenamed("name", "type"),
        "raw_platform": t.supplier.join(first_ship, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
            F.col("s_suppkey").cast("bigint").alias("id"), F.col("s_name").alias("name"), timestamp_to_epoch("_first").alias("created_at")),
        "raw_franchise": t.region.select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"),
                                         (F.col("r_regionkey") * 86400).cast("bigint").alias("created_at")),
        "raw_gamestatus": status_dim(t),
        "raw_poptype": t.events.groupBy("event_type").agg(first_event).select(
            F.ascii("event_type").cast("bigint").alias("id"), F.col("event_type").alias("name"), "created_at"),
        "raw_popprimitive": t.events.select(
            F.col("event_id").cast("bigint").alias("id"), F.col("user_id").cast("bigint").alias("game_id"),
            F.ascii("event_type").cast("bigint").alias("popularity_type"), "value", timestamp_to_epoch("ts").alias("calculated_at")),
    }


def status_dim(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("status"))


def clean_items(t: Tables, raw: DataFrame | None = None) -> DataFrame:
    return silver.clean_games(raw_items(t) if raw is None else raw)


def bronze_items(t: Tables) -> DataFrame:
    """The raw snapshot (bronze) of the item catalogue, written once a query."""
    return t.layer("bronze-items", lambda: raw_items(t))


def silver_items(t: Tables) -> DataFrame:
    """The cleaned games (silver), written once a query."""
    return t.layer("silver-items", lambda: silver.clean_games(raw_items(t)))


def item_fact(t: Tables) -> DataFrame:
    """Game fact (a gold view) over the persisted silver games: the prior and
    the rows both read the deduplicated table, so the dedup never runs twice."""
    return gold.fct_games(silver_items(t), status_dim(t))


def franchise_bridge(t: Tables, raw: DataFrame | None = None) -> DataFrame:
    return silver.clean_bridge(raw_items(t) if raw is None else raw, "franchises", "fk_franchise")


def genre_bridge(t: Tables) -> DataFrame:
    """(part, nation of the supplier); lines with an unknown supplier keep a
    NULL key, the blank member. Pairs are deduplicated before the join, so a
    supplier's share of the lines never meets in one task."""
    sup = t.supplier.select("s_suppkey", "s_nationkey")
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    return (pairs.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left").select("l_partkey", "s_nationkey"))


def mode_bridge(t: Tables) -> DataFrame:
    """(part, order priority) through lineitem x orders: the one join here
    between two tables that both grow with the data. Lines are reduced to
    distinct (order, part) pairs first, with a partial aggregate in every
    task; lines with an unknown order keep a NULL key, the blank member."""
    lines = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("l_partkey", "o_orderpriority"))


def item_model(t: Tables, fact: DataFrame | None = None) -> sem.SemanticModel:
    fact = item_fact(t) if fact is None else fact
    nation = t.nation.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")
    region = t.region.select(F.col("r_regionkey").cast("bigint").alias("r_regionkey"), "r_name")
    dims = {
        "platform": sem.Dimension("platform", t.supplier.select("s_suppkey", "s_name"), "s_suppkey", "s_name",
                                  t.lineitem.select("l_partkey", "l_suppkey"), "l_partkey", "l_suppkey"),
        "genre": sem.Dimension("genre", nation, "n_nationkey", "n_name",
                               lambda: genre_bridge(t), "l_partkey", "s_nationkey"),
        "game_mode": sem.Dimension("game_mode", None, "o_orderpriority", None,
                                   lambda: mode_bridge(t), "l_partkey", "o_orderpriority"),
        "franchise": sem.Dimension("franchise", region, "r_regionkey", "r_name",
                                   lambda: franchise_bridge(t, bronze_items(t)), "fk_game", "fk_franchise"),
        # many-to-one and one-way: the key is read from the fact's own column
        "game_type": sem.Dimension("game_type", nation.withColumnRenamed("n_nationkey", "fk_game_type"),
                                   "fk_game_type", "n_name", both_directions=False),
    }
    measured = sem.RelatedFact(popularity(t), "fk_game", {
        "popularity_type": sem.Dimension("popularity_type", popularity_types(t), "fk_popularity_type", "type_label")})
    return sem.SemanticModel(fact, "id", dims, {"popularity": measured})


def popularity_types(t: Tables) -> DataFrame:
    """Popularity types: the event types but "error", which stays unknown."""
    known = t.events.select("event_type").distinct().filter(F.col("event_type") != "error")
    return known.select(F.col("event_type").alias("fk_popularity_type"), F.upper("event_type").alias("type_label"))


def popularity(t: Tables) -> DataFrame:
    """Events as popularity measurements: user = measured game, event type =
    popularity type, a ten-thousandth of the value = score (scores go down to
    a millionth)."""
    return t.events.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("fk_game"),
        F.col("event_type").alias("fk_popularity_type"), (F.col("value") * F.lit(1e-4)).alias("popularity_score"),
        F.col("ts"))
