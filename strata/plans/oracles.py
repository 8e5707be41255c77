"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables are the driver's pre-registered views. Each statement is written from
the query's definition, independently of the Spark code; column names match
the Spark results one to one. Integer widths are cast to Spark's (``int`` for
date parts, ``bigint`` for sums), and fixed-decimal means use the same exact
integer-cent arithmetic as the reports.
"""

from __future__ import annotations

from strata.plans.standins import AS_OF, GENRE_SELECTION, MODE_SELECTION, POPULARITY_TYPE, STATUS_SELECTION, TOP_N


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _date_from_epoch(expr: str) -> str:
    return f"CAST(DATE '1970-01-01' + CAST(floor(({expr}) / 86400) AS INTEGER) AS DATE)"


def _exact_avg(col: str) -> str:
    return (f"CAST(sum(CAST(round({col} * 100) AS BIGINT)) AS DOUBLE) "
            f"/ CAST(NULLIF(count({col}), 0) * 100 AS DOUBLE)")


# The item catalogue and the game fact built on it (see strata.plans.standins).
# ``{rating}`` is the loaded rating: as derived, or through the bronze
# contract's decimal(5,2).
_ITEMS = """
li_agg AS (
  SELECT l_partkey,
         avg(CASE WHEN l_quantity > 45 THEN round(l_discount * 100) * 10 END) AS total_rating,
         CAST(sum(CASE WHEN l_quantity > 40 THEN CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END END) AS BIGINT)
           AS total_rating_count,
         CAST(sum(CASE WHEN l_linestatus = 'O' AND l_quantity >= 48 THEN CAST(l_quantity AS BIGINT) END) AS BIGINT)
           AS hypes,
         CAST(floor(epoch(min(CASE WHEN l_returnflag = 'N' AND l_quantity > 40 THEN l_shipdate END))) AS BIGINT)
           AS first_release_date
  FROM lineitem GROUP BY l_partkey
),
items AS (
  SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS name,
         CAST(substring(p_brand, 7, 10) AS BIGINT) AS game_type,
         CAST(floor(p_size / 8) AS BIGINT) AS game_status,
         CASE WHEN p_size > 45 THEN NULL
              WHEN p_size > 40 THEN CAST([] AS BIGINT[])
              ELSE [CAST(floor(p_size / 10) AS BIGINT), CAST(floor(p_size / 8) AS BIGINT),
                    CASE WHEN p_retailprice >= 990 THEN NULL ELSE CAST(floor(p_size / 10) AS BIGINT) END]
         END AS franchises,
         p_size, total_rating, total_rating_count, hypes, first_release_date
  FROM part LEFT JOIN li_agg ON p_partkey = l_partkey
),
raw_items AS (
  SELECT * FROM items WHERE p_size <= 30
  UNION ALL
  SELECT * FROM items WHERE p_size >= 21
),
clean_items AS (
  SELECT DISTINCT id, name, game_type AS fk_game_type, {rating} AS average_rating,
         CAST(CASE WHEN total_rating_count = 0 AND total_rating > 0 AND total_rating < 95 THEN 1
                   WHEN total_rating_count > 0 AND total_rating = 0 THEN 0
                   ELSE coalesce(total_rating_count, 0) END AS BIGINT) AS num_of_reviews,
         CAST(coalesce(hypes, 0) AS BIGINT) AS wishlist_count,
         game_status AS fk_status,
         {release} AS date_first_release
  FROM raw_items
),
prior AS (
  SELECT avg(CAST(average_rating AS DOUBLE)) AS global_mean, median(num_of_reviews) AS confidence_threshold
  FROM clean_items WHERE average_rating IS NOT NULL AND num_of_reviews > 0
),
fact AS (
  SELECT c.id, c.name, c.fk_game_type, r.r_name AS status, c.average_rating, c.num_of_reviews,
         c.wishlist_count, c.date_first_release,
         round((p.confidence_threshold * p.global_mean + CAST(c.average_rating AS DOUBLE) * c.num_of_reviews)
               / (p.confidence_threshold + c.num_of_reviews), 2) + 0.0 AS weighted_rating
  FROM clean_items c LEFT JOIN region r ON c.fk_status = r.r_regionkey CROSS JOIN prior p
)"""


def _items(rating: str = "total_rating") -> str:
    return _ITEMS.replace("{rating}", rating).replace("{release}", _date_from_epoch("first_release_date"))


ITEMS = _items()

DISPLAY_FACT = ", ".join(f'{src} AS "{dst}"' for src, dst in [
    ("id", "Game ID"), ("name", "Game name"), ("fk_game_type", "Game type ID"), ("status", "Status"),
    ("average_rating", "Average rating"), ("num_of_reviews", "Number of reviews"),
    ("wishlist_count", "Wishlist count"), ("date_first_release", "Date game initial release"),
    ("weighted_rating", "Weighted rating")])

PAIRS = {
    "platform": """SELECT DISTINCT s.s_name AS label, l.l_partkey AS id
                   FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "genre": """SELECT DISTINCT n.n_name AS label, l.l_partkey AS id
                FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
                LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "game_mode": """SELECT DISTINCT o.o_orderpriority AS label, l.l_partkey AS id
                    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "franchise": """SELECT DISTINCT r.r_name AS label, b.id
                    FROM (SELECT id, unnest(franchises) AS fk FROM raw_items) b
                    LEFT JOIN region r ON b.fk = r.r_regionkey""",
    "game_type": """SELECT DISTINCT n.n_name AS label, f.id
                    FROM fact f LEFT JOIN nation n ON f.fk_game_type = n.n_nationkey""",
}


def _top_labels(dim: str, metric: str, where: str = "TRUE") -> str:
    if metric == "reviews":
        aggs, key, cols = "CAST(sum(f.num_of_reviews) AS BIGINT) AS sum_reviews", "sum_reviews", "label, sum_reviews"
    else:
        aggs = (f"{_exact_avg('f.weighted_rating')} AS avg_weighted_rating, "
                "CAST(sum(f.num_of_reviews) AS BIGINT) AS sum_reviews")
        key, cols = "avg_weighted_rating", "label, avg_weighted_rating, sum_reviews"
    return f"""WITH {ITEMS},
pairs AS ({PAIRS[dim]}),
per AS (SELECT p.label, {aggs} FROM pairs p JOIN fact f ON p.id = f.id WHERE {where} GROUP BY p.label),
ranked AS (SELECT *, rank() OVER (ORDER BY {key} DESC) AS rk FROM per WHERE {key} IS NOT NULL)
SELECT {cols} FROM ranked WHERE rk <= 5"""


def _cal_cols(d: str, as_of: str) -> str:
    return f"""{d} AS "Date",
  CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS "DateKey",
  CAST(year({d}) AS INTEGER) AS "Year",
  CAST(month({d}) AS INTEGER) AS "MonthNumber",
  strftime({d}, '%B') AS "MonthName",
  strftime({d}, '%b') AS "MonthShort",
  CAST(quarter({d}) AS INTEGER) AS "Quarter",
  'Q' || CAST(quarter({d}) AS VARCHAR) AS "QuarterName",
  CAST(day({d}) AS INTEGER) AS "DayOfMonth",
  CAST(isodow({d}) AS INTEGER) AS "DayOfWeekNumber",
  strftime({d}, '%A') AS "DayOfWeekName",
  strftime({d}, '%a') AS "DayOfWeekShort",
  CAST(floor((dayofyear({d}) - 1 + isodow(CAST(date_trunc('year', {d}) AS DATE)) - 1) / 7) + 1 AS INTEGER)
    AS "WeekOfYear",
  CAST(dayofyear({d}) AS INTEGER) AS "DayOfYear",
  CAST(year({d}) * 100 + month({d}) AS INTEGER) AS "YearMonth",
  strftime({d}, '%Y %b') AS "YearMonthName",
  CAST(year({d}) * 10 + quarter({d}) AS INTEGER) AS "YearQuarter",
  strftime({d}, '%Y') || ' Q' || CAST(quarter({d}) AS VARCHAR) AS "YearQuarterName",
  isodow({d}) >= 6 AS "IsWeekend",
  isodow({d}) < 6 AS "IsWeekday",
  day(make_date(CAST(year({d}) AS INTEGER), 3, 1) - INTERVAL 1 DAY) = 29 AS "IsLeapYear",
  year({d}) = year(DATE '{as_of}') AS "IsCurrentYear",
  year({d}) = year(DATE '{as_of}') AND month({d}) = month(DATE '{as_of}') AS "IsCurrentMonth",
  year({d}) = year(DATE '{as_of}') AND quarter({d}) = quarter(DATE '{as_of}') AS "IsCurrentQuarter",
  {d} < DATE '{as_of}' AS "IsPastDate",
  {d} > DATE '{as_of}' AS "IsFutureDate\""""


CALENDAR = f"""cal AS (
  SELECT {_cal_cols("d", AS_OF)}
  FROM (SELECT CAST(g AS DATE) AS d
        FROM generate_series(DATE '1990-01-01', DATE '2030-12-31', INTERVAL 1 DAY) t(g))
)"""

CHECKS_CLEAN_ITEMS = [
    ("unique:id", "(SELECT count(*) FROM (SELECT id FROM clean_items WHERE id IS NOT NULL "
                  "GROUP BY id HAVING count(*) > 1))"),
    ("not_null:id", "(SELECT count(*) FILTER (WHERE id IS NULL) FROM clean_items)"),
    ("accepted_range:id", "(SELECT count(*) FILTER (WHERE id IS NOT NULL AND NOT (id >= 0)) FROM clean_items)"),
    ("not_null:name", "(SELECT count(*) FILTER (WHERE name IS NULL) FROM clean_items)"),
    ("accepted_range:average_rating",
     "(SELECT count(*) FILTER (WHERE average_rating IS NOT NULL AND NOT (average_rating >= 0 "
     "AND average_rating <= 100)) FROM clean_items)"),
    ("not_null:num_of_reviews", "(SELECT count(*) FILTER (WHERE num_of_reviews IS NULL) FROM clean_items)"),
    ("accepted_range:num_of_reviews",
     "(SELECT count(*) FILTER (WHERE num_of_reviews IS NOT NULL AND NOT (num_of_reviews >= 0)) FROM clean_items)"),
    ("not_null:wishlist_count", "(SELECT count(*) FILTER (WHERE wishlist_count IS NULL) FROM clean_items)"),
    ("accepted_range:wishlist_count",
     "(SELECT count(*) FILTER (WHERE wishlist_count IS NOT NULL AND NOT (wishlist_count >= 0)) FROM clean_items)"),
    ("not_null:date_first_release",
     "(SELECT count(*) FILTER (WHERE date_first_release IS NULL) FROM clean_items)"),
]


def _dq_suite() -> str:
    rows = "\n  UNION ALL ".join(
        f"SELECT {i} AS pos, '{name}' AS \"check\", CAST({expr} AS BIGINT) AS failures"
        for i, (name, expr) in enumerate(CHECKS_CLEAN_ITEMS))
    return f"""WITH {ITEMS}
SELECT 'clean_items' AS "table", pos, "check", failures FROM (
  {rows}
)"""


# The raw entities as SQL, and the silver models on them, for the whole suite.
_NATION = "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey * 86400 AS BIGINT) AS created_at FROM nation"
_GAMES = """SELECT r.*, CASE WHEN p.p_size <= 40 THEN [CAST(floor(p.p_size / 10) + 1 AS BIGINT)] END AS game_modes,
       [CAST(substring(p.p_brand, 7, 10) AS BIGINT), CAST(floor(p.p_size / 3) AS BIGINT)] AS genres,
       CASE WHEN p.p_size > 5 THEN [CAST(p.p_size AS BIGINT), CAST(ascii(p.p_name) AS BIGINT)] ELSE CAST([] AS BIGINT[]) END AS platforms
FROM raw_items r JOIN part p ON r.id = p.p_partkey"""


def _created(source: str, label: str = "name") -> str:
    return f"SELECT id, {label}, {_date_from_epoch('created_at')} AS date_created_at FROM ({source})"


_MODELS = {
    "clean_games": "SELECT * FROM clean_items",
    "clean_franchise": _created("SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, CAST(r_regionkey * 86400 AS BIGINT) AS created_at FROM region"),
    "clean_gamemode": _created("""SELECT CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS id, o_orderpriority AS name,
       CAST(floor(epoch(min(o_orderdate))) AS BIGINT) AS created_at FROM orders GROUP BY o_orderpriority"""),
    "clean_gametype": _created(f"SELECT id, name AS type, created_at FROM ({_NATION})", "type"),
    "clean_genre": _created(_NATION),
    "clean_platform": _created("""SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, created_at FROM supplier
       LEFT JOIN (SELECT l_suppkey, CAST(floor(epoch(min(l_shipdate))) AS BIGINT) AS created_at FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey"""),
    "clean_poptype": "SELECT CAST(ascii(event_type) AS BIGINT) AS id, event_type AS name FROM events GROUP BY event_type",
    "clean_popprimitive": f"""SELECT CAST(event_id AS BIGINT) AS id, CAST(user_id AS BIGINT) AS fk_game,
       CAST(ascii(event_type) AS BIGINT) AS fk_popularity_type, value AS popularity_score,
       {_date_from_epoch("CAST(floor(epoch(ts)) AS BIGINT)")} AS date_measured_at FROM events""",
    "clean_gamestatus": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS status FROM region",
    "clean_bridge_franchise": "SELECT id AS fk_game, unnest(franchises) AS fk_franchise FROM games",
    "clean_bridge_gamemode": "SELECT id AS fk_game, unnest(game_modes) AS fk_game_mode FROM games",
    "clean_bridge_genre": "SELECT id AS fk_game, unnest(genres) AS fk_genre FROM games",
    "clean_bridge_platform": "SELECT id AS fk_game, unnest(platforms) AS fk_platform FROM games",
}


def _with_models(names) -> str:
    games = f", games AS ({_GAMES})" if any("bridge" in n for n in names) else ""
    return f"WITH {ITEMS}{games}, " + ", ".join(f"{n} AS ({_MODELS[n]})" for n in names if n != "clean_games")


def _failures(model: str, check) -> str:
    c = check.column
    if check.kind == "unique":
        return f"(SELECT count(*) FROM (SELECT {c} FROM {model} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
    if check.kind == "not_null":
        wrong = f"{c} IS NULL"
    elif check.kind == "accepted_values":
        wrong = f"{c} IS NOT NULL AND {c} NOT IN ({_in(check.params['values'])})"
    else:
        high = f" AND {c} <= {check.params['max_value']}" if "max_value" in check.params else ""
        wrong = f"{c} IS NOT NULL AND NOT ({c} >= {check.params['min_value']}{high})"
    return f"(SELECT count(*) FILTER (WHERE {wrong}) FROM {model})"


def _dq_all_models() -> str:
    from strata.plans.data_tests import SILVER_CHECKS

    rows = "\nUNION ALL ".join(
        f"SELECT '{model}' AS \"table\", {pos} AS pos, '{check.name}' AS \"check\", CAST({_failures('clean_items' if model == 'clean_games' else model, check)} AS BIGINT) AS failures"
        for model, checks in SILVER_CHECKS.items() for pos, check in enumerate(checks))
    return f"{_with_models(list(_MODELS))} {rows}"


def _gold_model(name: str) -> str:
    from strata.plans.gold import DISPLAY_NAMES

    model = "clean_" + name.removeprefix("dim_")
    columns = ", ".join(f'{src} AS "{dst}"' for src, dst in DISPLAY_NAMES[name].items())
    return f"{_with_models([model])} SELECT {columns} FROM {model}"


_RESPELLED = ", respelled AS (SELECT * REPLACE (CASE WHEN num_of_reviews % 2 = 1 THEN upper(name) ELSE name END AS name) FROM fact)"

# Rows of every table of the item model that a popularity-type and a mode filter leave.
_MEASURED = f"SELECT user_id FROM events WHERE upper(event_type) IN ({_in(POPULARITY_TYPE)}) AND event_type <> 'error'"
_IN_MODE = f"SELECT l.l_partkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderpriority IN ({_in(MODE_SELECTION)})"
_GRAPH_COUNTS = {
    "fact": "SELECT * FROM kept",
    "platform": "SELECT * FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_partkey IN (SELECT id FROM kept))",
    "platform bridge": "SELECT * FROM lineitem WHERE l_partkey IN (SELECT id FROM kept)",
    "genre": """SELECT * FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_suppkey IN
                (SELECT l_suppkey FROM lineitem WHERE l_partkey IN (SELECT id FROM kept)))""",
    "genre bridge": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT id FROM kept)",
    "game_mode bridge": f"""SELECT DISTINCT l.l_orderkey, l.l_partkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                            WHERE o.o_orderpriority IN ({_in(MODE_SELECTION)}) AND l.l_partkey IN (SELECT id FROM kept)""",
    "franchise": """SELECT * FROM region WHERE r_regionkey IN (SELECT fk FROM (SELECT id, unnest(franchises) AS fk FROM raw_items)
                    WHERE id IN (SELECT id FROM kept))""",
    "franchise bridge": "SELECT * FROM (SELECT id, unnest(franchises) AS fk FROM raw_items) WHERE id IN (SELECT id FROM kept)",
    "game_type": "SELECT * FROM nation",
    "popularity": f"SELECT * FROM events WHERE upper(event_type) IN ({_in(POPULARITY_TYPE)}) AND user_id IN (SELECT id FROM kept)",
    "popularity_type": f"""SELECT DISTINCT event_type FROM events WHERE event_type <> 'error' AND upper(event_type) IN ({_in(POPULARITY_TYPE)})""",
}


ORACLES: dict[str, str] = {
    "mixed_day_load": """SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderkey AS BIGINT) END AS o_orderkey,
       CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DOUBLE) END AS o_totalprice,
       o_orderpriority, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'o_orderkey: not bigint' END AS bad_reason
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 'unreadable file'""",
    "graph_popularity": f"""WITH {ITEMS}
SELECT event_id AS id, user_id AS fk_game, event_type AS fk_popularity_type FROM events
WHERE user_id IN (SELECT id FROM fact WHERE status IN ({_in(STATUS_SELECTION)})) AND user_id IN ({_IN_MODE})
  AND user_id IN (SELECT l.l_partkey FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
                  JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE n.n_name IN ({_in(GENRE_SELECTION)}))""",
    "graph_counts": f"""WITH {ITEMS}, kept AS (SELECT * FROM fact WHERE id IN ({_MEASURED}) AND id IN ({_IN_MODE}))
""" + "\nUNION ALL ".join(f"SELECT '{name}' AS \"table\", count(*) AS n_rows FROM ({sql})" for name, sql in _GRAPH_COUNTS.items()),
    "top3_rated_collated": f"""WITH {ITEMS}{_RESPELLED},
mode_pairs AS ({PAIRS["game_mode"]}),
facts AS (SELECT * FROM respelled WHERE id IN (SELECT id FROM mode_pairs WHERE label IN ({_in(MODE_SELECTION)}))),
per_name AS (SELECT lower(name) AS same, min(name) AS name, {_exact_avg("weighted_rating")} AS avg_weighted_rating,
                    CAST(sum(num_of_reviews) AS BIGINT) AS sum_reviews
             FROM facts GROUP BY lower(name)),
ranked AS (SELECT *, rank() OVER (ORDER BY avg_weighted_rating DESC) AS rk FROM per_name WHERE avg_weighted_rating IS NOT NULL),
modes AS (SELECT lower(f.name) AS same, min(mp.label) AS min_mode FROM mode_pairs mp JOIN facts f ON mp.id = f.id
          WHERE mp.label IN ({_in(MODE_SELECTION)}) GROUP BY lower(f.name))
SELECT b.name, b.avg_weighted_rating, b.sum_reviews, m.min_mode FROM ranked b LEFT JOIN modes m ON b.same = m.same WHERE rk <= 3""",
    "popularity_rank_collated": f"""WITH {ITEMS}{_RESPELLED},
per AS (
  SELECT min(f.name) AS name, sum(CAST(CAST(e.value * 1e-4 AS VARCHAR) AS DECIMAL(38, 18))) AS score
  FROM events e JOIN respelled f ON e.user_id = f.id
  WHERE upper(e.event_type) IN ({_in(POPULARITY_TYPE)}) AND f.status IN ({_in(STATUS_SELECTION)})
  GROUP BY lower(f.name)),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY score DESC) AS popularity_rank FROM per WHERE score IS NOT NULL)
SELECT name, CAST(score AS DOUBLE) AS popularity_score, popularity_rank, 1 AS is_top_n FROM ranked
WHERE popularity_rank <= 10""",
    "wishlist_top5_collated": f"""WITH {ITEMS}{_RESPELLED},
per AS (SELECT min(name) AS name, CAST(sum(wishlist_count) AS BIGINT) AS wishlist_count FROM respelled
        WHERE date_first_release IS NULL GROUP BY lower(name)),
ranked AS (SELECT *, rank() OVER (ORDER BY wishlist_count DESC) AS rk FROM per WHERE wishlist_count IS NOT NULL)
SELECT name, wishlist_count FROM ranked WHERE rk <= 5""",
    "scatter_points_collated": f"""WITH {ITEMS}{_RESPELLED}
SELECT num_of_reviews, average_rating, min(lower(name)) AS name FROM respelled
WHERE average_rating IS NOT NULL GROUP BY num_of_reviews, average_rating""",
    "weighted_rating": f"WITH {ITEMS} SELECT * FROM fact",
    "clean_items": f"WITH {ITEMS} SELECT * FROM clean_items",
    "medallion_run": f"WITH {_items('CAST(total_rating AS DECIMAL(5, 2))')} SELECT {DISPLAY_FACT} FROM fact",
    "status_lookup": f"WITH {ITEMS} SELECT status, count(id) AS n_items FROM fact GROUP BY status",
    "epoch_to_date": f"""SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) - 1705000000 AS epoch_s,
       {_date_from_epoch("CAST(floor(epoch(ts)) AS BIGINT) - 1705000000")} AS d
FROM events""",
    "bridge_flatten": f"WITH {ITEMS} SELECT id AS fk_game, unnest(franchises) AS fk_franchise FROM raw_items",
    "embedding_flatten": "SELECT vec_id, unnest(embedding) AS component FROM embeddings",
    "popularity_fact": f"""SELECT CAST(event_id AS BIGINT) AS id, CAST(user_id AS BIGINT) AS fk_game,
       event_type AS fk_popularity_type, CAST(value AS DOUBLE) AS popularity_score,
       {_date_from_epoch("CAST(floor(epoch(ts)) AS BIGINT)")} AS date_measured_at
FROM events""",
    "fct_daily_popularity": f"""SELECT CAST(event_id AS BIGINT) AS "Popularity ID", CAST(user_id AS BIGINT) AS "Game ID",
       event_type AS "Popularity type ID", CAST(value AS DOUBLE) AS "Popularity score",
       {_date_from_epoch("CAST(floor(epoch(ts)) AS BIGINT)")} AS "Date popularity measured at"
FROM events""",
    "dim_platform": f"""WITH first_ship AS (SELECT l_suppkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_suppkey)
SELECT CAST(s.s_suppkey AS BIGINT) AS "Platform ID", s.s_name AS "Platform name",
       {_date_from_epoch("CAST(floor(epoch(f.first_ship)) AS BIGINT)")} AS "Date platform created"
FROM supplier s LEFT JOIN first_ship f ON s.s_suppkey = f.l_suppkey""",
    "union_pages": """SELECT p_partkey, p_name, p_brand FROM part WHERE p_size <= 10
UNION ALL BY NAME
SELECT p_partkey, p_name, p_type FROM part WHERE p_size > 10 AND p_size <= 30
UNION ALL BY NAME
SELECT p_partkey, p_retailprice FROM part WHERE p_size > 30""",
    "schema_align": """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CAST(c_acctbal AS DECIMAL(12, 2)) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_phone
FROM customer""",
    "bad_rows": """SELECT doc_id, lang, nullif(concat_ws('; ',
       CASE WHEN length(text) > 255 THEN 'text: longer than 255' END,
       CASE WHEN n_chars < 400 THEN 'size: not bigint' END,
       CASE WHEN n_chars % 2 = 1 THEN 'half: not bigint' END,
       CASE WHEN lang = 'de' THEN 'codes: not array<bigint>' END), '') AS bad_reason
FROM documents""",
    "snapshot_reload": """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
       o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority
FROM orders""",
    "top3_rated": f"""WITH {ITEMS},
mode_pairs AS ({PAIRS["game_mode"]}),
facts AS (SELECT * FROM fact WHERE id IN (SELECT id FROM mode_pairs WHERE label IN ({_in(MODE_SELECTION)}))),
per_name AS (SELECT name, {_exact_avg("weighted_rating")} AS avg_weighted_rating,
                    CAST(sum(num_of_reviews) AS BIGINT) AS sum_reviews
             FROM facts GROUP BY name),
ranked AS (SELECT *, rank() OVER (ORDER BY avg_weighted_rating DESC) AS rk
           FROM per_name WHERE avg_weighted_rating IS NOT NULL),
best AS (SELECT name, avg_weighted_rating, sum_reviews FROM ranked WHERE rk <= 3),
modes AS (SELECT f.name, min(mp.label) AS min_mode FROM mode_pairs mp JOIN facts f ON mp.id = f.id
          WHERE mp.label IN ({_in(MODE_SELECTION)}) GROUP BY f.name)
SELECT b.name, b.avg_weighted_rating, b.sum_reviews, m.min_mode FROM best b LEFT JOIN modes m ON b.name = m.name""",
    "top3_rated_ties": f"""WITH {ITEMS},
mode_pairs AS ({PAIRS["game_mode"]}),
facts AS (SELECT * FROM fact WHERE id IN (SELECT id FROM mode_pairs WHERE label IN ({_in(MODE_SELECTION)}))),
per_name AS (SELECT name, round({_exact_avg("weighted_rating")}, 0) AS avg_weighted_rating,
                    CAST(sum(num_of_reviews) AS BIGINT) AS sum_reviews
             FROM facts GROUP BY name),
ranked AS (SELECT *, rank() OVER (ORDER BY avg_weighted_rating DESC) AS rk
           FROM per_name WHERE avg_weighted_rating IS NOT NULL),
best AS (SELECT name, avg_weighted_rating, sum_reviews FROM ranked WHERE rk <= 3),
modes AS (SELECT f.name, min(mp.label) AS min_mode FROM mode_pairs mp JOIN facts f ON mp.id = f.id
          WHERE mp.label IN ({_in(MODE_SELECTION)}) GROUP BY f.name)
SELECT b.name, b.avg_weighted_rating, b.sum_reviews, m.min_mode FROM best b LEFT JOIN modes m ON b.name = m.name""",
    "popularity_rank": f"""WITH {ITEMS},
per AS (
  SELECT f.name, sum(CAST(CAST(e.value * 1e-4 AS VARCHAR) AS DECIMAL(38, 18))) AS score
  FROM events e JOIN fact f ON e.user_id = f.id
  WHERE upper(e.event_type) IN ({_in(POPULARITY_TYPE)}) AND f.status IN ({_in(STATUS_SELECTION)})
  GROUP BY f.name),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY score DESC) AS popularity_rank FROM per WHERE score IS NOT NULL)
SELECT name, CAST(score AS DOUBLE) AS popularity_score, popularity_rank, 1 AS is_top_n FROM ranked
WHERE popularity_rank <= 10""",
    "popularity_flags": f"""WITH {ITEMS},
per AS (
  SELECT f.name, sum(CAST(CAST(e.value * 1e-4 AS VARCHAR) AS DECIMAL(38, 18))) AS score
  FROM events e LEFT JOIN fact f ON e.user_id = f.id
  WHERE upper(e.event_type) IN ({_in(POPULARITY_TYPE)})
  GROUP BY f.name),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY score DESC NULLS LAST) AS r FROM per)
SELECT name, CAST(score AS DOUBLE) AS popularity_score,
       CASE WHEN score IS NOT NULL THEN r END AS popularity_rank,
       CASE WHEN score IS NOT NULL AND r <= {TOP_N} THEN 1 ELSE 0 END AS is_top_n
FROM ranked""",
    "top5_aspect_rating": _top_labels("genre", "rating"),
    "top5_aspect_reviews": _top_labels("genre", "reviews"),
    "top5_platform_rating": _top_labels("platform", "rating"),
    "top5_mode_reviews": _top_labels("game_mode", "reviews"),
    "top5_franchise_reviews": _top_labels("franchise", "reviews"),
    "top5_game_type_rating": _top_labels("game_type", "rating"),
    "most_wishlisted": f"""WITH {ITEMS},
u AS (SELECT * FROM fact WHERE date_first_release IS NULL)
SELECT min(name) AS name, max(wishlist_count) AS wishlist_count FROM u
WHERE wishlist_count = (SELECT max(wishlist_count) FROM u)""",
    "wishlist_top5": f"""WITH {ITEMS},
per AS (SELECT name, CAST(sum(wishlist_count) AS BIGINT) AS wishlist_count FROM fact
        WHERE date_first_release IS NULL GROUP BY name),
ranked AS (SELECT *, rank() OVER (ORDER BY wishlist_count DESC) AS rk FROM per WHERE wishlist_count IS NOT NULL)
SELECT name, wishlist_count FROM ranked WHERE rk <= 5""",
    "scatter_points": f"""WITH {ITEMS}
SELECT num_of_reviews, average_rating, min(name) AS name FROM fact
WHERE average_rating IS NOT NULL GROUP BY num_of_reviews, average_rating""",
    "item_count": f"WITH {ITEMS} SELECT count(id) AS n_items FROM fact WHERE status IN ({_in(STATUS_SELECTION)})",
    "filter_propagation": f"""WITH {ITEMS}
SELECT id, name, status FROM fact
WHERE status IN ({_in(STATUS_SELECTION)})
  AND id IN (SELECT l.l_partkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             WHERE o.o_orderpriority IN ({_in(MODE_SELECTION)}))
  AND id IN (SELECT l.l_partkey FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
             JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE n.n_name IN ({_in(GENRE_SELECTION)}))""",
    "types_with_status": f"""WITH {ITEMS}
SELECT DISTINCT CASE WHEN event_type <> 'error' THEN upper(event_type) END AS popularity_type FROM events
WHERE user_id IN (SELECT id FROM fact WHERE status IS NOT NULL)""",
    "label_lists": f"""WITH {ITEMS}
SELECT DISTINCT o.o_orderpriority AS label FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_partkey IN (SELECT id FROM fact WHERE status IN ('EUROPE'))""",
    "calendar_dim": f"""WITH {CALENDAR},
per_day AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
outside AS (SELECT sum(n) AS n FROM per_day WHERE d IS NULL OR d NOT IN (SELECT "Date" FROM cal))
SELECT cal.*, coalesce(p.n, 0) AS n_orders FROM cal LEFT JOIN per_day p ON p.d = cal."Date"
UNION ALL
SELECT {", ".join(["NULL"] * 26)}, CAST(n AS BIGINT) FROM outside WHERE n > 0""",
    "drill_by_date": f"""WITH {ITEMS}, {CALENDAR},
j AS (SELECT f.*, cal."Year", cal."QuarterName", cal."MonthName", cal."MonthShort",
             cal."Date"
      FROM fact f LEFT JOIN cal ON f.date_first_release = cal."Date")
SELECT "Year", "QuarterName", "MonthName", "MonthShort", "Date", count(id) AS n_items,
       CAST(sum(num_of_reviews) AS BIGINT) AS sum_reviews, CAST(sum(wishlist_count) AS BIGINT) AS sum_wishlist,
       CAST(5 - (GROUPING("Year") + GROUPING("QuarterName") + GROUPING("MonthName") + GROUPING("MonthShort")
                 + GROUPING("Date")) AS INTEGER) AS drill_level
FROM j GROUP BY ROLLUP ("Year", "QuarterName", "MonthName", "MonthShort", "Date")""",
    "default_summary": """SELECT l_returnflag, l_linestatus, count(l_orderkey) AS count_l_orderkey,
       sum(l_quantity) AS sum_l_quantity, round(sum(l_extendedprice), 2) AS sum_l_extendedprice,
       round(avg(l_discount), 6) AS avg_l_discount
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "fact_summary": f"""WITH {ITEMS}
SELECT status, CAST(sum(num_of_reviews) AS BIGINT) AS sum_num_of_reviews,
       CAST(sum(wishlist_count) AS BIGINT) AS sum_wishlist_count,
       round(sum(weighted_rating), 2) + 0.0 AS sum_weighted_rating
FROM fact GROUP BY status""",
    "popularity_summary": """SELECT event_type AS fk_popularity_type, count(event_id) AS count_id,
       CAST(sum(CAST(CAST(value * 1e-4 AS VARCHAR) AS DECIMAL(38, 18))) AS DOUBLE) AS sum_popularity_score
FROM events GROUP BY event_type""",
    "dq_unique": """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_not_null": f"WITH {ITEMS} SELECT id, name FROM clean_items WHERE average_rating IS NULL",
    "dq_range": "SELECT event_id, value FROM events WHERE value IS NOT NULL AND NOT (value >= 0 AND value <= 400)",
    "dq_values": """SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')""",
    "dq_suite": _dq_suite(),
    "dq_all_models": _dq_all_models(),
    **{name: _gold_model(name) for name in (
        "dim_franchise", "dim_gamemode", "dim_gametype", "dim_genre", "dim_poptype", "dim_bridge_franchise",
        "dim_bridge_gamemode", "dim_bridge_genre", "dim_bridge_platform")},
    "top5_genre_rating_status": _top_labels("genre", "rating", f"f.status IN ({_in(STATUS_SELECTION)})"),
    "top5_mode_reviews_status": _top_labels("game_mode", "reviews", f"f.status IN ({_in(STATUS_SELECTION)})"),
    "status_list": f"WITH {ITEMS} SELECT DISTINCT status FROM fact",
    "genre_list": f"""WITH {ITEMS}, pairs AS ({PAIRS["genre"]})
SELECT DISTINCT label FROM pairs WHERE id IN (SELECT id FROM fact WHERE status IN ({_in(STATUS_SELECTION)}))""",
    "wishlist_order": f"""WITH {ITEMS},
per AS (SELECT name, CAST(sum(wishlist_count) AS BIGINT) AS wishlist_count FROM fact
        WHERE date_first_release IS NULL GROUP BY name),
ranked AS (SELECT *, rank() OVER (ORDER BY wishlist_count DESC) AS rk FROM per WHERE wishlist_count IS NOT NULL)
SELECT name, wishlist_count, row_number() OVER (ORDER BY wishlist_count DESC, name) AS position FROM ranked WHERE rk <= 25""",
}
ORACLES |= {
    "top3_rated_order": f"SELECT *, row_number() OVER (ORDER BY avg_weighted_rating DESC, name) AS position FROM ({ORACLES['top3_rated_ties']})",
    "popularity_rank_order": f"SELECT *, row_number() OVER (ORDER BY popularity_rank, name) AS position FROM ({ORACLES['popularity_rank']})",
    "popularity_by_weekday": """SELECT CAST(ts AS DATE) AS date_measured_at, event_type AS fk_popularity_type, count(event_id) AS n_measured,
       CAST(sum(CAST(CAST(CAST(value AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 18))) AS DOUBLE) AS sum_score
FROM events WHERE isodow(ts) >= 6 AND CAST(ts AS DATE) BETWEEN DATE '1990-01-01' AND DATE '2030-12-31' GROUP BY ALL""",
}
