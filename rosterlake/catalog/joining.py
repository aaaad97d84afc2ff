"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rosterlake.catalog.base import Tables, query, with_fx
from rosterlake.operators.aggregate import pending_values
from rosterlake.operators.dictionary import dict_diff, dict_grow
from rosterlake.operators.joins import (
    absent_rows, dim_join, interval_join, interval_max, lookup_chain, lookup_default, member_rows,
)
from rosterlake.operators.reshape import union_sheets
from rosterlake.operators.skew import hot_keys, repeated, skew_join
from rosterlake.plans.tariffs import date_bounds
from rosterlake.plans.vacancies import WEB_SEARCHES, api_frontier, web_frontier
from rosterlake.session import settle


@query(
    "dim_join",
    with_fx(
        "SELECT w.id, w.date_, k.tk_name, k.region_id FROM fx_work w JOIN fx_tks k ON w.tk_id = k.tk_id "
        "WHERE k.region_id IS NOT NULL", "fx_work", "fx_tks",
    ),
)
def with_store(t: Tables) -> DataFrame:
    stores = t.fx_tks().filter("region_id is not null").withColumnRenamed("tk_id", "store")
    return dim_join(t.fx_work(), stores, {"tk_id": "store"}).select("id", "date_", "tk_name", "region_id")


@query(
    "salted_join",
    """SELECT event_id, k, c_name, c_mktsegment FROM (SELECT event_id,
    CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 2000 END AS k FROM events) e
    LEFT JOIN customer ON c_custkey = k""",
)
def hot_key_join(t: Tables) -> DataFrame:
    # a third of all rows carries key 0
    rows = t.events.selectExpr("event_id", "CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 2000 END AS k")
    dim = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return dim_join(rows, dim, {"k": "c_custkey"}, "left", salts=8)


@query(
    "hot_keys",
    """WITH e AS (SELECT CASE WHEN event_id % 2 = 0 THEN 0 WHEN event_id % 9 = 1 THEN NULL ELSE user_id END AS k FROM events),
    n AS (SELECT k, COUNT(*) AS rows_found FROM e GROUP BY k), t AS (SELECT COUNT(*) AS total FROM e)
    SELECT k, rows_found, CAST((rows_found * 50 + total - 1) // total AS INT) AS salts FROM n, t WHERE rows_found * 50 >= total""",
)
def keys_with_many_rows(t: Tables) -> DataFrame:
    return hot_keys(_half_on_one_key(t), ["k"])


@query(
    "skew_join",
    """SELECT event_id, value, k, c_name, c_mktsegment FROM (SELECT event_id, value, CASE WHEN event_id % 2 = 0 THEN 0
    WHEN event_id % 9 = 1 THEN NULL ELSE user_id END AS k FROM events) e LEFT JOIN customer ON c_custkey - 1 = k""",
)
def half_on_one_key_join(t: Tables) -> DataFrame:
    dim = t.customer.selectExpr("c_custkey - 1 AS c", "c_name", "c_mktsegment")
    return skew_join(_half_on_one_key(t), dim, {"k": "c"}, "left")


@query(
    "skew_repeats",
    """WITH e AS (SELECT CASE WHEN event_id % 2 = 0 THEN 0 WHEN event_id % 9 = 1 THEN NULL ELSE user_id END AS k FROM events),
    h AS (SELECT k, (COUNT(*) * 50 + (SELECT COUNT(*) FROM e) - 1) // (SELECT COUNT(*) FROM e) AS salts FROM e GROUP BY k
    HAVING COUNT(*) * 50 >= (SELECT COUNT(*) FROM e))
    SELECT c_custkey - 1 AS c, CAST(COALESCE(salts, 1) AS BIGINT) AS repeats FROM customer LEFT JOIN h ON k = c_custkey - 1""",
)
def repeats_of_dimension_rows(t: Tables) -> DataFrame:
    hot = settle(hot_keys(_half_on_one_key(t), ["k"]), "hot_keys")
    rows = repeated(t.customer.selectExpr("c_custkey - 1 AS c"), hot, {"k": "c"})
    return rows.groupBy("c").agg(F.count("*").alias("repeats"))


def _half_on_one_key(t: Tables) -> DataFrame:
    key = "CASE WHEN event_id % 2 = 0 THEN 0 WHEN event_id % 9 = 1 THEN NULL ELSE user_id END AS k"
    return t.events.selectExpr("event_id", "value", key)


@query(
    "lookup_chain",
    """SELECT c_custkey, n_name, r_name, s_name FROM (SELECT c_custkey, c_custkey % 30 AS n FROM customer)
    LEFT JOIN nation ON n_nationkey = n LEFT JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN supplier ON s_suppkey = c_custkey % 150""",
)
def looked_up(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr("c_custkey", "c_custkey % 30 AS n", "c_custkey % 150 AS s")
    chain = [
        (t.nation, {"n": "n_nationkey"}),
        (t.region, {"n_regionkey": "r_regionkey"}),
        (t.supplier.select("s_suppkey", "s_name"), {"s": "s_suppkey"}),
    ]
    return lookup_chain(rows, chain).select("c_custkey", "n_name", "r_name", "s_name")


@query(
    "composite_join",
    """SELECT e.event_id, t.n AS same_day_type FROM events e LEFT JOIN (SELECT event_type, CAST(ts AS DATE) AS day,
    COUNT(*) AS n FROM events WHERE event_id % 5 = 0 GROUP BY ALL) t
    ON e.event_type = t.event_type AND CAST(e.ts AS DATE) = t.day""",
)
def two_keys(t: Tables) -> DataFrame:
    rows = t.events.selectExpr("event_id", "event_type", "CAST(ts AS DATE) AS day")
    counts = rows.filter("event_id % 5 = 0").groupBy("event_type", "day").agg(F.count("*").alias("same_day_type"))
    joined = dim_join(rows, counts, {"event_type": "event_type", "day": "day"}, "left")
    return joined.select("event_id", "same_day_type")


_INTERVAL_SQL = with_fx(
    "SELECT d.date_, t.region_id, COUNT(*) AS tariffs, MIN(t.id) AS first_id, MAX(t.id) AS last_id "
    "FROM (SELECT DISTINCT date_, courier_id % 5 AS region_id FROM fx_work) d JOIN fx_tariffs t "
    "ON t.region_id = d.region_id AND d.date_ >= t.date_start AND (t.date_stop IS NULL OR d.date_ <= t.date_stop) "
    "GROUP BY ALL", "fx_work", "fx_tariffs",
)


def _in_force(t: Tables, bin_days: int) -> DataFrame:
    work = t.fx_work()
    days = settle(work.selectExpr("date_", "CAST(courier_id % 5 AS INT) AS region_id").distinct(), "days")
    joined = interval_join(
        days, t.fx_tariffs(), "date_", "date_start", "date_stop", date_bounds(days, "date_")[1],
        ["region_id"], bin_days,
    )
    return joined.groupBy("date_", "region_id").agg(
        F.count("*").alias("tariffs"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query("interval_join", _INTERVAL_SQL)
def binned_intervals(t: Tables) -> DataFrame:
    return _in_force(t, 30)


@query("interval_join_daily", _INTERVAL_SQL)
def daily_intervals(t: Tables) -> DataFrame:
    return _in_force(t, 1)


@query(
    "interval_max",
    with_fx(
        "SELECT d.date_, t.region_id, MAX(t.id) AS last_id FROM (SELECT DISTINCT date_ FROM fx_work) d "
        "JOIN fx_tariffs t ON d.date_ >= t.date_start AND (t.date_stop IS NULL OR d.date_ <= t.date_stop) "
        "GROUP BY ALL", "fx_work", "fx_tariffs",
    ),
)
def latest_in_force(t: Tables) -> DataFrame:
    days = settle(t.fx_work().select("date_").distinct(), "days")
    horizon = date_bounds(days, "date_")[1]
    return interval_max(
        days, t.fx_tariffs(), "date_", "date_start", "date_stop", horizon, ["region_id"], "id", "last_id"
    )


@query(
    "state_filter_join",
    "SELECT c_custkey, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1",
)
def in_state(t: Tables) -> DataFrame:
    states = t.nation.filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return member_rows(t.customer, states, ["c_nationkey"]).select("c_custkey", "c_name")


@query(
    "pending_semi",
    with_fx("SELECT id, date_ FROM fx_work WHERE date_ IN (SELECT date_ FROM days)", "fx_work", "days"),
)
def pending_rows(t: Tables) -> DataFrame:
    work = t.fx_work()
    pending = settle(pending_values(work, "full_payment_client", "date_"), "pending-days")
    return member_rows(work, pending, ["date_"]).select("id", "date_")


_BATCH = ["o_orderkey", "o_orderstatus", "CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS priority"]


@query(
    "absent_rows",
    f"""SELECT * FROM (SELECT {', '.join(_BATCH)} FROM orders) b WHERE NOT EXISTS (SELECT 1 FROM
    (SELECT {', '.join(_BATCH)} FROM orders WHERE o_orderkey % 2 = 0) t WHERE t.o_orderkey = b.o_orderkey
    AND t.o_orderstatus = b.o_orderstatus AND t.priority = b.priority)""",
)
def not_stored(t: Tables) -> DataFrame:
    batch = t.orders.selectExpr(*_BATCH)
    return absent_rows(batch, batch.filter("o_orderkey % 2 = 0"), batch.columns)


@query(
    "null_safe_join",
    with_fx(
        "SELECT c.c_custkey, k.tk_name FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 7 END "
        "AS r FROM customer) c JOIN fx_tks k ON c.r IS NOT DISTINCT FROM k.region_id", "fx_tks",
    ),
)
def null_matches(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr("c_custkey", "CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 7 AS INT) END AS r")
    return dim_join(rows, t.fx_tks(), {"r": "region_id"}, null_safe=True).select("c_custkey", "tk_name")


@query(
    "frontier",
    """SELECT CAST(s_suppkey AS INT) AS area, s AS specialization,
    CASE WHEN s = '21.482' THEN 'name' ELSE '' END AS search_field,
    CASE WHEN s = '21.482' THEN 'экспедитор' ELSE '' END AS text
    FROM supplier CROSS JOIN (VALUES ('4.127'), ('21.482'), ('21.506')) v(s)""",
)
def api_requests(t: Tables) -> DataFrame:
    return api_frontier(t.supplier.select(F.col("s_suppkey").cast("int").alias("area")))


_SEARCH_ROWS = ", ".join(f"('{s['tag']}', '{s['query']}')" for s in WEB_SEARCHES)


@query(
    "web_frontier",
    f"""SELECT CAST(s_suppkey AS INT) AS region_id, 'https://site.example/' || s_name || '/vakansii' || tag AS link,
    query FROM supplier CROSS JOIN (VALUES {_SEARCH_ROWS}) v(tag, query)""",
)
def web_requests(t: Tables) -> DataFrame:
    regions = t.supplier.select(F.col("s_suppkey").cast("int").alias("region_id"), F.col("s_name").alias("region_name"))
    return web_frontier(regions, "https://site.example/")


@query(
    "lookup_default",
    """SELECT c_custkey, COALESCE(s_suppkey, 0) AS created_by, s_suppkey IS NULL AS unknown FROM customer
    LEFT JOIN supplier ON s_name = 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')""",
)
def authors(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.format_string("Supplier#%09d", "c_custkey").alias("author"))
    users = t.supplier.select("s_name", F.col("s_suppkey").alias("created_by"))
    return lookup_default(rows, users, {"author": "s_name"}, "created_by", 0, "unknown").drop("author")


# Set operations ------------------------------------------------------------------------------


@query(
    "union_sheets",
    """SELECT o_orderkey, o_orderstatus, NULL AS o_custkey FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, NULL, o_custkey FROM orders WHERE o_orderkey % 2 = 1""",
)
def stacked(t: Tables) -> DataFrame:
    first = t.orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus")
    second = t.orders.filter("o_orderkey % 2 = 1").select("o_custkey", "o_orderkey")
    return union_sheets(first, second)


def _names(t: Tables) -> tuple[DataFrame, DataFrame]:
    named = t.part.filter("p_partkey % 17 <> 0 and p_partkey % 3 = 0")
    known = named.groupBy(F.concat_ws(" ", "p_name", "p_brand").alias("name")).agg(
        F.min("p_partkey").alias("name_id")
    ).select("name_id", "name")
    report = t.part.selectExpr(
        "p_partkey", "CASE WHEN p_partkey % 17 <> 0 THEN concat_ws(' ', p_name, p_brand) END AS title"
    )
    return known, report


_NAMES_SQL = {
    "known": "SELECT MIN(p_partkey) AS name_id, p_name || ' ' || p_brand AS name FROM part "
             "WHERE p_partkey % 17 <> 0 AND p_partkey % 3 = 0 GROUP BY 2",
    "found": "SELECT DISTINCT CASE WHEN p_partkey % 17 <> 0 THEN p_name || ' ' || p_brand END AS name FROM part",
    "fresh": "SELECT name FROM found EXCEPT SELECT name FROM known",
}


@query("dict_diff", with_fx("SELECT name FROM fresh", **_NAMES_SQL))
def new_names(t: Tables) -> DataFrame:
    known, report = _names(t)
    return dict_diff(report, known, {"title": "name"})


@query(
    "dict_grow",
    with_fx(
        "SELECT name_id, name FROM known UNION ALL SELECT (SELECT MAX(name_id) FROM known) + "
        "row_number() OVER (ORDER BY name NULLS FIRST), name FROM fresh", **_NAMES_SQL,
    ),
)
def grown_names(t: Tables) -> DataFrame:
    known, report = _names(t)
    return dict_grow(known, "name_id", report, {"title": "name"})


@query(
    "date_overlap",
    "SELECT CAST(o_orderdate AS DATE) AS day FROM orders INTERSECT SELECT CAST(l_shipdate AS DATE) FROM lineitem",
)
def shared_days(t: Tables) -> DataFrame:
    return t.orders.select(F.to_date("o_orderdate").alias("day")).intersect(
        t.lineitem.select(F.to_date("l_shipdate").alias("day"))
    )


@query(
    "hconcat",
    "SELECT c_custkey, c_name, c_name || '/' || c_mktsegment AS both_names, c_nationkey + 1 AS next_nation FROM customer",
)
def side_by_side(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", "c_name", F.concat_ws("/", "c_name", "c_mktsegment").alias("both_names"),
        (F.col("c_nationkey") + 1).alias("next_nation"),
    )
