"""Aggregation, quality counts, sort and reshape."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from rosterlake.catalog.base import Tables, query, with_fx
from rosterlake.operators.aggregate import distinct_values, group_max, keep_last, last_date, pending_values, top_rows
from rosterlake.operators.quality import (
    duplicate_keys, empty_load_warning, null_columns, quality_counts,
)
from rosterlake.operators.reshape import pivot_fields, unpivot_columns, weekly_template
from rosterlake.functions import coerce_numeric

FIELDS = (1, 2, 58, 59, 60, 82)


@query("group_max", "SELECT o_custkey, o_orderstatus, MAX(o_orderkey) AS last_order FROM orders GROUP BY 1, 2")
def largest(t: Tables) -> DataFrame:
    return group_max(t.orders, ["o_custkey", "o_orderstatus"], "o_orderkey", "last_order")


@query("distinct_dates", with_fx("SELECT date_ FROM days", "fx_work", "days"))
def pending_dates(t: Tables) -> DataFrame:
    return pending_values(t.fx_work(), "full_payment_client", "date_")


_REPEATED = ["event_type", "CASE WHEN user_id % 5 <> 0 THEN user_id END AS user_id", "event_id % 3 AS rest"]


@query("distinct_rows", f"SELECT DISTINCT {', '.join(_REPEATED)} FROM events")
def distinct_events(t: Tables) -> DataFrame:
    return t.events.selectExpr(*_REPEATED).dropDuplicates()


@query(
    "keep_last",
    with_fx(
        "SELECT courier_id, day_of_week_number, row_no, couriers_intervals_last_update FROM (SELECT *, row_number() "
        "OVER (PARTITION BY courier_id, day_of_week_number ORDER BY row_no DESC) AS rn FROM fx_template) WHERE rn = 1",
        "fx_template",
    ),
)
def last_rows(t: Tables) -> DataFrame:
    return keep_last(t.fx_template(), ["courier_id", "day_of_week_number"], ["row_no"])


@query("distinct_filtered", "SELECT DISTINCT user_id FROM events WHERE event_id % 37 = 0")
def some_users(t: Tables) -> DataFrame:
    return distinct_values(t.events, ["user_id"], F.col("event_id") % 37 == 0)


@query(
    "quality_counts",
    with_fx(
        """SELECT 'no_result' AS check_name, COUNT(*) FILTER (full_payment_client IS NULL) AS bad_rows FROM fx_work
        UNION ALL SELECT 'no_transport', COUNT(*) FILTER (transport_id = 0) FROM fx_work
        UNION ALL SELECT 'no_hours', COUNT(*) FILTER (active_time_hours = 0) FROM fx_work""", "fx_work",
    ),
)
def bad_rows(t: Tables) -> DataFrame:
    checks = {
        "no_result": F.col("full_payment_client").isNull(), "no_transport": F.col("transport_id") == 0,
        "no_hours": F.col("active_time_hours") == 0,
    }
    return quality_counts(t.fx_work(), checks)


@query(
    "null_columns",
    """SELECT * FROM (SELECT 'status' AS column_name, COUNT(*) FILTER (o_orderkey % 3 = 0) AS null_rows FROM orders
    UNION ALL SELECT 'price', COUNT(*) FILTER (o_orderkey % 4 = 0) FROM orders) WHERE null_rows > 0""",
)
def gaps(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price",
        "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status",
        "CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END AS notes",
    )
    return null_columns(rows, allowed=["notes"])


@query(
    "empty_load_warning",
    """SELECT 'warning' AS event_type, 'orders' AS event_source, 'inserted 0 records' AS description
    WHERE (SELECT COUNT(*) FROM orders WHERE o_totalprice < 0) = 0""",
)
def nothing_loaded(t: Tables) -> DataFrame:
    loaded = t.orders.filter("o_totalprice >= 0")
    refunds = t.orders.filter("o_totalprice < 0")
    text = "inserted 0 records"
    return empty_load_warning(loaded, "orders", text).unionByName(empty_load_warning(refunds, "orders", text))


@query(
    "last_date",
    """SELECT 'all' AS load, CAST(MAX(o_orderdate) AS DATE) AS day FROM orders
    UNION ALL SELECT 'none', COALESCE((SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders WHERE o_totalprice < 0),
    DATE '2022-05-11')""",
)
def last_loaded(t: Tables) -> DataFrame:
    rows = t.orders.select("o_totalprice", F.to_date("o_orderdate").alias("day"))
    default = F.lit(date(2022, 5, 11))
    full = last_date(rows, "day", default, "day").select(F.lit("all").alias("load"), "day")
    none = last_date(rows.filter("o_totalprice < 0"), "day", default, "day")
    return full.unionByName(none.select(F.lit("none").alias("load"), "day"))


@query("top1_date", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1")
def newest(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return top_rows(rows, [F.col("o_orderdate").desc(), F.col("o_orderkey")])


@query(
    "delivery_order",
    """SELECT k, file_date, event_id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY file_date DESC,
    event_id DESC) AS rn FROM (SELECT event_id % 500 AS k, CAST(ts AS DATE) AS file_date, event_id FROM events))
    WHERE rn = 1""",
)
def latest_delivery(t: Tables) -> DataFrame:
    rows = t.events.selectExpr("event_id % 500 AS k", "CAST(ts AS DATE) AS file_date", "event_id")
    return keep_last(rows, ["k"], ["file_date", "event_id"])


def _field_columns(value: str) -> str:
    return ", ".join(f"MAX(CASE WHEN field_id = {f} THEN {value} END) AS {value}_{f}" for f in FIELDS)


@query(
    "pivot_prices",
    with_fx(
        f"SELECT tariff_id, {_field_columns('cost')}, {_field_columns('amount')} FROM fx_gaps "
        "GROUP BY tariff_id", "fx_prices",
        fx_gaps="""SELECT tariff_id, CASE WHEN (tariff_id + field_id) % 10 = 0 THEN 100 + field_id ELSE field_id END
        AS field_id, cost, amount FROM fx_prices""",
    ),
)
def spread_prices(t: Tables) -> DataFrame:
    # a tenth of the prices is of other fields, which leaves gaps
    moved = F.expr("CASE WHEN (tariff_id + field_id) % 10 = 0 THEN 100 + field_id ELSE field_id END")
    listed = t.fx_prices(FIELDS).withColumn("field_id", moved)
    return pivot_fields(listed, ["tariff_id"], "field_id", FIELDS, ["cost", "amount"])


@query(
    "pivot_duplicates",
    with_fx(
        "SELECT tariff_id, field_id, COUNT(*) AS rows_found FROM (SELECT * FROM fx_prices WHERE field_id NOT IN "
        "(86, 92) UNION ALL SELECT * FROM fx_prices WHERE tariff_id % 50 = 0 AND field_id = 1) GROUP BY 1, 2 "
        "HAVING COUNT(*) > 1", "fx_prices",
    ),
)
def repeated_prices(t: Tables) -> DataFrame:
    listed = t.fx_prices(FIELDS)
    again = listed.filter("tariff_id % 50 = 0 and field_id = 1")
    return duplicate_keys(listed.unionByName(again), ["tariff_id", "field_id"])


WEEK = tuple(f"2024-01-0{d}" for d in range(1, 8))


def wide_hours(t: Tables) -> DataFrame:
    """One row per user with a column of event counts per weekday, named by the days of one week."""
    day = F.date_add(F.lit(WEEK[0]).cast("date"), F.weekday("ts"))
    counts = [F.count_if(day == F.lit(d).cast("date")).alias(d) for d in WEEK]
    return t.events.groupBy("user_id").agg(*counts)


_WEEK_SQL = (
    "SELECT u.user_id, CAST(d.day AS DATE) AS report_date, COUNT(e.event_id) AS worked_hours "
    "FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (VALUES "
    + ", ".join(f"('{d}')" for d in WEEK)
    + ") d(day) LEFT JOIN events e ON e.user_id = u.user_id "
    f"AND DATE '{WEEK[0]}' + CAST(isodow(e.ts) - 1 AS INT) = CAST(d.day AS DATE) GROUP BY 1, 2"
)


@query("unpivot_nonzero", f"SELECT * FROM ({_WEEK_SQL}) WHERE worked_hours <> 0")
def long_hours(t: Tables) -> DataFrame:
    rows = unpivot_columns(wide_hours(t), ["user_id"], WEEK, "report_date", "worked_hours")
    return rows.filter("worked_hours <> 0").withColumn("report_date", F.col("report_date").cast("date"))


@query(
    "unpivot_keep",
    f"""SELECT user_id, report_date AS requested_date,
    CASE WHEN worked_hours <> 0 THEN CAST(worked_hours AS DOUBLE) END AS doer_count FROM ({_WEEK_SQL})""",
)
def long_requests(t: Tables) -> DataFrame:
    texts = wide_hours(t).withColumns(
        {d: F.when(F.col(f"`{d}`") != 0, F.col(f"`{d}`").cast("string")).otherwise("нет") for d in WEEK}
    )
    rows = unpivot_columns(texts, ["user_id"], WEEK, "requested_date", "doer_count")
    return rows.withColumns(
        {"requested_date": F.col("requested_date").cast("date"), "doer_count": coerce_numeric(F.col("doer_count"))}
    )


@query(
    "weekly_template",
    with_fx(
        "SELECT courier_id, row_no, day_of_week_number, CAST(d AS DATE) AS preferred_date FROM fx_template, "
        "range(DATE '2024-02-04', DATE '2024-02-07', INTERVAL 1 DAY) r(d) WHERE isodow(d) = day_of_week_number",
        "fx_template",
    ),
)
def dated_template(t: Tables) -> DataFrame:
    rows = t.fx_template().select("courier_id", "row_no", "day_of_week_number")
    return weekly_template(rows, "day_of_week_number", F.lit(date(2024, 2, 1)), (3, 5), "preferred_date")
