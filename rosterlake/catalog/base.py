"""Query registry, table access, and the derived inputs in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake.operators.store import Store
from rosterlake.session import run_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def new_store(t: Tables, label: str) -> Store:
    """An empty store in the shared folder."""
    return Store(t.spark, run_folder(t.spark, label))


class Tables:
    """The given tables as attributes, and inputs Spark derives from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def fx_tks(self) -> DataFrame:
        return self.nation.selectExpr(
            "n_nationkey AS tk_id", "n_name AS tk_name",
            "CASE WHEN n_nationkey % 6 <> 5 THEN n_regionkey END AS region_id",
        )

    def fx_work(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_orderkey AS id", "o_custkey AS courier_id", "CAST(o_orderkey % 25 AS INT) AS tk_id",
            "CAST(o_orderdate AS DATE) AS date_", "CAST(o_custkey % 5 AS INT) AS transport_id",
            "CAST(o_orderkey % 14 AS INT) AS active_time_hours",
            "CAST(o_custkey % 20 AS INT) AS orders_delivered",
            "CAST(o_orderkey % 97 AS INT) AS daily_distance",
            "CAST(o_orderkey % 3 AS INT) AS orders_over_twenty_kg",
            "CAST(o_custkey % 2 AS INT) AS orders_over_forty_kg",
            "CASE WHEN o_orderstatus <> 'O' THEN 1 END AS full_payment_client",
        )

    def fx_tariffs(self) -> DataFrame:
        start = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") * 37 % 2300).cast("int"))
        key = F.col("c_custkey")
        return self.customer.select(
            key.alias("id"),
            F.lit(20).alias("project_id"),
            (key % 5).cast("int").alias("region_id"),
            F.expr("CAST(c_custkey div 5 % 4 AS INT)").alias("speciality_id"),
            F.when(key % 7 == 0, 1).when(key % 3 == 0, 4).otherwise(3).alias("state_id"),
            start.alias("date_start"),
            F.when(key % 11 != 0, F.date_add(start, 200)).alias("date_stop"),
            F.date_add(start, (key % 2 * 60).cast("int")).alias("state_date"),
            start.alias("created"),
        )

    def fx_prices(self, fields: tuple[int, ...]) -> DataFrame:
        exploded = self.customer.select(
            F.col("c_custkey").alias("tariff_id"), F.explode(F.array(*map(F.lit, fields))).alias("field_id")
        )
        base, times = "(tariff_id * 7 + field_id) % 200", "CASE WHEN field_id = 58 THEN 12 ELSE 1 END"
        return exploded.selectExpr(
            "tariff_id", "field_id", f"({base}) * {times} AS cost", f"({base} + 50) * {times} AS amount"
        )

    def fx_priced(self, fields: tuple[int, ...]) -> DataFrame:
        """Prices with some tariffs that list none of the fields, and some that list a field twice."""
        prices = self.fx_prices(fields)
        twice = prices.filter("tariff_id % 17 = 0 AND field_id = 1 AND tariff_id % 13 <> 0")
        other = prices.filter("tariff_id % 13 = 0 AND field_id = 1").withColumn("field_id", F.lit(7))
        raised = twice.withColumns({"cost": F.col("cost") + 5, "amount": F.col("amount") - 3})
        return prices.filter("tariff_id % 13 <> 0").unionByName(raised).unionByName(other)

    def fx_shifts(self) -> DataFrame:
        return self.events.selectExpr(
            "event_id AS id", "CAST(user_id % 25 AS INT) AS tk_id", "CAST(ts AS DATE) AS date_",
            "CAST(ts AS DATE) AS file_date",
            "CASE WHEN event_id % 13 <> 0 THEN ts END AS first_activation",
            "CASE WHEN event_id % 10 <> 0 THEN "
            "ts + make_dt_interval(0, CAST(event_id % 12 AS INT), 0, 0) END AS last_deactivation",
            "CAST(event_id % 12 AS INT) AS active_time_hours", "CAST(event_id % 50 AS INT) AS picked_SKU",
            "CASE WHEN event_type <> 'error' THEN 1 END AS full_payment_doer",
        )

    def fx_template(self) -> DataFrame:
        return self.events.selectExpr(
            "user_id AS courier_id", "weekday(ts) + 1 AS day_of_week_number", "event_id AS row_no",
            "CASE WHEN event_id % 9 <> 0 THEN ts END AS couriers_intervals_last_update",
        )

    def fx_updates(self) -> DataFrame:
        o = self.orders
        known = o.filter("o_orderkey % 4 = 0").selectExpr(
            "o_orderkey AS k", "'U' AS status",
            "CAST(FLOOR(o_totalprice) + o_orderkey % 8 AS BIGINT) AS price",
        )
        new = o.filter("o_orderkey % 40 = 0").selectExpr(
            "o_orderkey + 1000000000 AS k", "'N' AS status", "CAST(1 AS BIGINT) AS price"
        )
        return known.unionByName(new)


FX = {
    "fx_tks": """SELECT n_nationkey AS tk_id, n_name AS tk_name,
        CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE n_regionkey END AS region_id FROM nation""",
    "fx_work": """SELECT o_orderkey AS id, o_custkey AS courier_id, o_orderkey % 25 AS tk_id,
        CAST(o_orderdate AS DATE) AS date_, CAST(o_custkey % 5 AS INT) AS transport_id,
        o_orderkey % 14 AS active_time_hours, o_custkey % 20 AS orders_delivered,
        o_orderkey % 97 AS daily_distance, o_orderkey % 3 AS orders_over_twenty_kg,
        o_custkey % 2 AS orders_over_forty_kg,
        CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 1 END AS full_payment_client FROM orders""",
    "fx_tariffs": """SELECT c_custkey AS id, 20 AS project_id, CAST(c_custkey % 5 AS INT) AS region_id,
        CAST((c_custkey // 5) % 4 AS INT) AS speciality_id,
        CASE WHEN c_custkey % 7 = 0 THEN 1 WHEN c_custkey % 3 = 0 THEN 4 ELSE 3 END AS state_id,
        DATE '1995-01-01' + CAST((c_custkey * 37) % 2300 AS INT) AS date_start,
        CASE WHEN c_custkey % 11 = 0 THEN NULL
             ELSE DATE '1995-01-01' + CAST((c_custkey * 37) % 2300 AS INT) + 200 END AS date_stop,
        DATE '1995-01-01' + CAST((c_custkey * 37) % 2300 + 60 * (c_custkey % 2) AS INT) AS state_date,
        DATE '1995-01-01' + CAST((c_custkey * 37) % 2300 AS INT) AS created FROM customer""",
    "fx_prices": """SELECT c_custkey AS tariff_id, f AS field_id,
        ((c_custkey * 7 + f) % 200) * (CASE WHEN f = 58 THEN 12 ELSE 1 END) AS cost,
        ((c_custkey * 7 + f) % 200 + 50) * (CASE WHEN f = 58 THEN 12 ELSE 1 END) AS amount
        FROM customer, (VALUES (1), (2), (58), (59), (60), (82), (86), (92)) v(f)""",
    "fx_priced": """SELECT * FROM fx_prices WHERE tariff_id % 13 <> 0
        UNION ALL SELECT tariff_id, field_id, cost + 5, amount - 3 FROM fx_prices
        WHERE tariff_id % 17 = 0 AND field_id = 1 AND tariff_id % 13 <> 0
        UNION ALL SELECT tariff_id, 7, cost, amount FROM fx_prices WHERE tariff_id % 13 = 0 AND field_id = 1""",
    "fx_shifts": """SELECT event_id AS id, user_id % 25 AS tk_id, CAST(ts AS DATE) AS date_,
        CAST(ts AS DATE) AS file_date, CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS first_activation,
        CASE WHEN event_id % 10 = 0 THEN NULL
             ELSE ts + to_hours(CAST(event_id % 12 AS INT)) END AS last_deactivation,
        event_id % 12 AS active_time_hours, event_id % 50 AS picked_sku,
        CASE WHEN event_type = 'error' THEN NULL ELSE 1 END AS full_payment_doer FROM events""",
    "fx_template": """SELECT user_id AS courier_id, CAST(isodow(ts) AS INT) AS day_of_week_number,
        event_id AS row_no,
        CASE WHEN event_id % 9 = 0 THEN NULL ELSE ts END AS couriers_intervals_last_update FROM events""",
    "fx_updates": """SELECT o_orderkey AS k, 'U' AS status,
        CAST(FLOOR(o_totalprice) + o_orderkey % 8 AS BIGINT) AS price FROM orders WHERE o_orderkey % 4 = 0
        UNION ALL SELECT o_orderkey + 1000000000, 'N', 1 FROM orders WHERE o_orderkey % 40 = 0""",
    # latest usable tariff per day and key; needs fx_tariffs and a days(date_) table before it
    "held": """SELECT d.date_, t.project_id, t.region_id, t.speciality_id, MAX(t.id) AS tariff_id
        FROM days d JOIN (SELECT *, CASE WHEN state_id = 4 THEN state_date ELSE date_stop END AS till
            FROM fx_tariffs WHERE state_id = 3 OR (state_id = 4 AND created <> state_date)) t
        ON d.date_ >= t.date_start AND (t.till IS NULL OR d.date_ <= t.till) GROUP BY ALL""",
    "days": "SELECT DISTINCT date_ FROM fx_work WHERE full_payment_client IS NULL",
}


def with_fx(sql: str, *names: str, **extra: str) -> str:
    """The SQL with the named inputs (and further ones) as common table expressions before it."""
    parts = [f"{n} AS ({FX[n]})" for n in names] + [f"{n} AS ({s})" for n, s in extra.items()]
    return f"WITH {', '.join(parts)} {sql}"


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under a name, with its SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
