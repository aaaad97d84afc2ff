"""Write semantics and daily snapshots."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, functions as F

from rosterlake.catalog.base import Tables, new_store, query, with_fx
from rosterlake.operators.store import Change
from rosterlake.operators.writes import (
    blank_withdrawn, insert_if_absent, keyed_update, merge_rows, replace_covered, replace_dates, upsert,
)
from rosterlake.plans.slices import CONTRACT_COLUMNS, COURIER_COLUMNS, contract_slice, courier_slice, store_slice

_BASE = "SELECT o_orderkey AS k, o_orderstatus AS status, CAST(FLOOR(o_totalprice) AS BIGINT) AS price, " \
        "CAST(o_orderdate AS DATE) AS created FROM orders"


def base_orders(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey AS k", "o_orderstatus AS status", "CAST(FLOOR(o_totalprice) AS BIGINT) AS price",
        "CAST(o_orderdate AS DATE) AS created",
    )


_UPSERT_SQL = """SELECT COALESCE(b.k, u.k) AS k, COALESCE(u.status, b.status) AS status,
    COALESCE(u.price, b.price) AS price, b.created AS created,
    CASE WHEN b.k IS NULL THEN 'inserted' WHEN u.k IS NULL THEN 'kept' ELSE 'updated' END AS action
    FROM base b FULL JOIN fx_updates u ON b.k = u.k"""


@query("upsert", with_fx(_UPSERT_SQL, "fx_updates", base=_BASE))
def upserted(t: Tables) -> DataFrame:
    return upsert(base_orders(t), t.fx_updates(), ["k"], ["status", "price"], action="action")


@query(
    "upsert_last_wins",
    with_fx(
        """SELECT COALESCE(b.k, u.k) AS k, COALESCE(u.event_type, b.status) AS status, b.price, b.created
        FROM base b FULL JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY day DESC,
        event_id DESC) AS rn FROM (SELECT event_id % 400 * 50 AS k, event_type, event_id, CAST(ts AS DATE) AS day
        FROM events)) WHERE rn = 1) u ON b.k = u.k""", base=_BASE,
    ),
)
def upserted_last(t: Tables) -> DataFrame:
    updates = t.events.selectExpr(
        "event_id % 400 * 50 AS k", "event_type AS status", "event_id", "CAST(ts AS DATE) AS day"
    )
    return upsert(base_orders(t), updates, ["k"], ["status"], ["day", "event_id"])


@query(
    "upsert_changed",
    with_fx(
        """SELECT COALESCE(b.k, u.k) AS k, COALESCE(u.price, b.price) AS price,
        CASE WHEN u.k IS NOT NULL AND (b.k IS NULL OR u.price <> b.price) THEN 'new.xlsx' ELSE 'old.xlsx' END AS filename
        FROM base b FULL JOIN fx_updates u ON b.k = u.k""", "fx_updates", base=_BASE,
    ),
)
def upserted_changed(t: Tables) -> DataFrame:
    target = base_orders(t).select("k", "price", F.lit("old.xlsx").alias("filename"))
    updates = t.fx_updates().select("k", "price", F.lit("new.xlsx").alias("filename"))
    return upsert(target, updates, ["k"], ["price"], provenance=["filename"])


@query(
    "write_counts",
    with_fx(
        f"SELECT action, COUNT(*) AS rows FROM ({_UPSERT_SQL}) GROUP BY 1", "fx_updates", base=_BASE,
    ),
)
def counted_actions(t: Tables) -> DataFrame:
    rows = upsert(base_orders(t), t.fx_updates(), ["k"], ["status", "price"], action="action")
    return rows.groupBy("action").agg(F.count("*").alias("rows"))


@query(
    "keyed_update",
    with_fx(
        """SELECT b.k, b.status, CASE WHEN u.k IS NOT NULL THEN u.price ELSE b.price END AS price, b.created
        FROM base b LEFT JOIN fx_updates u ON b.k = u.k""", "fx_updates", base=_BASE,
    ),
)
def updated(t: Tables) -> DataFrame:
    return keyed_update(base_orders(t), t.fx_updates(), ["k"], ["price"])


@query(
    "replace_dates",
    with_fx(
        """SELECT * FROM base WHERE created NOT IN (SELECT created FROM base WHERE k % 400 = 0)
        UNION ALL SELECT k + 1000000000, 'R', price, created FROM base WHERE k % 400 = 0 AND price > 100000""",
        base=_BASE,
    ),
)
def replaced(t: Tables) -> DataFrame:
    base = base_orders(t)
    covered = base.filter("k % 400 = 0")
    report = covered.filter("price > 100000").selectExpr("k + 1000000000 AS k", "'R' AS status", "price", "created")
    return replace_dates(base, report, "created", covered.select("created"))


@query(
    "replace_dates_stored",
    with_fx(
        """SELECT * FROM half WHERE created NOT IN (SELECT created FROM half WHERE k % 300 = 0)
        UNION ALL SELECT k, 'R', price, created FROM half WHERE k % 300 = 0 AND month(created) <> 3""",
        half="SELECT k, status, price, date_trunc('month', created)::DATE AS created FROM base_all",
    ).replace("WITH half", f"WITH base_all AS ({_BASE}), half"),
)
def replaced_on_disk(t: Tables) -> DataFrame:
    """Dates the report covers without having rows for them are emptied too."""
    store = new_store(t, "replace")
    base = base_orders(t).withColumn("created", F.trunc("created", "month"))
    covered = base.filter("k % 300 = 0").withColumn("status", F.lit("R"))
    report = covered.filter("month(created) <> 3")

    def before(change: Change) -> int:
        change.create("orders", base.schema, "date_format(created, 'yyyy')")
        return change.append("orders", base)

    store.commit("before", before)
    store.commit("report", lambda change: replace_covered(change, "orders", report, covered.select("created"), "created"))
    return store.table("orders")


@query(
    "merge_stored",
    with_fx(
        """SELECT COALESCE(b.k, u.k) AS k, COALESCE(u.status, b.status) AS status, COALESCE(b.month, u.month) AS month
        FROM base b FULL JOIN upd u ON b.k = u.k AND b.month = u.month""",
        base="SELECT o_orderkey AS k, o_orderstatus AS status, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders",
        upd="SELECT o_orderkey * 2 AS k, 'M' AS status, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders "
            "WHERE o_orderdate < TIMESTAMP '1995-04-01'",
    ),
)
def merged_on_disk(t: Tables) -> DataFrame:
    store = new_store(t, "merge")
    month = F.trunc(F.to_date("o_orderdate"), "month").alias("month")
    base = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), month)
    updates = t.orders.filter("o_orderdate < '1995-04-01'").select(
        (F.col("o_orderkey") * 2).alias("k"), F.lit("M").alias("status"), month
    )
    for step, rows in enumerate((base, updates)):
        store.commit(f"step {step}", merging(rows))
    return store.table("orders")


def merging(rows: DataFrame, meanwhile: Callable[[], object] | None = None) -> Callable[[Change], dict[str, int]]:
    """A merge into the table orders; ``meanwhile`` is called once, after the rows are staged and before they are visible."""
    calls = [meanwhile] if meanwhile else []

    def work(change: Change) -> dict[str, int]:
        change.create("orders", rows.schema, "date_format(month, 'yyyy-MM')")
        counts = merge_rows(change, "orders", rows, ["k", "month"], ["status"])
        if calls:
            calls.pop()()
        return counts

    return work


_STEPS = """SELECT o_orderkey AS k, o_orderstatus AS status, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, 0 AS step FROM orders
    UNION ALL SELECT o_orderkey, 'B', CAST(date_trunc('month', o_orderdate) AS DATE), 1 FROM orders
    WHERE o_orderkey % 3 = 0 AND o_orderdate < TIMESTAMP '1995-06-01'
    UNION ALL SELECT o_orderkey * 2, 'A', CAST(date_trunc('month', o_orderdate) AS DATE), 2 FROM orders WHERE o_orderdate < TIMESTAMP '1995-04-01'
    UNION ALL SELECT o_orderkey + 1000000000, 'D', DATE '1995-02-01', 3 FROM orders WHERE o_orderkey % 50 = 0
    UNION ALL SELECT o_orderkey, 'C', CAST(date_trunc('month', o_orderdate) AS DATE), 4 FROM orders
    WHERE o_orderkey % 5 = 0 AND o_orderdate < TIMESTAMP '1995-03-01'"""


@query(
    "commit_conflicts",
    f"""SELECT k, status, month FROM (SELECT *, row_number() OVER (PARTITION BY k, month ORDER BY step DESC) AS rn FROM ({_STEPS}))
    WHERE rn = 1""",
)
def conflicting(t: Tables) -> DataFrame:
    """Writer B commits while A has staged the same months, D while C has died after staging; C is run again. No row is lost."""
    store = new_store(t, "conflicts")
    month = F.trunc(F.to_date("o_orderdate"), "month").alias("month")

    def rows(where: str, key: str, status: str) -> DataFrame:
        return t.orders.filter(where).select(F.expr(f"{key} AS k"), F.expr(f"{status} AS status"), month)

    a, b = rows("o_orderdate < '1995-04-01'", "o_orderkey * 2", "'A'"), rows("o_orderkey % 3 = 0 AND o_orderdate < '1995-06-01'", "o_orderkey", "'B'")
    c = rows("o_orderkey % 5 = 0 AND o_orderdate < '1995-03-01'", "o_orderkey", "'C'")
    d = t.orders.filter("o_orderkey % 50 = 0").selectExpr("o_orderkey + 1000000000 AS k", "'D' AS status", "DATE '1995-02-01' AS month")

    class Died(Exception):
        pass

    def die() -> None:
        raise Died

    store.commit("base", merging(rows("true", "o_orderkey", "o_orderstatus")))
    store.commit("A", merging(a, lambda: store.commit("B", merging(b))))
    try:
        store.commit("C", merging(c, die))
    except Died:
        store.commit("D", merging(d))
        store.commit("C", merging(c))
    return store.table("orders")


@query(
    "merge_counts",
    """WITH upd AS (SELECT o_orderkey * 2 AS k, date_trunc('month', o_orderdate) AS month FROM orders
    WHERE o_orderdate < TIMESTAMP '1995-04-01'), base AS (SELECT o_orderkey AS k, date_trunc('month', o_orderdate) AS month FROM orders)
    SELECT 0 AS step, 'inserted' AS action, COUNT(*) AS rows FROM base UNION ALL SELECT 0, 'updated', 0
    UNION ALL SELECT 1, 'inserted', COUNT(*) FROM (SELECT * FROM upd EXCEPT SELECT * FROM base)
    UNION ALL SELECT 1, 'updated', COUNT(*) FROM (SELECT * FROM upd INTERSECT SELECT * FROM base)""",
)
def merge_counted(t: Tables) -> DataFrame:
    """Rows per action as two merges into a stored table report them."""
    store = new_store(t, "merge")
    month = F.trunc(F.to_date("o_orderdate"), "month").alias("month")
    base = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), month)
    updates = t.orders.filter("o_orderdate < '1995-04-01'").select(
        (F.col("o_orderkey") * 2).alias("k"), F.lit("M").alias("status"), month
    )
    found = [
        (step, action, n)
        for step, rows in enumerate((base, updates))
        for action, n in store.commit(f"step {step}", merging(rows)).items()
    ]
    return t.spark.createDataFrame(found, "step int, action string, rows bigint")


_PARTIAL = "SELECT o_orderkey % 5000 AS id, o_orderstatus AS status, CASE WHEN o_orderkey % 9 <> 0 THEN " \
           "o_orderpriority END AS priority FROM orders"


@query(
    "insert_if_absent",
    with_fx(
        """SELECT * FROM (SELECT DISTINCT * FROM rows WHERE priority IS NOT NULL
        UNION ALL SELECT * FROM rows WHERE priority IS NULL) b WHERE NOT EXISTS (SELECT 1 FROM rows t
        WHERE t.id % 2 = 0 AND t.id = b.id AND t.status = b.status AND t.priority = b.priority)""", rows=_PARTIAL,
    ),
)
def inserted(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(
        "o_orderkey % 5000 AS id", "o_orderstatus AS status",
        "CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS priority",
    )
    return insert_if_absent(rows.filter("id % 2 = 0"), rows, rows.columns)


@query(
    "insert_if_absent_null_safe",
    with_fx("SELECT * FROM rows EXCEPT SELECT * FROM rows WHERE id % 2 = 0", rows=_PARTIAL),
)
def inserted_once(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(
        "o_orderkey % 5000 AS id", "o_orderstatus AS status",
        "CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS priority",
    )
    return insert_if_absent(rows.filter("id % 2 = 0"), rows, rows.columns, null_safe=True)


@query(
    "blank_withdrawn",
    """SELECT event_id, user_id, CAST(ts AS DATE) AS preferred_date,
    CASE WHEN hit THEN NULL ELSE event_type END AS zones, CASE WHEN hit THEN 'n.xlsx' ELSE 'o.xlsx' END AS filename
    FROM (SELECT *, user_id IN (SELECT user_id FROM events WHERE event_id % 29 = 0)
    AND CAST(ts AS DATE) BETWEEN DATE '2024-01-13' AND DATE '2024-01-14' AS hit FROM events)""",
)
def blanked(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id", "user_id", F.to_date("ts").alias("preferred_date"), F.col("event_type").alias("zones"),
        F.lit("o.xlsx").alias("filename"),
    )
    gone = t.events.filter("event_id % 29 = 0").select("user_id")
    return blank_withdrawn(
        rows, gone, "user_id", "preferred_date", F.lit(date(2024, 1, 10)), F.lit(date(2024, 1, 14)), (3, 4, 5),
        ["zones"], {"filename": F.lit("n.xlsx")},
    )


# column: expression over orders and customers, the same in Spark and in DuckDB
_CONTRACT = {
    "id": "o_orderkey", "type": "o_custkey % 3", "courier_id": "o_custkey", "entity_id": "o_orderkey % 7", "project_id": "20",
    "region_id": "o_custkey % 5", "speciality_id": "o_orderkey % 4", "start": "CAST(o_orderdate AS DATE)",
    "stop": "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) END",
    "termin_date": "CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderdate AS DATE) END", "is_active": "o_orderstatus = 'O'",
    "is_handed_out": "o_orderkey % 2 = 0", "created": "o_orderdate", "created_by": "o_custkey % 11", "changed": "o_orderdate",
    "changed_by": "o_custkey % 13", "client_doer_id": "concat('D', o_custkey)",
}
_COURIER = {
    **{c: f"concat('{c} ', c_custkey)" for c in COURIER_COLUMNS}, "id": "c_custkey", "state": "c_nationkey",
    "bank_name": "c_name", "med_book_checked": "c_custkey % 2 = 0", "salary_blocked": "c_custkey % 3 = 0",
}


def _columns(values: dict[str, str], names: tuple[str, ...]) -> str:
    return ", ".join(f'{values[c]} AS "{c}"' for c in names)


@query(
    "slice_contracts",
    f"""SELECT {_columns(_CONTRACT, CONTRACT_COLUMNS)}, DATE '1997-03-09' AS fix_date FROM orders
    WHERE o_orderstatus = 'O' OR (o_orderstatus <> 'O' AND CAST(o_orderdate AS DATE) = DATE '1997-03-09')""",
)
def contracts(t: Tables) -> DataFrame:
    rows = t.orders.select(*[F.expr(_CONTRACT[c]).alias(c) for c in CONTRACT_COLUMNS])
    return contract_slice(rows, date(1997, 3, 10))


@query(
    "slice_couriers",
    f"""SELECT {_columns(_COURIER, COURIER_COLUMNS)}, DATE '1997-03-09' AS fix_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1""",
)
def couriers(t: Tables) -> DataFrame:
    rows = t.customer.select(*[F.expr(_COURIER[c]).alias(c) for c in COURIER_COLUMNS])
    states = t.nation.selectExpr("n_nationkey AS id", "n_regionkey AS global_id")
    return courier_slice(rows, states, date(1997, 3, 10))


_DAY_SQL = """SELECT o_orderkey AS id, o_orderstatus = 'O' AS is_active, o_orderdate AS changed, DATE '{0}' AS fix_date
    FROM orders WHERE o_orderstatus = 'O' OR (o_orderstatus <> 'O' AND CAST(o_orderdate AS DATE) = DATE '{0}')"""


@query("slices_stored", _DAY_SQL.format("1997-03-09") + " UNION ALL " + _DAY_SQL.format("1997-03-10"))
def stored_slices(t: Tables) -> DataFrame:
    store = new_store(t, "slices")
    rows = t.orders.selectExpr("o_orderkey AS id", "o_orderstatus = 'O' AS is_active", "o_orderdate AS changed")
    # the first day is stored twice and kept once
    for step, day in enumerate((10, 11, 10)):
        slice_ = contract_slice(rows, date(1997, 3, day), rows.columns)
        store.commit(f"run {step}", lambda change, d=day, x=slice_: store_slice(change, "slices", x, date(1997, 3, d)))
    return store.table("slices")
