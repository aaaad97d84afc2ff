"""Incremental landing as streams that run until the folder is drained."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from rosterlake.catalog.base import Tables, new_store, query
from rosterlake.catalog.scans import order_books
from rosterlake.session import run_folder
from rosterlake.sources.workbook import cell_at, decode_workbooks, sheet_rows
from rosterlake.streaming.ingest import append_new, landing_stream, upsert_new

EVENT_SCHEMA = (
    StructType().add("event_id", "long").add("ts", "timestamp_ntz").add("user_id", "long").add("event_type", "string")
)


def _land(t: Tables, path: str, where: str) -> None:
    rows = t.events.filter(where).select(*EVENT_SCHEMA.names, F.hour("ts").alias("hour"))
    rows.write.mode("append").partitionBy("hour").parquet(path)


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type FROM events")
def ingested(t: Tables) -> DataFrame:
    root = run_folder(t.spark, "stream")
    for where in ("ts < '2024-01-16'", "ts >= '2024-01-16'", "event_id < 0"):
        # a second delivery adds its own rows, a run without one adds nothing
        _land(t, f"{root}/landing", where)
        stream = landing_stream(t.spark, f"{root}/landing", schema=EVENT_SCHEMA)
        append_new(stream, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.schema(EVENT_SCHEMA).parquet(f"{root}/table")


@query(
    "stream_upsert",
    """SELECT k, status, event_id, day FROM (SELECT event_id // 3 % 20 AS k, event_type AS status, event_id,
    CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY event_id // 3 % 20, CAST(ts AS DATE)
    ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def stream_upserted(t: Tables) -> DataFrame:
    """Three deliveries that share keys and days, the oldest rows of many keys last."""
    root, store = run_folder(t.spark, "stream"), new_store(t, "stream")
    for where in ("event_id % 3 = 1", "event_id % 3 = 2", "event_id % 3 = 0"):
        _land(t, f"{root}/landing", where)
        rows = landing_stream(t.spark, f"{root}/landing", schema=EVENT_SCHEMA)
        keyed = rows.selectExpr(
            "event_id div 3 % 20 AS k", "event_type AS status", "event_id", "CAST(ts AS DATE) AS day"
        )
        upsert_new(
            keyed, store, "events", ["k", "day"], ["status", "event_id"], "date_format(day, 'yyyy-MM')", ["event_id"],
            f"{root}/checkpoint",
        )
    return store.table("events")


@query(
    "stream_workbooks",
    """SELECT 'orders-' || o_orderkey // 250 || '.xlsx' AS file, sheet, o_orderkey AS k,
    CASE WHEN sheet = 0 THEN o_orderstatus END AS state FROM orders, (VALUES (0), (1)) v(sheet)""",
)
def streamed_books(t: Tables) -> DataFrame:
    root = run_folder(t.spark, "books")
    order_books(t).write.parquet(f"{root}/landing")
    schema = StructType.fromDDL("file string, content binary")
    stream = landing_stream(t.spark, f"{root}/landing", schema=schema)
    chunks = decode_workbooks(stream)
    append_new(chunks, f"{root}/chunks", f"{root}/checkpoint")
    rows = sheet_rows(t.spark.read.parquet(f"{root}/chunks"))
    return rows.select("file", "sheet", cell_at(0).cast("bigint").alias("k"), cell_at(1).alias("state"))
