"""Loads into stored tables, checked by their run logs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from rosterlake.catalog.base import ORACLES, Tables, new_store, query
from rosterlake.catalog.ingests import (
    ROLE_LABELS, _code_sql, _labels_sql, addresses, courier_chunks, dimensions, hours_chunks, hours_load, known_couriers, known_hours,
    regions_by_name, revenue_chunks, stores_and_organisations,
)
from rosterlake.operators.store import Change, Store
from rosterlake.plans import reports as R, stored
from rosterlake.plans.pay import COURIER_FACTS, MONTHS
from rosterlake.plans.shift_reports import load_couriers
from rosterlake.plans.slices import contract_slice


def start_names(t: Tables, store: Store) -> None:
    """Dictionaries of stores and organisations as they are before the first load."""
    tks, organisations = stores_and_organisations(t)
    store.commit("dictionaries", lambda change: stored.start(change, tks=tks, organisations=organisations))


@query(
    "log_revenues",
    """SELECT 'event' AS event_type, 'revenues' AS event_source,
    'rev-' || o_orderkey // 200 || '.xlsx: ' || COUNT(*) || ' rows' AS description FROM orders GROUP BY o_orderkey // 200
    UNION ALL """ + ORACLES["ingest_revenue_audit"],
)
def revenues_logged(t: Tables) -> DataFrame:
    store = new_store(t, "revenues")
    store.commit("one", lambda change: stored.append_revenues(change, revenue_chunks(t), dimensions(t)))
    return stored.run_log(store)


@query(
    "log_couriers",
    f"""SELECT 'event' AS event_type, 'couriers' AS event_source, 'inserted ' || COUNT(*) FILTER (action = 'inserted')
    || ', updated ' || COUNT(*) FILTER (action = 'updated') AS description FROM ({ORACLES["ingest_couriers"]})
    UNION ALL SELECT * FROM ({ORACLES["ingest_shift_warnings"]})""",
)
def couriers_logged(t: Tables) -> DataFrame:
    store = new_store(t, "couriers")
    start_names(t, store)
    known = known_couriers(t, load_couriers(courier_chunks(t), *stores_and_organisations(t)))

    def before(change: Change) -> int:
        change.create(stored.COURIERS, known.schema, MONTHS, COURIER_FACTS)
        return change.append(stored.COURIERS, known)

    store.commit("before", before)
    store.commit("one", lambda change: stored.merge_couriers(change, courier_chunks(t)))
    # what the dictionaries gained is logged too; see dict_stored
    return stored.run_log(store).filter("event_source <> 'dictionaries'")


@query(
    "log_hours",
    f"""SELECT 'event' AS event_type, 'hours' AS event_source, filename || ': ' || COUNT(*) || ' rows' AS description
    FROM ({ORACLES["ingest_hours"]}) WHERE filename <> 'old' GROUP BY filename
    UNION ALL SELECT 'warning', 'hours', 'speciality_id is 0 in ' || COUNT(*) || ' rows' FROM (
    SELECT *, {_labels_sql(ROLE_LABELS, 'c_custkey')} AS role, MIN(c_custkey) OVER (PARTITION BY c_custkey // 100) AS lo,
    MAX(c_custkey) OVER (PARTITION BY c_custkey // 100) AS hi FROM customer)
    WHERE c_custkey > lo AND c_custkey < hi AND {_code_sql('role', R.ROLES, 0)} = 0 HAVING COUNT(*) > 0""",
)
def hours_logged(t: Tables) -> DataFrame:
    return stored.run_log(hours_store(t)).filter("event_source <> 'dictionaries'")


def hours_store(t: Tables) -> Store:
    """A store with hours of before, and then the delivery."""
    store = new_store(t, "hours")
    schema = hours_load(t)[1].rows.schema

    def before(change: Change) -> int:
        stored.start(change, addresses=addresses(t))
        change.create(stored.HOURS, schema, "date_format(report_date, 'yyyy-MM')")
        return change.append(stored.HOURS, known_hours(t))

    store.commit("before", before)
    store.commit("one", lambda change: stored.replace_hours(change, hours_chunks(t), regions_by_name(t)))
    return store


@query("hours_stored", ORACLES["ingest_hours"])
def hours_on_disk(t: Tables) -> DataFrame:
    """The next state of stored hours; dates that only bring zeros are emptied."""
    return hours_store(t).table(stored.HOURS)


@query(
    "log_slices",
    """SELECT 'event' AS event_type, 'contracts' AS event_source,
    COUNT(*) || ' rows of the day before 1997-03-10' AS description FROM orders WHERE o_orderstatus = 'O'
    OR (o_orderstatus <> 'O' AND CAST(o_orderdate AS DATE) = DATE '1997-03-09')""",
)
def slices_logged(t: Tables) -> DataFrame:
    store = new_store(t, "slices")
    rows = t.orders.selectExpr("o_orderkey AS id", "o_orderstatus = 'O' AS is_active", "o_orderdate AS changed")
    day = date(1997, 3, 10)
    store.commit("one", lambda change: stored.add_slice(change, contract_slice(rows, day, rows.columns), day, "contracts"))
    return stored.run_log(store)
