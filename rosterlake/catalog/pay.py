"""Tariffs, pay and revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rosterlake.catalog.base import FX, Tables, new_store, query, with_fx
from rosterlake.operators.aggregate import pending_values
from rosterlake.operators.store import Change
from rosterlake.plans.pay import (
    COURIER_FACTS, COURIER_FIELDS, COURIER_PAY, MONTHS, PICKER_FIELDS, PICKER_PAY, courier_pay, courier_repriced, courier_unmatched,
    picker_pay, picker_repriced, picker_unmatched, reprice_couriers_stored,
)
from rosterlake.plans.tariffs import date_bounds, effective_prices, repeated_prices
from rosterlake.session import run_folder, settle

FACTS = """SELECT w.*, k.region_id, CASE transport_id WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 4 THEN 2 ELSE 1 END
    AS speciality_id FROM fx_work w JOIN fx_tks k ON k.tk_id = w.tk_id
    WHERE k.region_id IS NOT NULL AND w.date_ IN (SELECT date_ FROM days)"""


def _price_sql(field: int, price: str) -> str:
    return f"(MAX(CASE WHEN p.field_id = {field} THEN {{'cost': p.cost, 'amount': p.amount}} END)).{price}"


def _side_sql(side: str, price: str) -> str:
    # of a field that is priced twice, one whole price counts
    p = {f: _price_sql(f, price) for f in COURIER_FIELDS}
    short = f"active_time_hours > 11 AND orders_delivered < 11 AND {p[58]} > active_time_hours * {p[1]} + orders_delivered * {p[2]}"
    over = "daily_distance - 8 * orders_delivered"
    return f"""CASE WHEN {short} THEN {p[58]} ELSE 0 END AS mandatory_{side},
        CASE WHEN {short} AND {p[58]} <> 0 THEN 0 ELSE active_time_hours * {p[1]} END AS hour_{side},
        CASE WHEN {short} AND {p[58]} <> 0 THEN 0 ELSE orders_delivered * {p[2]} END AS order_{side},
        orders_over_twenty_kg * {p[59]} AS orders_over_twenty_kg_{side},
        orders_over_forty_kg * {p[82]} AS orders_over_forty_kg_{side},
        CASE WHEN {over} > 0 THEN ({over}) * {p[60]} ELSE 0 END AS mileage_{side}"""


def _total_sql(side: str) -> str:
    parts = ("mandatory", "hour", "order", "orders_over_twenty_kg", "orders_over_forty_kg", "mileage")
    return " + ".join(f"{part}_{side}" for part in parts) + f" AS full_payment_{side}"


COURIER_PARTS_SQL = f"""SELECT f.id, {_side_sql('client', 'amount')}, {_side_sql('doer', 'cost')}
    FROM facts f JOIN held h ON h.date_ = f.date_ AND h.region_id = f.region_id
    AND h.speciality_id = f.speciality_id AND h.project_id = 20
    LEFT JOIN fx_priced p ON p.tariff_id = h.tariff_id AND p.field_id IN {COURIER_FIELDS}
    GROUP BY f.id, active_time_hours, orders_delivered, daily_distance, orders_over_twenty_kg, orders_over_forty_kg"""
COURIER_SQL = with_fx(
    "SELECT id, "
    + ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in COURIER_PAY)
    + f" FROM (SELECT *, {_total_sql('client')}, {_total_sql('doer')} FROM ({COURIER_PARTS_SQL}))",
    "fx_tks", "fx_work", "fx_tariffs", "fx_prices", "fx_priced", "days", "held",
    facts=FACTS,
)


@query(
    "effective_tariffs",
    with_fx(
        "SELECT h.date_, h.project_id, h.region_id, h.speciality_id, h.tariff_id, p.field_id, p.cost, p.amount "
        f"FROM held h JOIN fx_prices p ON p.tariff_id = h.tariff_id WHERE p.field_id IN {COURIER_FIELDS}",
        "fx_work", "fx_tariffs", "fx_prices", "days", "held",
    ),
)
def prices_in_force(t: Tables) -> DataFrame:
    days = settle(pending_values(t.fx_work(), "full_payment_client", "date_"), "pending-days")
    return effective_prices(t.fx_tariffs(), t.fx_prices(COURIER_FIELDS), days, date_bounds(days, "date_"))


def courier_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return t.fx_work(), t.fx_tks(), t.fx_tariffs(), t.fx_priced(COURIER_FIELDS)


@query("courier_pay", COURIER_SQL)
def couriers_paid(t: Tables) -> DataFrame:
    return courier_pay(*courier_inputs(t))


@query(
    "courier_repriced",
    with_fx(
        f"SELECT w.id, w.courier_id, w.date_, COALESCE(p.full_payment_client, w.full_payment_client) AS full_payment_client "
        f"FROM fx_work w LEFT JOIN ({COURIER_SQL}) p ON p.id = w.id", "fx_work",
    ),
)
def couriers_updated(t: Tables) -> DataFrame:
    work, tks, tariffs, prices = courier_inputs(t)
    table = work.withColumn("full_payment_client", F.col("full_payment_client").cast("double"))
    return courier_repriced(table, tks, tariffs, prices).select("id", "courier_id", "date_", "full_payment_client")


@query(
    "unmatched_tariffs",
    with_fx(
        "SELECT f.id, f.date_, f.region_id, f.speciality_id FROM facts f WHERE NOT EXISTS (SELECT 1 FROM held h "
        "WHERE h.date_ = f.date_ AND h.region_id = f.region_id AND h.speciality_id = f.speciality_id)",
        "fx_tks", "fx_work", "fx_tariffs", "days", "held", facts=FACTS,
    ),
)
def unpriced(t: Tables) -> DataFrame:
    return courier_unmatched(*courier_inputs(t)[:3]).select("id", "date_", "region_id", "speciality_id")


@query(
    "repeated_prices",
    with_fx(
        f"SELECT tariff_id, field_id, COUNT(*) AS rows_found FROM fx_priced WHERE field_id IN {COURIER_FIELDS} "
        "GROUP BY ALL HAVING COUNT(*) > 1", "fx_prices", "fx_priced",
    ),
)
def priced_twice(t: Tables) -> DataFrame:
    return repeated_prices(t.fx_priced(COURIER_FIELDS), COURIER_FIELDS)


@query(
    "repriced_stored",
    with_fx(
        f"SELECT w.id, w.courier_id, w.date_, COALESCE(p.full_payment_client, w.full_payment_client) AS full_payment_client "
        f"FROM fx_work w LEFT JOIN ({COURIER_SQL}) p ON p.id = w.id", "fx_work",
    ),
)
def couriers_updated_on_disk(t: Tables) -> DataFrame:
    """The same next state for a stored table, of which only the pending days are read and rewritten."""
    work, tks, tariffs, prices = courier_inputs(t)
    table = work.withColumn("full_payment_client", F.col("full_payment_client").cast("double"))
    store = new_store(t, "work")

    def before(change: Change) -> int:
        change.create("work", table.schema, MONTHS, COURIER_FACTS)
        return change.append("work", table)

    store.commit("before", before)
    store.commit("pay", lambda change: reprice_couriers_stored(change, "work", tks, tariffs, prices))
    return store.table("work").select("id", "courier_id", "date_", "full_payment_client")


def _band(low: int, high: int) -> str:
    end = f"(CASE WHEN f < {high} THEN f ELSE {high} END)"
    return f"(CASE WHEN s >= {low} AND s <= {end} THEN {end} - s ELSE 0 END)"


def _picker_side(side: str, price: str) -> str:
    p = {f: f"CAST({_price_sql(f, price)} AS DOUBLE)" for f in PICKER_FIELDS}
    return f"""COALESCE(hours_day * {p[1]}, 0) AS hour_day_{side}, COALESCE(hours_night * {p[86]}, 0) AS hour_night_{side},
    COALESCE(CASE WHEN active_time_hours <> 0 THEN CAST(picked_sku AS DOUBLE) / active_time_hours END * hours_day * {p[92]}, 0)
    AS picked_SKU_{side}"""


PICKER_SQL = with_fx(
    "SELECT id, "
    + ", ".join(f"ROUND({c}, 6) AS {c}" for c in PICKER_PAY if not c.startswith("full"))
    + ", ROUND(hour_day_client + hour_night_client + picked_SKU_client, 6) AS full_payment_client"
    + ", ROUND(hour_day_doer + hour_night_doer + picked_SKU_doer, 6) AS full_payment_doer FROM ("
    + f"SELECT b.id, {_picker_side('client', 'amount')}, {_picker_side('doer', 'cost')} FROM bands b "
    "JOIN held h ON h.date_ = b.date_ AND h.region_id = b.region_id AND h.speciality_id = 3 "
    "LEFT JOIN fx_priced p ON p.tariff_id = h.tariff_id AND p.field_id IN (1, 86, 92) "
    "GROUP BY b.id, hours_day, hours_night, active_time_hours, picked_sku)",
    "fx_tks", "fx_shifts", "fx_tariffs", "fx_prices", "fx_priced",
    days="SELECT DISTINCT date_ FROM fx_shifts WHERE full_payment_doer IS NULL AND file_date > DATE '2022-05-11'",
    held=FX["held"],
    bands=f"SELECT id, date_, region_id, active_time_hours, picked_sku, {_band(6, 22)} AS hours_day, "
          f"{_band(0, 6)} + {_band(22, 24)} AS hours_night FROM (SELECT x.*, k.region_id, "
          "hour(first_activation) + minute(first_activation) / 60 AS s, "
          "hour(last_deactivation) + minute(last_deactivation) / 60 AS f "
          "FROM fx_shifts x JOIN fx_tks k ON k.tk_id = x.tk_id WHERE k.region_id IS NOT NULL "
          "AND first_activation IS NOT NULL AND date_ IN (SELECT date_ FROM days))",
    )


@query("picker_pay", PICKER_SQL)
def pickers_paid(t: Tables) -> DataFrame:
    prices = t.fx_priced(PICKER_FIELDS)
    paid = picker_pay(t.fx_shifts(), t.fx_tks(), t.fx_tariffs(), prices)
    return paid.select("id", *[F.round(c, 6).alias(c) for c in PICKER_PAY])


@query(
    "picker_repriced",
    with_fx(
        "SELECT x.id, x.date_, COALESCE(p.full_payment_doer, x.full_payment_doer) AS full_payment_doer "
        f"FROM fx_shifts x LEFT JOIN ({PICKER_SQL}) p ON p.id = x.id", "fx_shifts",
    ),
)
def pickers_updated(t: Tables) -> DataFrame:
    table = t.fx_shifts().withColumn("full_payment_doer", F.col("full_payment_doer").cast("double"))
    after = picker_repriced(table, t.fx_tks(), t.fx_tariffs(), t.fx_priced(PICKER_FIELDS))
    return after.select("id", "date_", F.round("full_payment_doer", 6).alias("full_payment_doer"))


@query(
    "unmatched_picker_tariffs",
    with_fx(
        "SELECT x.id, x.date_, k.region_id FROM fx_shifts x JOIN fx_tks k ON k.tk_id = x.tk_id "
        "WHERE k.region_id IS NOT NULL AND first_activation IS NOT NULL AND x.date_ IN (SELECT date_ FROM days) "
        "AND NOT EXISTS (SELECT 1 FROM held h WHERE h.date_ = x.date_ AND h.region_id = k.region_id AND h.speciality_id = 3)",
        "fx_tks", "fx_shifts", "fx_tariffs",
        days="SELECT DISTINCT date_ FROM fx_shifts WHERE full_payment_doer IS NULL AND file_date > DATE '2022-05-11'",
        held=FX["held"],
    ),
)
def pickers_unpriced(t: Tables) -> DataFrame:
    return picker_unmatched(t.fx_shifts(), t.fx_tks(), t.fx_tariffs()).select("id", "date_", "region_id")
