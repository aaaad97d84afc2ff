"""Pay (doer) and revenue (client) per shift."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.functions import clock_hours, overlap_hours
from rosterlake.operators.aggregate import pending_values
from rosterlake.operators.joins import absent_rows, dim_join, member_rows
from rosterlake.operators.mapping import map_codes
from rosterlake.operators.store import Change
from rosterlake.plans.tariffs import PRICE_KEY, date_bounds, tariffs_in_force, wide_prices
from rosterlake.session import settle

# Project, specialities and tariff fields.
PROJECT = 20
COURIER_SPECIALITY = {0: 0, 1: 2, 4: 2}
COURIER_DEFAULT_SPECIALITY = 1
PICKER_SPECIALITY = 3
COURIER_FIELDS = (1, 2, 58, 59, 60, 82)
PICKER_FIELDS = (1, 86, 92)
PICKER_SINCE = date(2022, 5, 11)
FREE_KM_PER_ORDER = 8

SIDES = {"client": "amount", "doer": "cost"}
COURIER_PARTS = (
    "mandatory", "hour", "order", "orders_over_twenty_kg", "orders_over_forty_kg", "mileage",
)
PICKER_PARTS = ("hour_day", "hour_night", "picked_SKU")


def _pending_days(rows: DataFrame, result: str) -> DataFrame:
    """Days that still have a row without a result: at most one row per calendar day."""
    return settle(pending_values(rows, result, "date_").filter("date_ is not null"), "pending-days")


def _join_prices(
    rows: DataFrame, days: DataFrame, tks: DataFrame, prices: DataFrame, salts: int
) -> DataFrame:
    """All rows, with region, price columns and ``tariff_id``; the latter is null for rows that are
    not pending, or have no region or no tariff.

    The facts are read once and, as long as the other sides are small, never shuffled. Where the
    prices are too large to broadcast, ``salts`` spreads the rows of one price key.
    """
    regions = tks.filter("region_id is not null").select(
        F.col("tk_id").alias("_tk"), F.col("region_id").cast("int").alias("region_id")
    )
    pending = days.select(F.col("date_").alias("_day"), F.col("date_").alias("pending_date"))
    placed = dim_join(dim_join(rows, pending, {"date_": "_day"}, "left"), regions, {"tk_id": "_tk"}, "left")
    keys = {"pending_date": "date_", **{k: k for k in PRICE_KEY if k != "date_"}}
    return dim_join(placed, prices, keys, "left", salts=salts)


def _courier_side(price: str, side: str) -> dict[str, Column]:
    hours, orders = F.col("active_time_hours"), F.col("orders_delivered")
    p = {f: F.col(f"{price}_{f}") for f in COURIER_FIELDS}
    minimum = (hours > 11) & (orders < 11) & (p[58] > hours * p[1] + orders * p[2])
    extra_km = F.col("daily_distance") - FREE_KM_PER_ORDER * orders
    nothing = F.lit(0)
    return {
        f"mandatory_{side}": F.when(minimum, p[58]).otherwise(nothing),
        f"hour_{side}": F.when(minimum & (p[58] != 0), nothing).otherwise(hours * p[1]),
        f"order_{side}": F.when(minimum & (p[58] != 0), nothing).otherwise(orders * p[2]),
        f"orders_over_twenty_kg_{side}": F.col("orders_over_twenty_kg") * p[59],
        f"orders_over_forty_kg_{side}": F.col("orders_over_forty_kg") * p[82],
        f"mileage_{side}": F.when(extra_km > 0, extra_km * p[60]).otherwise(nothing),
    }


def _pay_columns(parts: tuple[str, ...]) -> list[str]:
    return [f"{part}_{side}" for part in (*parts, "full_payment") for side in SIDES]


COURIER_PAY = _pay_columns(COURIER_PARTS)
PICKER_PAY = _pay_columns(PICKER_PARTS)


def _courier_keyed(work: DataFrame) -> DataFrame:
    speciality = map_codes(F.col("transport_id"), COURIER_SPECIALITY, COURIER_DEFAULT_SPECIALITY)
    return work.withColumns({"project_id": F.lit(PROJECT), "speciality_id": speciality})


def _courier_rows(
    work: DataFrame, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, salts: int
) -> DataFrame:
    days = _pending_days(work, "full_payment_client")
    wide = wide_prices(tariffs, prices, days, date_bounds(days, "date_"), COURIER_FIELDS, integers=True)
    return _join_prices(_courier_keyed(work), days, tks, settle(wide, "prices"), salts)


def _courier_amounts() -> dict[str, Column]:
    """Pay columns. A missing price makes its part and the whole total 0, because nulls are filled
    after summing."""
    parts = {}
    for side, price in SIDES.items():
        parts.update(_courier_side(price, side))
    for side in SIDES:
        parts[f"full_payment_{side}"] = sum((parts[f"{p}_{side}"] for p in COURIER_PARTS), F.lit(0))
    return {c: F.coalesce(parts[c].cast("double"), F.lit(0.0)) for c in COURIER_PAY}


def _paid(rows: DataFrame, amounts: dict[str, Column]) -> DataFrame:
    priced = rows.filter("tariff_id is not null")
    return priced.select("id", *[e.alias(n) for n, e in amounts.items()])


def _repriced(table: DataFrame, rows: DataFrame, amounts: dict[str, Column]) -> DataFrame:
    """The table with the amounts in place of its pay columns, for priced rows only."""
    priced = F.col("tariff_id").isNotNull()
    columns = []
    for c in table.columns:
        kept = F.col(c)
        new = F.when(priced, amounts[c]).otherwise(kept) if c in amounts else kept
        columns.append(new.alias(c))
    return rows.select(*columns)


def courier_pay(
    work: DataFrame, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, salts: int = 1
) -> DataFrame:
    """Pay columns per courier shift id, for all shifts of the days that still miss a result.

    Shifts of a store without a region and shifts without a tariff are left out.
    """
    rows = _courier_rows(work, tks, tariffs, prices, salts)
    return _paid(rows, _courier_amounts())


def courier_repriced(
    work: DataFrame, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, salts: int = 1
) -> DataFrame:
    """The courier shift table with the pay of ``courier_pay`` filled in, in one pass over it."""
    rows = _courier_rows(work, tks, tariffs, prices, salts)
    return _repriced(work, rows, _courier_amounts())


def _unmatched(pending: DataFrame, days: DataFrame, tks: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Rows with a region for whose day, region and speciality no tariff holds; prices are not read."""
    regions = tks.filter("region_id is not null").select(
        F.col("tk_id").alias("_tk"), F.col("region_id").cast("int").alias("region_id")
    )
    held = settle(tariffs_in_force(tariffs, days, date_bounds(days, "date_")), "held")
    placed = dim_join(pending, regions, {"tk_id": "_tk"})
    return absent_rows(placed, held.select(*PRICE_KEY), PRICE_KEY)


def courier_unmatched(work: DataFrame, tks: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Pending shifts with a region but without a tariff; they never stop a run."""
    days = _pending_days(work, "full_payment_client")
    return _unmatched(member_rows(_courier_keyed(work), days, ["date_"]), days, tks, tariffs)


def shift_bands(rows: DataFrame) -> DataFrame:
    """Hours of each shift by day (6–22) and night (0–6 and 22–24); see ``overlap_hours``."""
    start, finish = clock_hours(F.col("first_activation")), clock_hours(F.col("last_deactivation"))
    return rows.withColumns(
        {
            "hours_day": overlap_hours(start, finish, 6, 22),
            "hours_night": overlap_hours(start, finish, 0, 6) + overlap_hours(start, finish, 22, 24),
        }
    )


def _picker_days(shifts: DataFrame) -> DataFrame:
    return _pending_days(shifts.filter(F.col("file_date") > F.lit(PICKER_SINCE)), "full_payment_doer")


def _picker_keyed(shifts: DataFrame) -> DataFrame:
    # a shift that never started is not priced
    speciality = F.when(F.col("first_activation").isNotNull(), F.lit(PICKER_SPECIALITY))
    return shift_bands(shifts).withColumns({"project_id": F.lit(PROJECT), "speciality_id": speciality})


def _picker_tariffs(tariffs: DataFrame) -> DataFrame:
    return tariffs.filter((F.col("speciality_id") == PICKER_SPECIALITY) & (F.col("project_id") == PROJECT))


def _picker_rows(
    shifts: DataFrame, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, salts: int
) -> DataFrame:
    days, own = _picker_days(shifts), _picker_tariffs(tariffs)
    wide = wide_prices(own, prices, days, date_bounds(days, "date_"), PICKER_FIELDS, integers=False)
    return _join_prices(_picker_keyed(shifts), days, tks, settle(wide, "prices"), salts)


def picker_unmatched(shifts: DataFrame, tks: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Started shifts of pending days with a region but without a tariff."""
    days = _picker_days(shifts)
    started = member_rows(_picker_keyed(shifts), days, ["date_"]).filter("speciality_id is not null")
    return _unmatched(started, days, tks, _picker_tariffs(tariffs))


def _picker_amounts() -> dict[str, Column]:
    rate = F.try_divide(F.col("picked_SKU").cast("double"), F.col("active_time_hours").cast("double"))
    parts = {}
    for side, price in SIDES.items():
        p = {f: F.col(f"{price}_{f}").cast("double") for f in PICKER_FIELDS}
        amounts = (
            F.col("hours_day") * p[1], F.col("hours_night") * p[86], rate * F.col("hours_day") * p[92]
        )
        filled = [F.coalesce(a, F.lit(0.0)) for a in amounts]
        parts.update({f"{part}_{side}": a for part, a in zip(PICKER_PARTS, filled)})
        parts[f"full_payment_{side}"] = filled[0] + filled[1] + filled[2]
    return {c: parts[c] for c in PICKER_PAY}


def picker_pay(
    shifts: DataFrame, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, salts: int = 1
) -> DataFrame:
    """Pay columns per picker shift id; shifts without a start, region or tariff are left out."""
    rows = _picker_rows(shifts, tks, tariffs, prices, salts)
    return _paid(rows, _picker_amounts())


def picker_repriced(
    shifts: DataFrame, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, salts: int = 1
) -> DataFrame:
    """The picker shift table with the pay of ``picker_pay`` filled in, in one pass over it."""
    rows = _picker_rows(shifts, tks, tariffs, prices, salts)
    return _repriced(shifts, rows, _picker_amounts())


# Stored shift tables -------------------------------------------------------------------------

#: A stored shift table keeps, per partition, the days that still have a row without a result.
MONTHS = "date_format(date_, 'yyyy-MM')"
COURIER_FACTS = {"pending": ("full_payment_client IS NULL", "date_")}
PICKER_FACTS = {"pending": (f"full_payment_doer IS NULL AND file_date > DATE '{PICKER_SINCE}'", "date_")}


def pending_days(change: Change, name: str) -> DataFrame:
    """Days of a stored shift table that still miss a result, told by its version; no data is read."""
    days = [(date.fromisoformat(d),) for d in change.fact(name, "pending")]
    return change.spark.createDataFrame(days, "date_ date")


def _reprice_stored(change: Change, name: str, reprice: Callable[[DataFrame], DataFrame]) -> dict[str, int]:
    """Price the pending days of a stored shift table; its partitions depend on ``date_`` alone.

    Only the partitions of those days are read and written, and only their rows are joined to prices. Returns the days
    and their rows.
    """
    days = settle(pending_days(change, name), "pending-days")
    parts = change.parts(name, days)
    if not parts:
        return {"days": 0, "rows": 0}
    rows = change.read(name, parts)
    priced = reprice(member_rows(rows, days, ["date_"])).withColumn("_action", F.lit("updated"))
    others = absent_rows(rows, days, ["date_"]).withColumn("_action", F.lit("kept"))
    counts = change.replace(name, priced.unionByName(others), parts, "_action")
    return {"days": days.count(), "rows": counts["updated"]}


def reprice_couriers_stored(
    change: Change, name: str, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, salts: int = 1
) -> dict[str, int]:
    """``courier_repriced`` for a stored table made with ``COURIER_FACTS``."""
    return _reprice_stored(change, name, lambda rows: courier_repriced(rows, tks, tariffs, prices, salts))


def reprice_pickers_stored(
    change: Change, name: str, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, salts: int = 1
) -> dict[str, int]:
    """``picker_repriced`` for a stored table made with ``PICKER_FACTS``."""
    return _reprice_stored(change, name, lambda rows: picker_repriced(rows, tks, tariffs, prices, salts))
