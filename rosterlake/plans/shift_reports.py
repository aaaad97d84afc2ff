"""Courier and picker shift reports: one workbook holds one kind per sheet."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.functions import coerce_numeric, first_integer, parse_date, parse_timestamp, prefix_code
from rosterlake.operators.clean import fill_activation
from rosterlake.operators.dictionary import dict_grow
from rosterlake.operators.joins import dim_join
from rosterlake.operators.mapping import map_codes
from rosterlake.operators.quality import quality_counts, warnings
from rosterlake.operators.writes import upsert
from rosterlake.plans import reports as R
from rosterlake.session import settle
from rosterlake.sources.landing import landing_metadata, route
from rosterlake.sources.workbook import named_cells, sheet_rows

SHIFT_HEADERS = {"couriers": R.COURIER_HEADER, "pickers": R.PICKER_HEADER}
OTHER_KIND = {"couriers": "pickers", "pickers": "couriers"}

# Column of the shift table: header of the report.
COURIER_CELLS = {
    "courier_id": "КПП Курьера", "employee_id": "employee_id", "tk_name": "ТК", "division": "Дивизион",
    "date_": "Дата", "transport": "Транспорт", "courier_name": "Имя Курьера",
    "organisation_name": "Организация", "active_time_hours": "Активное время, часов",
    "first_activation": "Первое включение", "last_deactivation": "Последнее выключение",
    "orders_delivered": "Заказов доставлено", "daily_distance": "Пробег за день, км",
    "orders_over_twenty_kg": "Заказов больше 20 кг", "orders_twenty_forty_kg": "Заказов 20-40 кг",
    "orders_over_forty_kg": "Заказов больше 40 кг", "SLA_delivery": "SLA, доставка",
}
PICKER_CELLS = {
    "picker_id": "КПП Комплектовщика", "employee_id": "employee_id", "tk_name": "ТК",
    "division": "Дивизион", "date_": "Дата", "picker_name": "Имя комплектовщика",
    "organisation_name": "Организация", "active_time_hours": "Активное время, часов",
    "first_activation": "Первое включение", "last_deactivation": "Последнее выключение",
    "orders_picked": "Заказов собрано", "ordered_units": "Заказано штук", "picked_units": "Собрано штук",
    "ordered_SKU": "Заказано SKU", "picked_SKU": "Собрано SKU", "changed_SKU": "Заменено SKU",
    "pick_fullness": "Полнота сборки", "SLA_reaction": "SLA, реакция", "SLA_pick": "SLA, сборка",
}
COURIER_AMOUNTS = (
    "active_time_hours", "orders_delivered", "daily_distance", "orders_over_twenty_kg",
    "orders_twenty_forty_kg", "orders_over_forty_kg", "SLA_delivery",
)
PICKER_AMOUNTS = (
    "active_time_hours", "orders_picked", "ordered_units", "picked_units", "ordered_SKU", "picked_SKU",
    "changed_SKU", "pick_fullness", "SLA_reaction", "SLA_pick",
)
ROUNDED = ("SLA_reaction", "SLA_pick")
COURIER_COLUMNS = (
    "courier_id", "employee_id", "tk_id", "division_id", "date_", "transport_id", "courier_name",
    "organisation_id", *COURIER_AMOUNTS[:1], "first_activation", "last_deactivation",
    *COURIER_AMOUNTS[1:], "filename", "file_date",
)
PICKER_COLUMNS = (
    "picker_id", "employee_id", "tk_id", "division_id", "date_", "picker_name", "organisation_id",
    *PICKER_AMOUNTS[:1], "first_activation", "last_deactivation", *PICKER_AMOUNTS[1:],
    "filename", "file_date",
)
COURIER_KEY = ("courier_id", "employee_id", "date_")
PICKER_KEY = ("picker_id", "employee_id", "date_")


class ShiftLoad(NamedTuple):
    rows: DataFrame
    tks: DataFrame
    organisations: DataFrame
    warnings: DataFrame


def shift_rows(chunks: DataFrame, kind: str, cells: Mapping[str, str]) -> DataFrame:
    """Rows of one kind: from first sheets of that kind and second sheets of books of the other."""
    first = route(chunks, R.SIGNATURES, "book_headers", "book_kind")
    wanted = F.when(F.col("sheet") == 0, F.lit(kind)).when(F.col("sheet") == 1, F.lit(OTHER_KIND[kind]))
    rows = sheet_rows(first.filter(F.col("book_kind") == wanted))
    picked = rows.select("file", "row_no", *named_cells(SHIFT_HEADERS[kind], cells))
    return landing_metadata(picked, "file").drop("sender")


def _clean(rows: DataFrame, amounts: tuple[str, ...], extra: Mapping[str, Column]) -> DataFrame:
    values = {}
    for name in amounts:
        amount = F.coalesce(coerce_numeric(F.col(name)), F.lit(0.0))
        values[name] = F.round(amount, 4) if name in ROUNDED else amount
    typed = rows.withColumns(
        {
            **values,
            "tk_name": prefix_code(F.col("tk_name"), R.STORE_PREFIX),
            "employee_id": first_integer(F.col("employee_id")),
            "date_": parse_date(F.col("date_"), R.DATES),
            "first_activation": parse_timestamp(F.col("first_activation"), R.TIMES),
            "last_deactivation": parse_timestamp(F.col("last_deactivation"), R.TIMES),
            "division_id": map_codes(F.col("division"), R.DIVISIONS, 0, R.NO_DIVISION),
            **extra,
        }
    )
    filled = fill_activation(typed, "first_activation", "last_deactivation", "active_time_hours", "date_")
    # decoded and typed once; the dictionaries and checks then read single columns
    return settle(filled, "shifts")


def _load(
    rows: DataFrame, tks: DataFrame, organisations: DataFrame, columns: tuple[str, ...], codes: tuple[str, ...],
    above: Mapping[str, int],
) -> ShiftLoad:
    tks = dict_grow(tks, "tk_id", rows, {"tk_name": "tk_name"}, above.get("tk_id", 0))
    organisations = dict_grow(
        organisations, "organisation_id", rows, {"organisation_name": "organisation_name"}, above.get("organisation_id", 0)
    )
    # names may be missing in both the report and the dictionary, and then belong together
    keyed = dim_join(rows, tks.select("tk_id", "tk_name"), {"tk_name": "tk_name"}, null_safe=True)
    keyed = dim_join(
        keyed, organisations.select("organisation_id", "organisation_name"),
        {"organisation_name": "organisation_name"}, null_safe=True,
    )
    counts = quality_counts(rows, {c: F.col(c) == 0 for c in codes})
    text = F.format_string("%s is 0 in %d rows", F.col("check_name"), F.col("bad_rows"))
    return ShiftLoad(
        keyed.select("row_no", *columns), tks, organisations, warnings(counts, "shift_reports", text)
    )


def load_couriers(
    chunks: DataFrame, tks: DataFrame, organisations: DataFrame, above: Mapping[str, int] = MappingProxyType({})
) -> ShiftLoad:
    """Courier shifts; new names get ids greater than ``above`` by id column."""
    rows = shift_rows(chunks, "couriers", COURIER_CELLS)
    clean = _clean(rows, COURIER_AMOUNTS, {"transport_id": map_codes(F.col("transport"), R.TRANSPORTS)})
    return _load(clean, tks, organisations, COURIER_COLUMNS, ("transport_id", "division_id"), above)


def load_pickers(
    chunks: DataFrame, tks: DataFrame, organisations: DataFrame, above: Mapping[str, int] = MappingProxyType({})
) -> ShiftLoad:
    """Picker shifts, in the same way."""
    rows = shift_rows(chunks, "pickers", PICKER_CELLS)
    return _load(_clean(rows, PICKER_AMOUNTS, {}), tks, organisations, PICKER_COLUMNS, ("division_id",), above)


def apply_shifts(table: DataFrame, load: ShiftLoad, key: tuple[str, ...], action: str | None = None) -> DataFrame:
    """Next state of the shift table; the latest delivery, then the later row, wins.

    Payments and other columns the report does not carry stay as they are.
    """
    changed = [c for c in load.rows.columns if c not in (*key, "row_no")]
    return upsert(table, load.rows, key, changed, ("file_date", "filename", "row_no"), action=action)
