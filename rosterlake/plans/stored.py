"""Loads into a store: the rows of a delivery, the names it brings in and its run log become one version.

Each function takes a ``Change`` and what was delivered, and is meant to be run by ``Store.commit`` under the id of the
batch: run again, the batch finds itself in the store and changes nothing. Several may share a change.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rosterlake.operators.dictionary import keep_growth, last_id, start_dictionary
from rosterlake.operators.quality import AUDIT_COLUMNS, append_audit, log_counts
from rosterlake.operators.quarantine import hold_files
from rosterlake.operators.store import Change, Store
from rosterlake.operators.writes import add_absent, merge_rows, replace_covered
from rosterlake.plans import pay, preferences, reports as R
from rosterlake.plans.other_reports import load_hours, load_outputs, load_requests, load_revenues
from rosterlake.plans.shift_reports import COURIER_KEY, PICKER_KEY, ShiftLoad, load_couriers, load_pickers
from rosterlake.plans.slices import store_slice
from rosterlake.plans.tariffs import repeated_prices
from rosterlake.session import settle
from rosterlake.sources.landing import route

COURIERS, PICKERS, HOURS, REVENUES = "courier_shifts", "picker_shifts", "hours", "revenues"
REQUESTS, PREFERENCES, OUTPUTS = "requests", "preferences", "outputs"
#: Dictionaries: stores by name, organisations, stores by city and address.
TKS, ORGANISATIONS, ADDRESSES = "tks", "organisations", "addresses"
IDS = {TKS: "tk_id", ORGANISATIONS: "organisation_id", ADDRESSES: "tks_id"}
OUTPUT_KEY = ("horario_reparto_id",)


class Dimensions(NamedTuple):
    """Tables that loads look values up in and never change; see the loads for their columns."""

    users: DataFrame
    projects: DataFrame
    regions: DataFrame
    specialities: DataFrame


def start(change: Change, **dictionaries: DataFrame) -> None:
    """Store the dictionaries ``tks``, ``organisations`` and ``addresses`` as they are before the first load."""
    for name, rows in dictionaries.items():
        start_dictionary(change, name, rows, IDS[name])


# Log -----------------------------------------------------------------------------------------


def run_log(store: Store) -> DataFrame:
    """All rows of a store's run log."""
    return store.table("log")


def _file_events(rows: DataFrame, source: str) -> DataFrame:
    """An event per delivered file that tells its rows; one that tells of no new rows if there is no file."""
    counts = rows.groupBy("filename").agg(F.count("*").alias("n"))
    found = counts.select(
        F.lit("event").alias("event_type"), F.lit(source).alias("event_source"),
        F.format_string("%s: %d rows", "filename", "n").alias("description"),
    )
    total = rows.limit(1).agg(F.count("*").alias("n")).filter("n = 0")
    nothing = total.select(
        F.lit("event").alias("event_type"), F.lit(source).alias("event_source"), F.lit("nothing new").alias("description")
    )
    return found.unionByName(nothing)


def _problem_rows(problems: DataFrame, source: str) -> DataFrame:
    return problems.select(
        F.lit("warning").alias("event_type"), F.lit(source).alias("event_source"),
        F.format_string("%s: %s '%s' (%d)", "file", "problem", "value", "found").alias("description"),
    )


def _unmatched_rows(shifts: DataFrame, source: str) -> DataFrame:
    """A warning per day, region and speciality that no tariff holds for."""
    found = shifts.groupBy("date_", "region_id", "speciality_id").agg(F.count("*").alias("n"))
    return found.select(
        F.lit("warning").alias("event_type"), F.lit(source).alias("event_source"),
        F.format_string("no tariff for region %s, speciality %s on %s: %d shifts", "region_id", "speciality_id",
                        F.col("date_").cast("string"), "n").alias("description"),
    )


# Dictionaries --------------------------------------------------------------------------------


def _grow(change: Change, name: str, before: DataFrame, after: DataFrame) -> None:
    added = keep_growth(change, name, IDS[name], before, after)
    if added:
        log_counts(change, "dictionaries", {f"{name}: new names": added})


def _above(change: Change, *names: str) -> dict[str, int]:
    return {IDS[n]: last_id(change, n) for n in names}


# Shifts --------------------------------------------------------------------------------------


def _merge_shifts(
    change: Change, chunks: DataFrame, name: str, loader: Callable[..., ShiftLoad], key: tuple[str, ...],
    pay_columns: list[str], facts: dict, source: str,
) -> dict[str, int]:
    tks, organisations = change.read(TKS), change.read(ORGANISATIONS)
    load = loader(chunks, tks, organisations, _above(change, TKS, ORGANISATIONS))
    _grow(change, TKS, tks, load.tks)
    _grow(change, ORGANISATIONS, organisations, load.organisations)
    given = [f for f in load.rows.schema if f.name != "row_no"]
    change.create(name, StructType([*given, *[StructField(c, DoubleType()) for c in pay_columns]]), pay.MONTHS, facts)
    changed = [f.name for f in given if f.name not in key]
    counts = merge_rows(change, name, load.rows, key, changed, ("file_date", "filename", "row_no"))
    log_counts(change, source, counts)
    append_audit(change, load.warnings)
    return counts


def merge_couriers(change: Change, chunks: DataFrame, name: str = COURIERS) -> dict[str, int]:
    """Upsert courier shifts; payments stay as they are. The log gets the rows per action, new names, and zero codes."""
    return _merge_shifts(change, chunks, name, load_couriers, COURIER_KEY, pay.COURIER_PAY, pay.COURIER_FACTS, "couriers")


def merge_pickers(change: Change, chunks: DataFrame, name: str = PICKERS) -> dict[str, int]:
    """Upsert picker shifts, in the same way."""
    return _merge_shifts(change, chunks, name, load_pickers, PICKER_KEY, pay.PICKER_PAY, pay.PICKER_FACTS, "pickers")


def price_couriers(
    change: Change, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, name: str = COURIERS, salts: int = 1
) -> dict[str, int]:
    """Price the pending courier shifts; the log gets the days and rows written, shifts without a tariff, and fields priced twice."""
    return _priced(change, tks, tariffs, prices, name, "courier pay", pay.reprice_couriers_stored, pay.courier_unmatched, pay.COURIER_FIELDS, salts)


def price_pickers(
    change: Change, tks: DataFrame, tariffs: DataFrame, prices: DataFrame, name: str = PICKERS, salts: int = 1
) -> dict[str, int]:
    """Price the pending picker shifts, in the same way."""
    return _priced(change, tks, tariffs, prices, name, "picker pay", pay.reprice_pickers_stored, pay.picker_unmatched, pay.PICKER_FIELDS, salts)


def _priced(change, tks, tariffs, prices, name, source, reprice, unmatched, fields, salts) -> dict[str, int]:
    days = settle(pay.pending_days(change, name), "days")
    rows = change.read(name, change.parts(name, days))  # as they are before they are priced
    counts = reprice(change, name, tks, tariffs, prices, salts)
    log_counts(change, source, counts, "nothing pending")
    twice = repeated_prices(prices, fields).select(
        F.lit("warning").alias("event_type"), F.lit(source).alias("event_source"),
        F.format_string("tariff %s has %d prices of field %s", "tariff_id", "rows_found", "field_id").alias("description"))
    append_audit(change, _unmatched_rows(unmatched(rows, tks, tariffs), source).unionByName(twice))
    return counts


# Other reports -------------------------------------------------------------------------------


def replace_hours(change: Change, chunks: DataFrame, regions: DataFrame, name: str = HOURS) -> int:
    """Replace the covered dates of stored hours; the log gets an event per file, zero codes, and what could not be read."""
    addresses = change.read(ADDRESSES)
    load = load_hours(chunks, regions, addresses, last_id(change, ADDRESSES))
    _grow(change, ADDRESSES, addresses, load.tks)
    rows = settle(load.rows, "hours")
    change.create(name, rows.schema, "date_format(report_date, 'yyyy-MM')")
    added = replace_covered(change, name, rows, load.dates, "report_date")
    append_audit(change, _file_events(rows, "hours").unionByName(load.warnings).unionByName(_problem_rows(load.problems, "hours")))
    return added


def append_revenues(change: Change, chunks: DataFrame, dims: Dimensions, strict: bool = False, name: str = REVENUES) -> int:
    """Append revenue rows; the log gets an event per file and what was missing or unknown.

    If ``strict``, a file with an empty required cell is held back whole until it is delivered without one.
    """
    load = load_revenues(chunks, *dims)
    rows = load.rows
    if strict:
        rows, held, corrected = hold_files(change, name, load.judged)
        log_counts(change, "revenues", {"held back": held, "held rows corrected": corrected}, "nothing held back")
    rows = settle(rows, "revenues")
    change.create(name, rows.schema, "date_format(date, 'yyyy-MM')")
    added = change.append(name, rows)
    append_audit(change, _file_events(rows, "revenues").unionByName(load.audit.select(*AUDIT_COLUMNS)))
    return added


def append_requests(change: Change, chunks: DataFrame, name: str = REQUESTS) -> int:
    """Append staffing requests; the log gets an event per file, new names, zero codes, and what could not be read."""
    tks = change.read(TKS)
    load = load_requests(chunks, tks, last_id(change, TKS))
    _grow(change, TKS, tks, load.tks)
    rows = settle(load.rows, "requests")
    change.create(name, rows.schema, "date_format(requested_date, 'yyyy-MM')")
    added = change.append(name, rows)
    append_audit(change, _file_events(rows, "requests").unionByName(load.warnings).unionByName(
        _problem_rows(load.problems, "requests")))
    return added


def merge_preferences(change: Change, chunks: DataFrame, name: str = PREFERENCES) -> dict[str, int]:
    """Apply all deliveries of shift preferences in date order; the log gets the rows per action and empty keys per file."""
    rows = settle(preferences.preference_rows(chunks), "preferences")
    given = StructType([f for f in rows.schema if f.name not in ("file", "row_no")])
    change.create(name, given.add("preferred_date", "date"), preferences.DAYS)
    counts = preferences.store_deliveries(change, name, rows)
    log_counts(change, "preferences", counts)
    append_audit(change, preferences.key_warnings(rows))
    return counts


def merge_outputs(change: Change, chunks: DataFrame, name: str = OUTPUTS) -> dict[str, int]:
    """Upsert shift outputs; a shift that moved to another date moves. The log gets the rows per action and empty keys per file."""
    load = load_outputs(chunks)
    given = StructType([f for f in load.rows.schema if f.name != "row_no"])
    change.create(name, given, "date_format(schedule_date, 'yyyy-MM')")
    changed = [f.name for f in given if f.name not in OUTPUT_KEY]
    counts = merge_rows(
        change, name, load.rows, OUTPUT_KEY, changed, ("fix_date", "filename", "row_no"), anywhere=True)
    log_counts(change, "outputs", counts)
    append_audit(change, load.warnings)
    return counts


#: Kinds of a chunk by its workbook's first header and by its own.
KINDS = ("_book_kind", "_own_kind")
#: What a load reads: the column of ``KINDS`` its sheets are known by, and the values.
_READ = {
    COURIERS: (KINDS[0], ("couriers", "pickers")), PICKERS: (KINDS[0], ("couriers", "pickers")), HOURS: (KINDS[0], ("hours",)),
    REVENUES: (KINDS[0], ("revenues",)), REQUESTS: (KINDS[0], ("requests",)), PREFERENCES: (KINDS[1], ("preferences",)),
    OUTPUTS: (KINDS[0], ("outputs",)),
}


def with_kinds(chunks: DataFrame) -> DataFrame:
    """Chunks with ``KINDS``; a batch written apart by them is read by each load only where its reports are."""
    return route(route(chunks, R.SIGNATURES, "book_headers", KINDS[0]), R.SIGNATURES, "headers", KINDS[1])


def load_reports(change: Change, chunks: DataFrame, dims: Dimensions) -> dict[str, dict[str, int] | int]:
    """Everything a delivery of workbooks may hold, in one version: all kinds of reports, or none if one fails."""
    loads = {
        COURIERS: merge_couriers, PICKERS: merge_pickers, HOURS: partial(replace_hours, regions=dims.regions),
        REVENUES: partial(append_revenues, dims=dims), REQUESTS: append_requests, PREFERENCES: merge_preferences,
        OUTPUTS: merge_outputs,
    }
    known = chunks if set(KINDS) <= set(chunks.columns) else with_kinds(chunks)

    def of(name: str) -> DataFrame:
        column, kinds = _READ[name]
        return known.filter(F.col(column).isin(list(kinds))).drop(*KINDS)

    return {name: load(change, of(name)) for name, load in loads.items()}


# Vacancies and slices ------------------------------------------------------------------------


def add_vacancies(change: Change, found: DataFrame, name: str, null_safe: bool = False) -> int:
    """Append the vacancies a store does not have; the log gets their number. See ``add_absent``."""
    change.create(name, found.schema)
    added = add_absent(change, name, found, found.columns, null_safe)
    log_counts(change, name, {"inserted": added})
    return added


def add_slice(change: Change, rows: DataFrame, as_of: date, name: str) -> int:
    """Store a daily slice; the log gets the number of its rows."""
    stored = store_slice(change, name, rows, as_of)
    told = [("event", name, f"{stored} rows of the day before {as_of}")]
    append_audit(change, change.spark.createDataFrame(told, "event_type string, event_source string, description string"))
    return stored
