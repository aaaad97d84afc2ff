"""Hours, revenue, staffing request and shift output reports."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.functions import coerce_integer, coerce_numeric, parse_date, prefix_code, strip
from rosterlake.operators.dictionary import dict_grow
from rosterlake.operators.joins import dim_join, lookup_chain, lookup_default, member_rows
from rosterlake.operators.mapping import map_codes
from rosterlake.operators.quality import audit_row, empty_load_warning, null_columns, quality_counts, warnings
from rosterlake.operators.quarantine import REASONS, reasons
from rosterlake.operators.reshape import dated_columns, unpivot_cells
from rosterlake.operators.writes import replace_dates, upsert
from rosterlake.plans import reports as R
from rosterlake.session import settle
from rosterlake.sources.landing import column_range, landing_metadata, route
from rosterlake.sources.workbook import cell_at, named_cells, sheet_rows, trim_sheet


def _of_kind(chunks: DataFrame, kind: str) -> DataFrame:
    return route(chunks, R.SIGNATURES, "book_headers").filter(F.col("kind") == kind)


# Hours ---------------------------------------------------------------------------------------


class HoursLoad(NamedTuple):
    """``problems``: headers that are no dates and cells that are no numbers, as ``file, problem, value, found``."""

    rows: DataFrame
    dates: DataFrame
    tks: DataFrame
    warnings: DataFrame
    problems: DataFrame


def unread_headers(chunks: DataFrame, headers: Column) -> DataFrame:
    """Headers of date columns that no format reads, one row per file and header."""
    bad = F.filter(headers, lambda h: parse_date(h, R.DATES).isNull())
    # outer, for the reason given in ``load_hours``
    found = F.explode_outer(F.transform(bad, lambda h: F.struct(h.alias("value")))).alias("_found")
    listed = chunks.select("file", found).filter("_found IS NOT NULL").select("file", "_found.value")
    return listed.groupBy("file", "value").agg(F.lit(1).cast("bigint").alias("found")).select(
        "file", F.lit("unread date header").alias("problem"), "value", "found"
    )


def unread_cells(rows: DataFrame, problem: str) -> DataFrame:
    """Texts in dated cells that are no numbers, counted per file and text."""
    cells = rows.select("file", "cells", F.explode("days.at").alias("_at"))
    texts = cells.select("file", F.get(F.col("cells"), F.col("_at")).alias("value")).filter(
        F.col("value").isNotNull() & coerce_numeric(F.col("value")).isNull()
    )
    return texts.groupBy("file", "value").agg(F.count("*").alias("found")).select(
        "file", F.lit(problem).alias("problem"), "value", "found"
    )


def load_hours(chunks: DataFrame, regions: DataFrame, tks: DataFrame, above: int = 0) -> HoursLoad:
    """Worked hours from reports with a column per date; zero hours are left out.

    Of several deliveries that cover a date only the last one counts for it, also where its hours are zero.
    ``regions`` has ``id, legal_name``; ``tks`` has ``tks_id, city_id, address``; new ones get ids greater than ``above``.
    """
    first = _of_kind(chunks, "hours").filter("sheet = 0")
    dated = trim_sheet(first).withColumn("days", dated_columns(F.col("headers"), R.DATES))
    cells = {"address": "Подразделение", "doer_name": "Исполнитель", "role": "Роль", "doer_id": "ID",
             "city": "Город"}
    rows = sheet_rows(dated, "days").select(
        "file", "row_no", "days", "cells", *named_cells(R.HOURS_HEADER, cells)
    )
    rows = rows.withColumns(
        {
            "city": strip(F.col("city")),
            "doer_id": coerce_integer(F.col("doer_id")),
            "speciality_id": map_codes(F.col("role"), R.ROLES),
        }
    )
    city = regions.select(F.col("id").alias("city_id"), F.col("legal_name").alias("_legal"))
    rows = settle(dim_join(rows, city, {"city": "_legal"}, "left"), "hours")
    keys = {"city_id": "city_id", "address": "address"}
    tks = dict_grow(tks, "tks_id", rows, keys, above)
    rows = dim_join(rows, tks, keys, "left", null_safe=True)
    rows = landing_metadata(rows, "file")
    kept = ("doer_name", "doer_id", "tks_id", "speciality_id", "file_date", "filename")
    # outer: of a plain explode Spark makes a filter on the parsed headers, which it may move below the grouping that
    # made the chunks and so repeat for every row
    listed = dated.select("file", F.explode_outer("days.day").alias("report_date")).filter("report_date IS NOT NULL")
    covered = landing_metadata(listed, "file")
    last = covered.groupBy("report_date").agg(F.max(F.struct("file_date", "filename", "file")).alias("_last"))
    last = settle(last.select("report_date", F.col("_last.file").alias("file")), "covered")
    hours = unpivot_cells(rows, ("file", *kept), "report_date", "worked_hours").filter("worked_hours <> 0")
    hours = member_rows(hours, last, ["report_date", "file"]).select(*kept, "report_date", "worked_hours")
    counts = quality_counts(rows, {"speciality_id": F.col("speciality_id") == 0})
    text = F.format_string("%s is 0 in %d rows", F.col("check_name"), F.col("bad_rows"))
    # between the last named column and the total all columns are dates
    shown = F.slice("headers", len(R.HOURS_HEADER) + 1, F.greatest(F.size("headers") - len(R.HOURS_HEADER) - 1, F.lit(0)))
    problems = unread_headers(first, shown).unionByName(unread_cells(rows, "hours are no number"))
    return HoursLoad(hours, last.select("report_date"), tks, warnings(counts, "hours", text), problems)


def apply_hours(table: DataFrame, load: HoursLoad) -> DataFrame:
    """Next state of the hours table: every date the reports cover is replaced."""
    return replace_dates(table, load.rows, "report_date", load.dates)


# Revenues ------------------------------------------------------------------------------------

REVENUE_CELLS = {
    "doer_id": "ID", "date": "Дата", "amount": "Сумма Выручки", "article_id": "Статья",
    "project": "Проект", "region": "Регион", "speciality": "Специальность", "notes": "Заметка",
}
REVENUE_COLUMNS = (
    "doer_id", "date", "amount", "article_id", "created_by", "project_id", "region_id", "speciality_id",
    "notes", "file_date", "filename",
)


class RevenueLoad(NamedTuple):
    """``judged``: the rows with ``reasons``, the required columns that are empty."""

    rows: DataFrame
    audit: DataFrame
    judged: DataFrame


def load_revenues(
    chunks: DataFrame,
    users: DataFrame,
    projects: DataFrame,
    regions: DataFrame,
    specialities: DataFrame,
    strict: bool = False,
) -> RevenueLoad:
    """Revenue rows with names turned into ids; a name without an id stays null.

    Missing values in required columns are reported and loaded all the same, unless ``strict``,
    which rejects such rows. ``users`` has ``id, email``; the others ``id`` and ``name``
    (regions: ``legal_name``).
    """
    rows = sheet_rows(_of_kind(chunks, "revenues").filter("sheet = 0"))
    rows = rows.select("file", *named_cells(R.REVENUE_HEADER, REVENUE_CELLS))
    rows = settle(rows.fillna({"doer_id": "0", "notes": ""}), "revenues")
    required = [c for c in REVENUE_CELLS if c not in ("doer_id", "notes")]
    missing = null_columns(rows.select(*required))
    if strict:
        rows = rows.dropna(subset=required)
    empty = reasons({c: F.col(c).isNull() for c in required})
    rows = landing_metadata(rows.withColumn(REASONS, empty), "file")

    author = users.select(F.col("id").alias("created_by"), F.col("email").alias("_email"))
    rows = lookup_default(rows, author, {"sender": "_email"}, "created_by", 0, "_unknown")
    rows = lookup_chain(
        rows,
        [
            (projects.select(F.col("id").alias("project_id"), F.col("name").alias("_p")), {"project": "_p"}),
            (regions.select(F.col("id").alias("region_id"), F.col("legal_name").alias("_r")), {"region": "_r"}),
            (
                specialities.select(F.col("id").alias("speciality_id"), F.col("name").alias("_s")),
                {"speciality": "_s"},
            ),
        ],
    )
    unknown = rows.filter("_unknown").select("sender").distinct()
    audit = audit_row(
        missing, "error", "revenues",
        F.format_string("column %s has empty cells", F.col("column_name")),
    ).unionByName(
        audit_row(
            unknown, "warning", "revenues",
            F.format_string("sender '%s' has no user id, 0 is stored", F.col("sender")),
        )
    )
    typed = rows.withColumns(
        {
            "doer_id": coerce_integer(F.col("doer_id")),
            "date": parse_date(F.col("date"), R.DATES),
            "amount": coerce_numeric(F.col("amount")),
        }
    )
    return RevenueLoad(typed.select(*REVENUE_COLUMNS), audit, typed.select(*REVENUE_COLUMNS, REASONS))


# Staffing requests ---------------------------------------------------------------------------


class RequestLoad(NamedTuple):
    """``problems`` as in ``HoursLoad``."""

    rows: DataFrame
    tks: DataFrame
    warnings: DataFrame
    problems: DataFrame


def load_requests(chunks: DataFrame, tks: DataFrame, above: int = 0) -> RequestLoad:
    """Requested head counts per store, resource and date; both sheets, nulls kept.

    The dates are those of the first sheet, between the resource and the night column. A date the
    second sheet lacks is null there. The second sheet leaves its first header empty.
    """
    both = _of_kind(chunks, "requests").filter("sheet < 2")
    headers = F.col("headers")

    def at(name: str) -> Column:
        return F.array_position(headers, name).cast("int") - 1

    store = F.when(F.col("sheet") == 0, at("ТК")).otherwise(
        F.when(F.get(headers, F.lit(0)) == "Unnamed: 0", F.lit(0)).otherwise(at("ТК"))
    )
    names = F.transform(
        column_range(F.col("book_headers"), "Тип ресурса", "Ночь"),
        lambda p: F.get(F.col("book_headers"), p.cast("int") - 1),
    )
    days = F.filter(
        F.transform(
            F.filter(names, lambda h: ~F.contains(h, F.lit("Unnamed:"))),
            lambda h: F.struct(
                parse_date(h, R.DATES).alias("day"), (F.array_position(headers, h).cast("int") - 1).alias("at")
            ),
        ),
        lambda d: d["day"].isNotNull(),
    )
    places = both.withColumns(
        {"days": days, "_tk": store, "_type": at("Тип ресурса"), "_night": at("Ночь"), "_more": at("Доп потребность")}
    )
    rows = sheet_rows(places, "days", "_tk", "_type", "_night", "_more")
    typed = rows.withColumns(
        {
            "tk_name": prefix_code(cell_at(F.col("_tk")), R.STORE_PREFIX),
            "resource_id": map_codes(cell_at(F.col("_type")), R.RESOURCES),
            "is_night": cell_at(F.col("_night")),
            "add_requirement": cell_at(F.col("_more")),
        }
    )
    rows = settle(typed.drop("_tk", "_type", "_night", "_more"), "requests")
    tks = dict_grow(tks, "tk_id", rows, {"tk_name": "tk_name"}, above)
    rows = dim_join(rows, tks.select("tk_id", "tk_name"), {"tk_name": "tk_name"}, "left", null_safe=True)
    rows = landing_metadata(rows, "file")
    kept = ("tk_id", "resource_id", "is_night", "add_requirement", "file_date", "filename")
    counts = quality_counts(rows, {"resource_id": F.col("resource_id") == 0})
    text = F.format_string("%s is 0 in %d rows", F.col("check_name"), F.col("bad_rows"))
    named = both.filter("sheet = 0").withColumn("_names", F.filter(names, lambda h: ~F.contains(h, F.lit("Unnamed:"))))
    problems = unread_headers(named, F.col("_names")).unionByName(unread_cells(rows, "head count is no number"))
    return RequestLoad(
        unpivot_cells(rows, kept, "requested_date", "doer_count"), tks, warnings(counts, "requests", text), problems
    )


# Shift outputs -------------------------------------------------------------------------------


class OutputLoad(NamedTuple):
    rows: DataFrame
    warnings: DataFrame


def load_outputs(chunks: DataFrame) -> OutputLoad:
    rows = sheet_rows(_of_kind(chunks, "outputs").filter("sheet = 0"))
    rows = rows.select("file", "row_no", *named_cells(R.OUTPUT_HEADER, {h: h for h in R.OUTPUT_HEADER}))
    rows = landing_metadata(rows, "file").withColumnRenamed("file_date", "fix_date")
    rows = rows.withColumn("schedule_date", parse_date(F.col("schedule_date"), R.DATES))
    rows = settle(rows.select("row_no", *R.OUTPUT_HEADER, "filename", "fix_date"), "outputs")
    counts = quality_counts(
        rows, {"city": F.col("city").isNull(), "courier_un_id": F.col("courier_un_id").isNull()}, ["filename"]
    )
    text = F.format_string("%s: %s is empty in %d rows", F.col("filename"), F.col("check_name"), F.col("bad_rows"))
    found = warnings(counts, "outputs", text).unionByName(
        empty_load_warning(rows, "outputs", "the files hold no shift")
    )
    return OutputLoad(rows, found)


def apply_outputs(table: DataFrame, load: OutputLoad, key: Sequence[str], action: str | None = None) -> DataFrame:
    changed = [c for c in load.rows.columns if c not in (*key, "row_no")]
    return upsert(table, load.rows, key, changed, ("fix_date", "filename", "row_no"), action=action)
