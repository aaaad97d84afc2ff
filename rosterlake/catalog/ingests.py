"""Report and vacancy ingests over deliveries that Spark builds from the given tables.

Chunks are built per file of a fixed number of keys, so that no group grows with the data.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.catalog.base import Tables, query, with_fx
from rosterlake.catalog.cleaning import HEADS, TAILS, _sql_texts, rules_sql
from rosterlake.catalog.scans import api_pages
from rosterlake.plans import reports as R
from rosterlake.plans.other_reports import (
    apply_hours, apply_outputs, load_hours, load_outputs, load_requests, load_revenues,
)
from rosterlake.plans.preferences import apply_template, preference_rows, split_template
from rosterlake.plans.shift_reports import COURIER_KEY, apply_shifts, load_couriers, load_pickers
from rosterlake.plans.stored import Dimensions
from rosterlake.plans.vacancies import (
    API_COLUMNS, API_RULES, WEB_COLUMNS, WEB_RULES, api_vacancies, new_vacancies, web_vacancies,
)
from rosterlake.session import settle

SENDER = "ops@mail.example"


def landing_name(original: Column, day: Column, sender: Column) -> Column:
    prefix = F.concat(F.lit("."), day.cast("string"), F.lit("."), sender, F.lit("."))
    return F.concat((F.length(prefix) + 2).cast("string"), prefix, original)


def file_day(book: str) -> Column:
    return F.date_add(F.lit("2022-06-01").cast("date"), F.expr(f"CAST({book} % 20 AS INT)"))


def cells_of(header: tuple[str, ...], values: dict[str, str]) -> Column:
    """Cell array in header order from SQL expressions; columns not given stay empty."""
    cells = [F.expr(f"CAST({values[h]} AS STRING)") if h in values else F.lit(None).cast("string") for h in header]
    return F.array(*cells)


def chunks(
    rows: DataFrame, key: str, file: Column, sheet: Column, headers: Column, cells: Column,
    book_headers: Column | None = None,
) -> DataFrame:
    """Sheet chunks, one per ``book`` and sheet, rows ordered by ``key``.

    Cells come from the row; the file name and the headers only depend on ``book`` and ``sheet``.
    """
    row = F.struct(F.col(key).alias("key"), cells.alias("cells"))
    sheets = rows.select("book", sheet.cast("int").alias("sheet"), row.alias("row"))
    grouped = sheets.groupBy("book", "sheet").agg(F.array_sort(F.collect_list("row"))["cells"].alias("rows"))
    return grouped.select(
        file.alias("file"), "sheet", (headers if book_headers is None else book_headers).alias("book_headers"),
        headers.alias("headers"), F.lit(1).alias("first_row"), F.lit(True).alias("is_last"), "rows",
    )


def texts(values) -> Column:
    return F.array(*map(F.lit, values))


# Shift reports -------------------------------------------------------------------------------

DIVISION_LABELS = (*R.DIVISIONS, "Другой")
TRANSPORT_LABELS = (*R.TRANSPORTS, "Лыжи")


def _labels(values, key: str) -> str:
    """Expression picking a label by key; null once in a while."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"CASE WHEN {key} % 17 <> 0 THEN get(array({listed}), CAST({key} % {len(values)} AS INT)) END"


def _labels_sql(values, key: str) -> str:
    return f"CASE WHEN {key} % 17 <> 0 THEN {_sql_texts(values)}[{key} % {len(values)} + 1] END"


def courier_chunks(t: Tables) -> DataFrame:
    """Courier sheets: first in even books, second in odd books that open with pickers."""
    values = {
        "КПП Курьера": "concat('K', o_custkey)",
        "employee_id": "CASE WHEN o_custkey % 7 <> 0 THEN concat('emp-', o_custkey % 50) END",
        "ТК": "CASE WHEN o_custkey % 2 = 0 THEN concat('ТК', o_custkey % 40) ELSE CAST(o_custkey % 40 AS STRING) END",
        "Дивизион": _labels(DIVISION_LABELS, "o_orderkey"),
        "Дата": "date_format(o_orderdate, 'yyyy/MM/dd')",
        "Транспорт": _labels(TRANSPORT_LABELS, "o_orderkey"),
        "Имя Курьера": "concat('Name ', o_custkey)",
        "Организация": "CASE WHEN o_custkey % 13 <> 0 THEN concat('Org ', o_custkey % 12) END",
        "Активное время, часов": "CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 14 END",
        "Первое включение": "CASE WHEN o_orderkey % 3 <> 0 THEN date_format(o_orderdate, 'yyyy-MM-dd 09:30:00') END",
        "Последнее выключение": "CASE WHEN o_orderkey % 4 <> 0 THEN date_format(o_orderdate, 'yyyy-MM-dd 18:00:00') END",
        "Заказов доставлено": "o_custkey % 20",
        "SLA, доставка": "CASE WHEN o_orderkey % 5 <> 0 THEN '0.5' ELSE 'n/a' END",
    }
    rows = t.orders.withColumn("book", F.expr("o_orderkey div 250"))
    even = F.col("book") % 2 == 0
    name = landing_name(F.concat(F.lit("shifts-"), "book", F.lit(".xlsx")), file_day("book"), F.lit(SENDER))
    return chunks(
        rows, "o_orderkey", name, F.when(even, 0).otherwise(1), texts(R.COURIER_HEADER),
        cells_of(R.COURIER_HEADER, values), F.when(even, texts(R.COURIER_HEADER)).otherwise(texts(R.PICKER_HEADER)),
    )


_STORES = "SELECT CAST(n_nationkey AS BIGINT) AS tk_id, 'ТК' || n_nationkey AS tk_name FROM nation"
_ORGS = "SELECT s_suppkey AS organisation_id, 'Org ' || s_suppkey AS organisation_name FROM supplier WHERE s_suppkey < 6"


def stores_and_organisations(t: Tables) -> tuple[DataFrame, DataFrame]:
    stores = t.nation.selectExpr("CAST(n_nationkey AS BIGINT) AS tk_id", "concat('ТК', n_nationkey) AS tk_name")
    organisations = t.supplier.filter("s_suppkey < 6").selectExpr(
        "s_suppkey AS organisation_id", "concat('Org ', s_suppkey) AS organisation_name"
    )
    return stores, organisations


def _grown(dim: str, id_: str, name: str, report: str) -> str:
    return (
        f"SELECT {id_}, {name} FROM {dim} UNION ALL SELECT (SELECT MAX({id_}) FROM {dim}) + "
        f"row_number() OVER (ORDER BY {name} NULLS FIRST), {name} FROM (SELECT {name} FROM {report} "
        f"EXCEPT SELECT {name} FROM {dim})"
    )


def _code_sql(column: str, codes: dict, null_code: int) -> str:
    tests = " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in codes.items())
    return f"CASE WHEN {column} IS NULL THEN {null_code} {tests} ELSE 0 END"


_COURIER_CTES = {
    "stores": _STORES,
    "orgs": _ORGS,
    "raw": f"""SELECT 'K' || o_custkey AS courier_id,
        CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 50 ELSE 0 END AS employee_id,
        'ТК' || o_custkey % 40 AS tk_name,
        CASE WHEN o_custkey % 13 <> 0 THEN 'Org ' || o_custkey % 12 END AS organisation_name,
        CAST(o_orderdate AS DATE) AS date_, {_labels_sql(DIVISION_LABELS, 'o_orderkey')} AS division,
        {_labels_sql(TRANSPORT_LABELS, 'o_orderkey')} AS transport,
        CAST(CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 14 ELSE 0 END AS DOUBLE) AS active_time_hours,
        CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL 570 MINUTE END AS s,
        CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate + INTERVAL 18 HOUR END AS e,
        CAST(o_custkey % 20 AS DOUBLE) AS orders_delivered,
        CASE WHEN o_orderkey % 5 <> 0 THEN 0.5 ELSE 0 END::DOUBLE AS sla, o_orderkey,
        'shifts-' || o_orderkey // 250 || '.xlsx' AS filename,
        DATE '2022-06-01' + CAST(o_orderkey // 250 % 20 AS INT) AS file_date FROM orders""",
    "all_stores": _grown("stores", "tk_id", "tk_name", "raw"),
    "all_orgs": _grown("orgs", "organisation_id", "organisation_name", "raw"),
    "report": f"""SELECT r.courier_id, r.employee_id, r.date_, a.tk_id, g.organisation_id,
        {_code_sql('division', R.DIVISIONS, 7)} AS division_id, {_code_sql('transport', R.TRANSPORTS, 0)} AS transport_id,
        active_time_hours, COALESCE(s, CASE WHEN e IS NULL THEN CAST(date_ AS TIMESTAMP) + INTERVAL 6 HOUR
            ELSE e - to_hours(CAST(active_time_hours AS INT)) END) AS first_activation,
        COALESCE(e, COALESCE(s, CAST(date_ AS TIMESTAMP) + INTERVAL 6 HOUR)
            + to_hours(CAST(active_time_hours AS INT))) AS last_deactivation,
        orders_delivered, sla AS SLA_delivery, filename, file_date,
        row_number() OVER (PARTITION BY r.courier_id, r.employee_id, r.date_
            ORDER BY file_date DESC, filename DESC, o_orderkey DESC) AS rn
        FROM raw r JOIN all_stores a ON a.tk_name = r.tk_name
        JOIN all_orgs g ON g.organisation_name IS NOT DISTINCT FROM r.organisation_name""",
    "stored": """SELECT 'K' || o_custkey AS courier_id, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 50 ELSE 0 END
        AS employee_id, CAST(o_orderdate AS DATE) + CAST(o_custkey % 2 AS INT) AS date_,
        CAST(MAX(o_orderkey) AS DOUBLE) AS full_payment_client FROM orders WHERE o_orderkey % 6 = 0 GROUP BY 1, 2, 3""",
}
_SHIFT_VALUES = (
    "tk_id", "organisation_id", "division_id", "transport_id", "active_time_hours", "first_activation",
    "last_deactivation", "orders_delivered", "SLA_delivery", "filename", "file_date",
)


@query(
    "ingest_couriers",
    with_fx(
        "SELECT COALESCE(s.courier_id, r.courier_id) AS courier_id, COALESCE(s.employee_id, r.employee_id) AS employee_id, "
        "COALESCE(s.date_, r.date_) AS date_, " + ", ".join(f"r.{c}" for c in _SHIFT_VALUES)
        + ", s.full_payment_client, CASE WHEN s.courier_id IS NULL THEN 'inserted' WHEN r.courier_id IS NULL THEN 'kept' "
        "ELSE 'updated' END AS action FROM stored s FULL JOIN (SELECT * FROM report WHERE rn = 1) r "
        "ON s.courier_id = r.courier_id AND s.employee_id = r.employee_id AND s.date_ = r.date_", **_COURIER_CTES,
    ),
)
def courier_ingest(t: Tables) -> DataFrame:
    load = load_couriers(courier_chunks(t), *stores_and_organisations(t))
    return apply_shifts(known_couriers(t, load), load, COURIER_KEY, action="action")


def known_couriers(t: Tables, load) -> DataFrame:
    """Shifts stored before the load, with pay."""
    table = (
        t.orders.filter("o_orderkey % 6 = 0")
        .groupBy(
            F.expr("concat('K', o_custkey)").alias("courier_id"),
            F.expr("CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 50 ELSE 0 END").alias("employee_id"),
            F.date_add(F.to_date("o_orderdate"), F.expr("CAST(o_custkey % 2 AS INT)")).alias("date_"),
        )
        .agg(F.max("o_orderkey").cast("double").alias("full_payment_client"))
    )
    return table.select(
        *COURIER_KEY, *[F.lit(None).cast(load.rows.schema[c].dataType).alias(c) for c in _SHIFT_VALUES],
        "full_payment_client",
    )


@query(
    "ingest_shift_warnings",
    with_fx(
        """SELECT 'warning' AS event_type, 'shift_reports' AS event_source,
        f || ' is 0 in ' || n || ' rows' AS description FROM (
        SELECT 'transport_id' AS f, COUNT(*) FILTER (transport_id = 0) AS n FROM report
        UNION ALL SELECT 'division_id', COUNT(*) FILTER (division_id = 0) FROM report) WHERE n > 0""",
        **_COURIER_CTES,
    ),
)
def courier_warnings(t: Tables) -> DataFrame:
    return load_couriers(courier_chunks(t), *stores_and_organisations(t)).warnings


@query(
    "ingest_pickers",
    with_fx(
        f"""SELECT r.picker_id, r.employee_id, a.tk_id, {_code_sql('division', R.DIVISIONS, 7)} AS division_id, r.date_,
        g.organisation_id, ROUND(sla, 4) AS SLA_reaction, ROUND(pick, 4) AS SLA_pick, picked AS picked_SKU,
        DATE '2022-06-01' + CAST(event_id // 250 % 20 AS INT) AS file_date FROM raw r
        JOIN all_stores a ON a.tk_name = r.tk_name JOIN all_orgs g ON g.organisation_name = r.organisation_name""",
        stores=_STORES,
        orgs=_ORGS,
        raw=f"""SELECT event_id, 'P' || user_id AS picker_id, user_id AS employee_id, 'ТК' || user_id % 40 AS tk_name,
        'Org ' || user_id % 12 AS organisation_name, {_labels_sql(DIVISION_LABELS, 'event_id')} AS division,
        CAST(ts AS DATE) AS date_, CAST('0.' || lpad(CAST(event_id % 10000 * 10 + 3 AS VARCHAR), 6, '0') AS DOUBLE) AS sla,
        CASE WHEN event_id % 9 = 0 THEN 0 ELSE CAST('0.0' || event_id % 10000 || '3' AS DOUBLE) END AS pick,
        CAST(event_id % 50 AS DOUBLE) AS picked FROM events""",
        all_stores=_grown("stores", "tk_id", "tk_name", "raw"),
        all_orgs=_grown("orgs", "organisation_id", "organisation_name", "raw"),
    ),
)
def picker_ingest(t: Tables) -> DataFrame:
    load = load_pickers(picker_chunks(t), *stores_and_organisations(t))
    return load.rows.select(
        "picker_id", "employee_id", "tk_id", "division_id", "date_", "organisation_id", "SLA_reaction", "SLA_pick",
        "picked_SKU", "file_date",
    )


def picker_chunks(t: Tables) -> DataFrame:
    """Picker sheets: first in odd books, second in even books that open with couriers."""
    values = {
        "КПП Комплектовщика": "concat('P', user_id)", "employee_id": "concat('№ ', user_id, ' / 7')",
        "ТК": "user_id % 40", "Дивизион": _labels(DIVISION_LABELS, "event_id"),
        "Дата": "date_format(ts, 'yyyy-MM-dd 00:00:00')", "Организация": "concat('Org ', user_id % 12)",
        "SLA, реакция": "concat('0.', lpad(CAST(event_id % 10000 * 10 + 3 AS STRING), 6, '0'))",
        "SLA, сборка": "CASE WHEN event_id % 9 <> 0 THEN concat('0.0', event_id % 10000, '3') END",
        "Собрано SKU": "event_id % 50",
    }
    rows = t.events.withColumn("book", F.expr("event_id div 250"))
    first = F.col("book") % 2 == 1
    return chunks(
        rows, "event_id", landing_name(F.concat(F.lit("p"), "book"), file_day("book"), F.lit(SENDER)),
        F.when(first, 0).otherwise(1), texts(R.PICKER_HEADER), cells_of(R.PICKER_HEADER, values),
        F.when(first, texts(R.PICKER_HEADER)).otherwise(texts(R.COURIER_HEADER)),
    )


# Hours ---------------------------------------------------------------------------------------

ROLE_LABELS = (*R.ROLES, "Бригадир")
_HOURS_DAY = "DATE '2022-06-01' + CAST(c_custkey // 100 % 10 + i AS INT)"


@query(
    "ingest_hours",
    with_fx(
        """SELECT * FROM stored WHERE report_date NOT IN (SELECT report_date FROM covered) UNION ALL
        SELECT r.doer_name, r.doer_id, CAST(a.tks_id AS INT), r.speciality_id, CAST(h AS DOUBLE), report_date, file_date, filename
        FROM raw r JOIN all_tks a ON a.city_id IS NOT DISTINCT FROM r.city_id AND a.address = r.address,
        LATERAL (SELECT i, CASE WHEN (c_custkey % 8 = 0 AND i = 1) OR (c_custkey // 100 % 2 = 1 AND i = 0) THEN 0
            ELSE (c_custkey + i) % 5 END AS h, """ + _HOURS_DAY + """ AS report_date FROM range(0, 3) x(i)) d
        WHERE h <> 0 AND (report_date, filename) IN (SELECT report_date, last FROM covered)""",
        tks="SELECT n_nationkey AS tks_id, n_regionkey AS city_id, 'Addr ' || n_nationkey AS address FROM nation",
        raw=f"""SELECT c_custkey, c_name AS doer_name, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey END AS doer_id,
        r_regionkey AS city_id, 'Addr ' || c_custkey % 20 AS address,
        {_code_sql('role', R.ROLES, 0)} AS speciality_id, DATE '2022-06-01' + CAST(c_custkey // 100 % 20 AS INT) AS file_date,
        'hours-' || c_custkey // 100 AS filename FROM (SELECT *, {_labels_sql(ROLE_LABELS, 'c_custkey')} AS role,
        MIN(c_custkey) OVER (PARTITION BY c_custkey // 100) AS lo, MAX(c_custkey) OVER (PARTITION BY c_custkey // 100) AS hi
        FROM customer) LEFT JOIN region ON r_regionkey = c_custkey % 6 WHERE c_custkey > lo AND c_custkey < hi""",
        all_tks="""SELECT * FROM tks UNION ALL SELECT (SELECT MAX(tks_id) FROM tks) +
        row_number() OVER (ORDER BY city_id NULLS FIRST, address), city_id, address FROM (
        SELECT city_id, address FROM raw EXCEPT SELECT city_id, address FROM tks)""",
        covered=f"""SELECT {_HOURS_DAY} AS report_date, arg_max('hours-' || c_custkey // 100,
        (DATE '2022-06-01' + CAST(c_custkey // 100 % 20 AS INT), 'hours-' || c_custkey // 100)) AS last
        FROM customer, range(0, 3) x(i) GROUP BY 1""",
        stored="""SELECT c_name AS doer_name, c_custkey AS doer_id, 1 AS tks_id, 1 AS speciality_id, CAST(8 AS DOUBLE)
        AS worked_hours, DATE '2022-05-20' + CAST(c_custkey % 30 AS INT) AS report_date, DATE '2022-05-20' AS file_date,
        'old' AS filename FROM customer WHERE c_custkey % 3 = 0""",
    ),
)
def hours_ingest(t: Tables) -> DataFrame:
    stored, load = hours_load(t)
    return apply_hours(stored, load)


def hours_load(t: Tables):
    """Hours stored before, and those a delivery brings."""
    return known_hours(t), load_hours(hours_chunks(t), regions_by_name(t), addresses(t))


def regions_by_name(t: Tables) -> DataFrame:
    return t.region.selectExpr("r_regionkey AS id", "r_name AS legal_name")


def addresses(t: Tables) -> DataFrame:
    return t.nation.selectExpr("n_nationkey AS tks_id", "n_regionkey AS city_id", "concat('Addr ', n_nationkey) AS address")


def known_hours(t: Tables) -> DataFrame:
    return t.customer.filter("c_custkey % 3 = 0").selectExpr(
        "c_name AS doer_name", "c_custkey AS doer_id", "1 AS tks_id", "1 AS speciality_id", "8D AS worked_hours",
        "date_add(DATE '2022-05-20', CAST(c_custkey % 30 AS INT)) AS report_date", "DATE '2022-05-20' AS file_date",
        "'old' AS filename",
    )


def hours_chunks(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("book", F.expr("c_custkey div 100"))
    days = [F.date_add(F.lit("2022-06-01").cast("date"), F.expr(f"CAST(book % 10 + {i} AS INT)")) for i in range(3)]
    # dates come as text or as date cells
    shown = [F.date_format(days[0], "dd.MM.yy"), F.date_format(days[1], "yyyy-MM-dd HH:mm:ss"),
             F.date_format(days[2], "dd.MM.yy")]
    headers = F.concat(texts(R.HOURS_HEADER), F.array(*shown, F.lit("Итого")))
    city = F.expr("CASE WHEN c_custkey % 6 < 5 THEN get(array('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), "
                  "CAST(c_custkey % 6 AS INT)) ELSE 'Nowhere' END")
    cells = F.array(
        F.expr("concat('Addr ', c_custkey % 20)"), F.col("c_name"), F.expr(_labels(ROLE_LABELS, "c_custkey")),
        F.expr("CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey AS STRING) ELSE 'нет' END"),
        F.concat(F.lit(" "), city, F.lit(" ")),
        *[F.expr(f"CASE WHEN (c_custkey % 8 <> 0 OR {i} <> 1) AND (book % 2 = 0 OR {i} <> 0) "
                 f"THEN CAST((c_custkey + {i}) % 5 AS STRING) END") for i in range(3)],
        F.lit("99"),
    )
    return chunks(
        rows, "c_custkey", landing_name(F.concat(F.lit("hours-"), "book"), file_day("book"), F.lit(SENDER)),
        F.lit(0), headers, cells,
    )


@query(
    "hours_problems",
    f"""SELECT '31.' || strftime(DATE '2022-06-01' + CAST(b % 20 AS INT), '%Y-%m-%d') AS day, b AS book, problem, value, found FROM (
    SELECT c_custkey // 100 AS b, 'hours are no number' AS problem, 'x' || c_custkey % 3 AS value, COUNT(*) AS found FROM (
    SELECT *, MIN(c_custkey) OVER (PARTITION BY c_custkey // 100) AS lo, MAX(c_custkey) OVER (PARTITION BY c_custkey // 100) AS hi
    FROM customer) WHERE c_custkey > lo AND c_custkey < hi AND c_custkey % 7 = 0 GROUP BY ALL
    UNION ALL SELECT DISTINCT c_custkey // 100, 'unread date header', 'June ' || c_custkey // 100, 1 FROM customer)""",
)
def hours_found_wanting(t: Tables) -> DataFrame:
    """Date headers and cells of hours reports that cannot be read, told per file."""
    rows = t.customer.withColumn("book", F.expr("c_custkey div 100"))
    headers = F.concat(texts(R.HOURS_HEADER), F.array(F.lit("1.6.22"), F.concat(F.lit("June "), F.col("book")), F.lit("Итого")))
    cells = F.array(
        F.lit("Addr 1"), F.col("c_name"), F.lit("Сборщик"), F.col("c_custkey").cast("string"), F.lit("ASIA"),
        F.expr("CASE WHEN c_custkey % 7 = 0 THEN concat('x', c_custkey % 3) ELSE '8' END"), F.lit("4"), F.lit("12"),
    )
    delivered = chunks(
        rows, "c_custkey", landing_name(F.concat(F.lit("hours-"), "book"), file_day("book"), F.lit(SENDER)),
        F.lit(0), headers, cells,
    )
    regions = t.region.selectExpr("r_regionkey AS id", "r_name AS legal_name")
    tks = t.nation.selectExpr("n_nationkey AS tks_id", "n_regionkey AS city_id", "concat('Addr ', n_nationkey) AS address")
    found = load_hours(delivered, regions, tks).problems
    return found.select(
        F.concat(F.lit("31."), F.regexp_extract("file", r"\d{4}-\d\d-\d\d", 0)).alias("day"),
        F.regexp_extract("file", r"hours-(\d+)", 1).cast("bigint").alias("book"), "problem", "value", "found",
    )


# Revenues ------------------------------------------------------------------------------------


def revenue_load(t: Tables):
    return load_revenues(revenue_chunks(t), *dimensions(t))


def dimensions(t: Tables) -> Dimensions:
    return Dimensions(
        t.supplier.selectExpr("s_suppkey AS id", "concat('user', s_suppkey, '@mail.example') AS email"),
        t.supplier.selectExpr("s_suppkey AS id", "s_name AS name"), regions_by_name(t),
        t.nation.selectExpr("n_nationkey AS id", "n_name AS name"),
    )


def revenue_chunks(t: Tables, where: str = "true") -> DataFrame:
    values = {
        "ID": "CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END", "Дата": "date_format(o_orderdate, 'yyyy-MM-dd 00:00:00')",
        "Сумма Выручки": "CASE WHEN o_orderkey % 19 <> 0 THEN o_totalprice END", "Статья": "o_orderpriority",
        "Проект": "concat('Supplier#', lpad(CAST(o_custkey % 150 AS STRING), 9, '0'))",
        "Регион": "get(array('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), CAST(o_orderkey % 6 AS INT))",
        "Специальность": "concat('NATION_', o_custkey % 30)", "Заметка": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END",
    }
    rows = t.orders.filter(where).withColumn("book", F.expr("o_orderkey div 200"))
    sender = F.concat(F.lit("user"), F.col("book") % 120, F.lit("@mail.example"))
    return chunks(
        rows, "o_orderkey", landing_name(F.concat(F.lit("rev-"), "book", F.lit(".xlsx")), file_day("book"), sender),
        F.lit(0), texts(R.REVENUE_HEADER), cells_of(R.REVENUE_HEADER, values),
    )


@query(
    "ingest_revenues",
    """SELECT CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey ELSE 0 END AS doer_id, CAST(o_orderdate AS DATE) AS date,
    CASE WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS amount, o_orderpriority AS article_id,
    COALESCE(u.s_suppkey, 0) AS created_by, p.s_suppkey AS project_id, r_regionkey AS region_id, n_nationkey AS speciality_id,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE '' END AS notes,
    DATE '2022-06-01' + CAST(o_orderkey // 200 % 20 AS INT) AS file_date, 'rev-' || o_orderkey // 200 || '.xlsx' AS filename
    FROM orders LEFT JOIN supplier u ON u.s_suppkey = o_orderkey // 200 % 120
    LEFT JOIN supplier p ON p.s_name = 'Supplier#' || lpad(CAST(o_custkey % 150 AS VARCHAR), 9, '0')
    LEFT JOIN region ON r_regionkey = o_orderkey % 6 LEFT JOIN nation ON n_nationkey = o_custkey % 30""",
)
def revenue_ingest(t: Tables) -> DataFrame:
    return revenue_load(t).rows


@query(
    "ingest_revenue_audit",
    """SELECT 'error' AS event_type, 'revenues' AS event_source, 'column ' || c || ' has empty cells' AS description
    FROM (SELECT 'amount' AS c, COUNT(*) FILTER (o_orderkey % 19 = 0) AS n FROM orders
    UNION ALL SELECT 'region', COUNT(*) FILTER (o_orderkey % 6 = 5) FROM orders) WHERE n > 0
    UNION ALL SELECT DISTINCT 'warning', 'revenues', 'sender ''user' || b || '@mail.example'' has no user id, 0 is stored'
    FROM (SELECT o_orderkey // 200 % 120 AS b FROM orders) WHERE b NOT IN (SELECT s_suppkey FROM supplier)""",
)
def revenue_audit(t: Tables) -> DataFrame:
    return revenue_load(t).audit


# Staffing requests ---------------------------------------------------------------------------

RESOURCE_LABELS = (*R.RESOURCES, "Грузчик")


@query(
    "ingest_requests",
    with_fx(
        f"""SELECT a.tk_id, {_code_sql('resource', R.RESOURCES, 0)} AS resource_id, r.is_night, r.add_requirement,
        DATE '2022-06-01' + CAST(c_custkey // 100 % 20 AS INT) AS file_date, 'req-' || c_custkey // 100 AS filename,
        DATE '2022-06-01' + CAST(c_custkey // 100 % 10 + i AS INT) AS requested_date,
        CASE WHEN c_custkey % 2 = 1 AND i = 0 THEN NULL WHEN (c_custkey + i) % 7 <> 0 THEN CAST(c_custkey % 12 + i AS DOUBLE) END
        AS doer_count FROM raw r JOIN all_stores a ON a.tk_name = r.tk_name, range(0, 2) x(i)""",
        stores=_STORES,
        raw=f"""SELECT c_custkey, 'ТК' || c_custkey % 45 AS tk_name, {_labels_sql(RESOURCE_LABELS, 'c_custkey')} AS resource,
        CASE WHEN c_custkey % 4 = 0 THEN '1' END AS is_night, CAST(c_custkey % 3 AS VARCHAR) AS add_requirement FROM customer""",
        all_stores=_grown("stores", "tk_id", "tk_name", "raw"),
    ),
)
def request_ingest(t: Tables) -> DataFrame:
    return load_requests(request_chunks(t), stores_and_organisations(t)[0]).rows


def request_chunks(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("book", F.expr("c_custkey div 100"))
    first = [F.date_format(F.date_add(F.lit("2022-06-01").cast("date"), F.expr(f"CAST(book % 10 + {i} AS INT)")),
                           "yyyy-MM-dd HH:mm:ss") for i in range(2)]
    head = F.array(F.lit("ТК"), F.lit("Тип ресурса"), *first, F.lit("Unnamed: 4"), F.lit("Ночь"), F.lit("Доп потребность"))
    # the second sheet has its own column order, no name for the store and only the second date
    other = F.array(F.lit("Unnamed: 0"), first[1], F.lit("Тип ресурса"), F.lit("Доп потребность"), F.lit("Ночь"))
    store = F.expr("CASE WHEN c_custkey % 3 = 0 THEN concat('ТК', c_custkey % 45) ELSE CAST(c_custkey % 45 AS STRING) END")
    counts = [
        F.expr(f"CASE WHEN (c_custkey + {i}) % 7 <> 0 THEN CAST(c_custkey % 12 + {i} AS STRING) ELSE 'нет' END")
        for i in range(2)
    ]
    resource = F.expr(_labels(RESOURCE_LABELS, "c_custkey"))
    night = F.expr("CASE WHEN c_custkey % 4 = 0 THEN '1' END")
    more = F.expr("CAST(c_custkey % 3 AS STRING)")
    even = F.col("c_custkey") % 2 == 0
    return chunks(
        rows, "c_custkey", landing_name(F.concat(F.lit("req-"), "book"), file_day("book"), F.lit(SENDER)),
        F.when(even, 0).otherwise(1), F.when(F.col("sheet") == 0, head).otherwise(other),
        F.when(even, F.array(store, resource, *counts, F.lit("5"), night, more)).otherwise(
            F.array(store, counts[1], resource, more, night)
        ),
        head,
    )


# Preferences ---------------------------------------------------------------------------------

DELIVERED = date(2024, 2, 1)
_PREFERENCE_VALUES = ("first_name", "zones", "time_start", "couriers_intervals_last_update", "filename", "file_date")


@query(
    "ingest_preferences",
    with_fx(
        """SELECT COALESCE(b.courier_id, n.courier_id) AS courier_id, COALESCE(b.preferred_date, n.preferred_date) AS preferred_date,
        COALESCE(n.first_name, b.first_name) AS first_name, COALESCE(n.zones, b.zones) AS zones,
        CASE WHEN n.courier_id IS NULL THEN b.time_start ELSE n.time_start END AS time_start,
        COALESCE(n.last_update, b.last_update) AS couriers_intervals_last_update,
        CASE WHEN n.courier_id IS NOT NULL AND (b.courier_id IS NULL OR n.first_name <> b.first_name OR
            COALESCE(n.zones <> b.zones, FALSE) OR COALESCE(n.time_start <> b.time_start, FALSE) OR
            COALESCE(n.last_update <> b.last_update, FALSE)) THEN 'prefs.xlsx' ELSE b.filename END AS filename,
        CASE WHEN n.courier_id IS NOT NULL AND (b.courier_id IS NULL OR n.first_name <> b.first_name OR
            COALESCE(n.zones <> b.zones, FALSE) OR COALESCE(n.time_start <> b.time_start, FALSE) OR
            COALESCE(n.last_update <> b.last_update, FALSE)) THEN DATE '2024-02-01' ELSE b.file_date END AS file_date
        FROM blanked b FULL JOIN dated n ON b.courier_id = n.courier_id AND b.preferred_date = n.preferred_date""",
        last="""SELECT * FROM (SELECT user_id AS courier_id, CAST(isodow(ts) AS INT) AS w, event_id,
        'N' || user_id AS first_name, event_type AS zones, CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 24 AS VARCHAR) END AS time_start,
        CASE WHEN event_id % 29 <> 0 THEN date_trunc('second', ts) END AS last_update,
        row_number() OVER (PARTITION BY user_id, isodow(ts) ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
        stored="""SELECT user_id AS courier_id, DATE '2024-01-30' + CAST(event_id % 7 AS INT) AS preferred_date,
        'N' || user_id AS first_name, MIN(event_type) AS zones, '8' AS time_start, TIMESTAMP '2024-01-01 00:00:00' AS last_update,
        'old.xlsx' AS filename, DATE '2024-01-25' AS file_date FROM events WHERE user_id % 3 <> 0 GROUP BY 1, 2""",
        marked="""SELECT *, courier_id IN (SELECT courier_id FROM last WHERE last_update IS NULL) AND preferred_date IN
        (DATE '2024-02-04', DATE '2024-02-05', DATE '2024-02-06') AND preferred_date <= (SELECT MAX(preferred_date) FROM stored)
        AS hit FROM stored""",
        blanked="""SELECT courier_id, preferred_date, first_name, CASE WHEN NOT hit THEN zones END AS zones,
        CASE WHEN NOT hit THEN time_start END AS time_start, CASE WHEN NOT hit THEN last_update END AS last_update,
        CASE WHEN hit THEN 'prefs.xlsx' ELSE filename END AS filename,
        CASE WHEN hit THEN DATE '2024-02-01' ELSE file_date END AS file_date FROM marked""",
        dated="""SELECT l.*, d.preferred_date FROM last l JOIN (VALUES (DATE '2024-02-04'), (DATE '2024-02-05'),
        (DATE '2024-02-06')) d(preferred_date) ON isodow(d.preferred_date) = l.w WHERE l.last_update IS NOT NULL""",
    ),
)
def preference_ingest(t: Tables) -> DataFrame:
    template = split_template(preference_rows(preference_chunks(t, None, DELIVERED, "prefs.xlsx")))
    stored = (
        t.events.filter("user_id % 3 <> 0")
        .groupBy(F.col("user_id").alias("courier_id"),
                 F.expr("date_add(DATE '2024-01-30', CAST(event_id % 7 AS INT))").alias("preferred_date"))
        .agg(F.min("event_type").alias("zones"))
    )
    given = {
        "first_name": F.concat(F.lit("N"), "courier_id"), "zones": F.col("zones"), "time_start": F.lit("8"),
        "couriers_intervals_last_update": F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"),
        "filename": F.lit("old.xlsx"), "file_date": F.lit(date(2024, 1, 25)),
    }
    others = [c for c in template.rows.columns if c not in ("courier_id", "row_no", "file", *given)]
    table = stored.select(
        "courier_id", "preferred_date", *[e.alias(n) for n, e in given.items()],
        *[F.lit(None).cast(template.rows.schema[c].dataType).alias(c) for c in others],
    )
    after = apply_template(table, template, DELIVERED, "prefs.xlsx")
    return after.select("courier_id", "preferred_date", *_PREFERENCE_VALUES)


def preference_chunks(t: Tables, number: int | None, day: date, name: str) -> DataFrame:
    """One delivery of a template, in chunks of 1000 rows. Numbered deliveries differ in rows, times and withdrawals."""
    n = number or 0
    values = {
        "courier_id": "user_id", "first_name": "concat('N', user_id)", "zones": "event_type",
        "day_of_week_number": "weekday(ts) + 1", "time_start": f"CASE WHEN event_id % 4 <> 0 THEN (event_id + {n}) % 24 END",
        "couriers_intervals_last_update": f"CASE WHEN (event_id + {n}) % 29 <> 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') END",
    }
    given = t.events if number is None else t.events.filter(f"event_id % 4 <> {n}")
    rows = given.withColumn("part", F.expr("event_id div 1000"))
    pieces = rows.groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("event_id", cells_of(R.PREFERENCE_HEADER, values).alias("cells")))).alias("rows")
    )
    return pieces.select(
        landing_name(F.lit(name), F.lit(day), F.lit(SENDER)).alias("file"), F.lit(0).alias("sheet"),
        texts(R.PREFERENCE_HEADER).alias("book_headers"), texts(R.PREFERENCE_HEADER).alias("headers"),
        (F.col("part") * 1000 + 1).cast("int").alias("first_row"), F.lit(False).alias("is_last"),
        F.col("rows.cells").alias("rows"),
    )


# Shift outputs -------------------------------------------------------------------------------


# column: expression over orders in Spark and in DuckDB
_OUTPUT = {
    "city": "CASE WHEN o_orderkey % 8 <> 0 THEN o_orderpriority END", "delivery_provider": "concat('P', o_custkey % 9)",
    "delivery_service": "o_orderstatus", "starting_point_id": "o_custkey % 40",
    "starting_point_name": "concat('Point ', o_custkey % 40)", "delivery_zone_id": "o_custkey % 25",
    "delivery_zone_name": "concat('Zone ', o_custkey % 25)",
    "courier_un_id": "CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END", "rider_name": "concat('Rider ', o_custkey)",
    "start_time": "'09:00'", "end_time": "CASE WHEN o_orderkey % 4 <> 0 THEN '18:00' END", "free_float": "o_orderkey % 2",
}
_OUTPUT_COLUMNS = (*_OUTPUT, "schedule_date", "filename", "fix_date")


def output_load(t: Tables):
    return load_outputs(output_chunks(t))


def output_chunks(t: Tables) -> DataFrame:
    values = {**_OUTPUT, "schedule_date": "date_format(o_orderdate, 'yyyy-MM-dd')", "horario_reparto_id": "o_orderkey"}
    rows = t.orders.withColumn("book", F.expr("o_orderkey div 300"))
    return chunks(
        rows, "o_orderkey", landing_name(F.concat(F.lit("out-"), "book"), file_day("book"), F.lit(SENDER)),
        F.lit(0), texts(R.OUTPUT_HEADER), cells_of(R.OUTPUT_HEADER, values),
    )


@query(
    "ingest_outputs",
    "SELECT horario_reparto_id, " + ", ".join(f"CASE WHEN n.k IS NULL THEN b.{c} ELSE n.{c} END AS {c}" for c in _OUTPUT_COLUMNS)
    + """, CASE WHEN b.city IS NULL THEN 'inserted' WHEN n.k IS NULL THEN 'kept' ELSE 'updated' END AS action
    FROM (SELECT CAST(o_orderkey * 2 AS VARCHAR) AS horario_reparto_id, 'old city' AS city, """
    + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _OUTPUT if c != "city")
    + """, DATE '2022-01-01' AS schedule_date, 'old.xlsx' AS filename, DATE '2022-01-02' AS fix_date FROM orders) b
    FULL JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS horario_reparto_id, o_orderkey AS k, """
    + ", ".join(f"CAST({e} AS VARCHAR) AS {c}" for c, e in _OUTPUT.items())
    + """, CAST(o_orderdate AS DATE) AS schedule_date, 'out-' || o_orderkey // 300 AS filename,
    DATE '2022-06-01' + CAST(o_orderkey // 300 % 20 AS INT) AS fix_date FROM orders) n USING (horario_reparto_id)""",
)
def output_ingest(t: Tables) -> DataFrame:
    table = t.orders.select(
        F.expr("CAST(o_orderkey * 2 AS STRING) AS horario_reparto_id"), F.lit("old city").alias("city"),
        *[F.lit(None).cast("string").alias(c) for c in _OUTPUT if c != "city"],
        F.lit(date(2022, 1, 1)).alias("schedule_date"), F.lit("old.xlsx").alias("filename"),
        F.lit(date(2022, 1, 2)).alias("fix_date"),
    )
    return apply_outputs(table, output_load(t), ["horario_reparto_id"], action="action")


@query(
    "ingest_output_warnings",
    """SELECT 'warning' AS event_type, 'outputs' AS event_source, 'out-' || b || ': ' || c || ' is empty in ' || n || ' rows' AS description
    FROM (SELECT o_orderkey // 300 AS b, 'city' AS c, COUNT(*) FILTER (o_orderkey % 8 = 0) AS n FROM orders GROUP BY ALL
    UNION ALL SELECT o_orderkey // 300, 'courier_un_id', COUNT(*) FILTER (o_orderkey % 9 = 0) FROM orders GROUP BY ALL) WHERE n > 0""",
)
def output_warnings(t: Tables) -> DataFrame:
    """Empty cells, counted for each delivered file."""
    return output_load(t).warnings


# Vacancies -----------------------------------------------------------------------------------

_TITLE = f"""concat(get(array({', '.join(f"'{h}'" for h in HEADS)}), CAST(event_id % {len(HEADS)} AS INT)),
    get(array({', '.join(f"'{h}'" for h in TAILS)}), CAST(event_id div {len(HEADS)} % {len(TAILS)} AS INT)))"""
_FOUND = f"""SELECT event_id, lower({_sql_texts(HEADS)}[event_id % {len(HEADS)} + 1] ||
    {_sql_texts(TAILS)}[(event_id // {len(HEADS)}) % {len(TAILS)} + 1]) AS vacancy_name FROM events"""


@query(
    "ingest_api_vacancies",
    f"""SELECT CAST(c.event_id AS VARCHAR) AS vacancy_id, c.vacancy_name, user_id AS region, c.speciality_id,
    CASE WHEN e.event_id % 5 <> 0 AND e.event_id % 3 <> 0 THEN CAST(user_id * 10 AS VARCHAR) END AS employer_id,
    CASE WHEN e.event_id % 5 <> 0 THEN 'Employer ' || user_id ELSE '' END AS employer_name,
    CASE WHEN e.event_id % 4 <> 0 THEN e.event_id * 10 END AS salary_min, e.event_id * 20 AS salary_max,
    COALESCE(CASE WHEN e.event_id % 6 <> 0 THEN e.event_id % 2 = 0 END, FALSE) AS gross,
    date_trunc('second', ts) - INTERVAL 3 HOUR AS published_at, 'open' AS type_vacancy,
    CASE WHEN e.event_id % 7 <> 0 THEN props ELSE '' END AS requirements
    FROM ({rules_sql(API_RULES, 'vacancy_name', _FOUND, 'event_id', 'speciality_id')}) c JOIN events e USING (event_id)
    WHERE event_id % 2 = 1 OR event_id % 3 = 0 OR event_id % 4 = 0 OR event_id % 5 = 0""",
)
def api_ingest(t: Tables) -> DataFrame:
    found = settle(found_api_vacancies(t), "items")
    # the table holds the even ids; of those, rows with a null come in again
    stored = found.filter("CAST(vacancy_id AS BIGINT) % 2 = 0")
    return new_vacancies(stored, found, API_COLUMNS)


def found_api_vacancies(t: Tables) -> DataFrame:
    return api_vacancies(api_pages(t, _TITLE))


@query(
    "ingest_web_vacancies",
    f"""SELECT '/vacancy/' || p_partkey AS vacancy_id, vacancy_name, CAST(p_partkey // 20 % 84 AS INT) AS region,
    speciality_id, CASE WHEN p_partkey % 3 <> 0 THEN p_brand || ' & Co' ELSE '' END AS employer_name,
    CAST(p_size * 1000 AS VARCHAR) AS salary, CASE WHEN p_partkey % 4 <> 0 THEN p_type || ' <' || p_name || '>' ELSE '' END
    AS description FROM ({rules_sql(WEB_RULES, 'vacancy_name',
        f"SELECT p_partkey, p_brand, p_size, p_type, p_name, lower({_sql_texts(HEADS)}[p_partkey % {len(HEADS)} + 1] || "
        f"{_sql_texts(TAILS)}[(p_partkey // {len(HEADS)}) % {len(TAILS)} + 1]) AS vacancy_name FROM part",
        'p_partkey, p_brand, p_size, p_type, p_name', 'speciality_id')}) WHERE p_partkey % 2 = 1""",
)
def web_ingest(t: Tables) -> DataFrame:
    title = _TITLE.replace("event_id", "p_partkey")
    card = f"""concat('<div class="iva-item-body-x"><div><a class="t" href="/vacancy/', p_partkey, '"><h3 itemprop="name">',
        {title}, '</h3></a><a href="/other">more</a></div><span><meta itemprop="currency" content="RUB">',
        '<meta itemprop="price" content="', p_size * 1000, '"></span>',
        CASE WHEN p_partkey % 4 <> 0 THEN concat('<div class="a iva-item-description-y">', p_type, '<b> &lt;', p_name,
            '&gt;</b></div>') ELSE '' END,
        CASE WHEN p_partkey % 3 <> 0 THEN concat('<p><i data-marker="item-link">', p_brand, ' &amp; Co</i></p>') ELSE '' END,
        '</div>')"""
    cards = t.part.selectExpr("p_partkey div 20 AS page", f"struct(p_partkey, {card} AS card) AS card")
    # 20 cards a page
    pages = cards.groupBy("page").agg(F.array_sort(F.collect_list("card"))["card"].alias("cards")).select(
        F.expr("CAST(page % 84 AS INT)").alias("region"),
        F.concat(F.lit('<html><body><div class="top"><a href="/">x</a></div>'), F.array_join("cards", "<hr>"),
                 F.lit('<div class="iva-item-description-z">footer</div></body></html>')).alias("html"),
    )
    found = settle(web_vacancies(pages), "cards")
    stored = found.filter("CAST(substr(vacancy_id, 10) AS BIGINT) % 2 = 0")
    return new_vacancies(stored, found, WEB_COLUMNS)
