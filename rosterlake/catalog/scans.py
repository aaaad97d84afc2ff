"""Scans and sources."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from rosterlake.catalog.base import Tables, new_store, query
from rosterlake.catalog.books import encode_workbooks
from rosterlake.functions import coerce_numeric, parse_date
from rosterlake.operators.clean import select_as
from rosterlake.operators.quality import append_audit, audit_row, quality_counts, warnings
from rosterlake.operators.reshape import dated_columns
from rosterlake.operators.store import Change
from rosterlake.plans import reports as R
from rosterlake.plans.vacancies import WEB_COUNTER, WEB_PAGER
from rosterlake.session import run_folder
from rosterlake.sources.landing import (
    column_range, delivery_filter, drop_unnamed, landing_metadata, route, trim_edges,
)
from rosterlake.sources.tables import read_table
from rosterlake.sources.web import (
    VACANCY_PAGE, CardMarkup, html_cards, html_links, json_items, json_tree_ids, page_count, unread_pages,
)
from rosterlake.sources.workbook import cell_at, decode_workbooks, landing_status, sheet_rows


def sql_list(texts) -> str:
    return "[" + ", ".join("'" + t + "'" for t in texts) + "]"


@query("scan_prune", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def scan_prune(t: Tables) -> DataFrame:
    source = {"id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"}
    return select_as(read_table(t.spark, f"{t.folder}/customer.parquet", list(source.values())), source)


LANDED_SQL = """SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN 'note.' || doc_id ELSE
    CAST(length(prefix) + 2 AS VARCHAR) || prefix || 'report.' || doc_id || '.xlsx' END AS file
    FROM (SELECT doc_id, '.' || CAST(DATE '2022-01-01' + CAST(doc_id % 365 AS INT) AS VARCHAR) || '.' ||
    source || CASE WHEN doc_id % 3 = 0 THEN '@corp.example' ELSE '@mail.example' END || '.' AS prefix
    FROM documents)"""


def landed(t: Tables) -> DataFrame:
    day = F.date_add(F.lit("2022-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    host = F.when(F.col("doc_id") % 3 == 0, "@corp.example").otherwise("@mail.example")
    prefix = F.concat(F.lit("."), day.cast("string"), F.lit("."), F.col("source"), host, F.lit("."))
    name = F.concat((F.length(prefix) + 2).cast("string"), prefix, F.lit("report."), "doc_id", F.lit(".xlsx"))
    odd = F.concat(F.lit("note."), F.col("doc_id"))
    return t.documents.select("doc_id", F.when(F.col("doc_id") % 50 == 0, odd).otherwise(name).alias("file"))


@query(
    "landing_metadata",
    f"""SELECT doc_id, file, TRY_CAST(split_part(file, '.', 2) AS DATE) AS file_date,
    CASE WHEN doc_id % 50 <> 0 THEN substr(file, 15, CAST(split_part(file, '.', 1) AS INT) - 15) END AS sender,
    CASE WHEN doc_id % 50 <> 0 THEN substr(file, CAST(split_part(file, '.', 1) AS INT) + 1) END AS filename
    FROM ({LANDED_SQL})""",
)
def landing_names(t: Tables) -> DataFrame:
    return landing_metadata(landed(t), "file")


@query(
    "delivery_filter",
    """SELECT doc_id, sender, attachment FROM (SELECT doc_id,
    source || CASE WHEN doc_id % 3 = 0 THEN '@corp.example' ELSE '@mail.example' END AS sender,
    'a' || doc_id || CASE WHEN doc_id % 4 = 0 THEN '.png' ELSE '.xlsx' END AS attachment FROM documents)
    WHERE (sender = 'src1@mail.example' OR sender = 'src2@mail.example' OR sender LIKE '%@corp.%')
    AND attachment NOT LIKE '%.png'""",
)
def accepted_deliveries(t: Tables) -> DataFrame:
    host = F.when(F.col("doc_id") % 3 == 0, "@corp.example").otherwise("@mail.example")
    suffix = F.when(F.col("doc_id") % 4 == 0, ".png").otherwise(".xlsx")
    mails = t.documents.select(
        "doc_id", F.concat("source", host).alias("sender"),
        F.concat(F.lit("a"), "doc_id", suffix).alias("attachment"),
    )
    return delivery_filter(
        mails, "sender", "attachment", ["src1@mail.example", "src2@mail.example"], ["@corp."]
    )


# Stored responses ----------------------------------------------------------------------------


def api_pages(t: Tables, title: str = "event_type") -> DataFrame:
    """API pages of up to 100 items built from events; every fifth employer is absent."""
    item = f"""struct(CAST(event_id AS STRING) AS id, {title} AS name,
        struct(CAST(user_id AS STRING) AS id) AS area,
        CASE WHEN event_id % 5 <> 0 THEN struct(
            CASE WHEN event_id % 3 <> 0 THEN CAST(user_id * 10 AS STRING) END AS id,
            concat('Employer ', user_id) AS name) END AS employer,
        struct(CASE WHEN event_id % 4 <> 0 THEN event_id * 10 END AS `from`, event_id * 20 AS `to`,
            CASE WHEN event_id % 6 <> 0 THEN event_id % 2 = 0 END AS gross) AS salary,
        concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+0300') AS published_at,
        struct('open' AS id) AS type,
        struct(CASE WHEN event_id % 7 <> 0 THEN props END AS requirement) AS snippet)"""
    items = t.events.selectExpr("event_id div 100 AS page_no", f"{item} AS item")
    # a page holds at most 100 items, whatever the data
    pages = items.groupBy("page_no").agg(F.collect_list("item").alias("items"))
    return pages.select(
        "page_no", F.to_json(F.struct("items", F.lit(1).alias("pages"))).alias("body")
    )


@query(
    "json_flatten",
    """SELECT event_id // 100 AS page_no, CAST(event_id AS VARCHAR) AS vacancy_id, event_type AS vacancy_name,
    user_id AS region,
    CASE WHEN event_id % 5 <> 0 AND event_id % 3 <> 0 THEN CAST(user_id * 10 AS VARCHAR) END AS employer_id,
    CASE WHEN event_id % 5 <> 0 THEN 'Employer ' || user_id END AS employer_name,
    CASE WHEN event_id % 4 <> 0 THEN event_id * 10 END AS salary_min, event_id * 20 AS salary_max,
    CASE WHEN event_id % 6 <> 0 THEN event_id % 2 = 0 END AS gross,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0300' AS published_at, 'open' AS type_vacancy,
    CASE WHEN event_id % 7 <> 0 THEN props END AS requirements FROM events""",
)
def flat_items(t: Tables) -> DataFrame:
    item = json_items(api_pages(t), "body", VACANCY_PAGE, "items", ["page_no"])
    return item.select(
        "page_no", F.col("item.id").alias("vacancy_id"), F.col("item.name").alias("vacancy_name"),
        F.col("item.area.id").cast("bigint").alias("region"), F.col("item.employer.id").alias("employer_id"),
        F.col("item.employer.name").alias("employer_name"), F.col("item.salary.from").alias("salary_min"),
        F.col("item.salary.to").alias("salary_max"), F.col("item.salary.gross").alias("gross"),
        "item.published_at", F.col("item.type.id").alias("type_vacancy"),
        F.col("item.snippet.requirement").alias("requirements"),
    )


@query(
    "json_tree_ids",
    "SELECT s_suppkey // 50 AS tree, CAST(s_suppkey AS INT) AS area_id FROM supplier WHERE s_suppkey % 4 <> 3",
)
def tree_ids(t: Tables) -> DataFrame:
    area = F.struct(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    home = F.col("s_suppkey") % 4 != 3
    trees = t.supplier.withColumn("tree", F.expr("s_suppkey div 50")).groupBy("tree").agg(
        F.collect_list(F.when(home, area)).alias("first"), F.collect_list(F.when(~home, area)).alias("second")
    )
    countries = [
        F.struct(F.lit(str(n)).alias("id"), F.lit(name).alias("name"), F.col(name).alias("areas"))
        for n, name in ((113, "first"), (5, "second"))
    ]
    return json_tree_ids(trees.select("tree", F.to_json(F.array(*countries)).alias("body")), "body", ["tree"])


ENTITIES = """replace(replace(replace(replace(replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '&lt;', '<'),
    '&gt;', '>'), '&quot;', '"'), '&nbsp;', chr(160)), '&amp;', '&')"""


@query(
    "html_links",
    f"""SELECT page_id, CAST(link_no - 1 AS INT) AS link_no, href, {ENTITIES.format('label')} AS label FROM (
    SELECT page_id, unnest(range(1, len(hrefs) + 1)) AS link_no, unnest(hrefs) AS href, unnest(labels) AS label
    FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"[^>]*>', 1) AS hrefs,
    regexp_extract_all(html, '(?s)<a href="[^"]*"[^>]*>(.*?)</a>', 1) AS labels FROM pages))""",
)
def page_links(t: Tables) -> DataFrame:
    return html_links(t.pages, "html", ["page_id"])


@query(
    "html_cards",
    f"""SELECT page_id, 0 AS card_no, regexp_extract(html, '<a href="([^"]*)"', 1) AS href,
    {ENTITIES.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS title,
    CAST(NULL AS VARCHAR) AS employer FROM pages""",
)
def page_cards(t: Tables) -> DataFrame:
    whole = CardMarkup("", "description", "none", title_tag="h1", card_tag="body")
    return html_cards(t.pages, "html", ["page_id"], whole).select(
        "page_id", "card_no", "href", "title", "employer"
    )


@query(
    "page_count",
    """SELECT page_id, CAST(CASE WHEN page_id % 5 = 0 THEN 0 WHEN page_id % 3 <> 0 THEN page_id % 90 + 2
    WHEN page_id * 37 % 8000 < 4000 THEN 0 ELSE 100 END AS INT) AS pages FROM pages""",
)
def pager_pages(t: Tables) -> DataFrame:
    # pages with a pager added: none, a small one, or one that stops at 100
    last = F.when(F.col("page_id") % 3 == 0, F.lit(100)).otherwise(F.col("page_id") % 90 + 2)

    def span(css: str, text) -> F.Column:
        return F.concat(F.lit(f'<span class="{css}-abc" data-x="1">'), text, F.lit("</span>"))

    results = F.col("page_id") * 37 % 8000
    shown = F.concat(F.expr("page_id * 37 % 8000 div 1000"), F.lit(" "), F.format_string("%03d", results % 1000))
    pager = F.concat(
        span(WEB_COUNTER, shown), span(WEB_PAGER, F.lit("1")), span(WEB_PAGER, F.lit("...")),
        span(WEB_PAGER, last.cast("string")), span(WEB_PAGER, F.lit("next")),
    )
    html = F.when(F.col("page_id") % 5 == 0, F.col("html")).otherwise(F.concat("html", pager))
    return t.pages.select("page_id", page_count(html, WEB_PAGER, WEB_COUNTER).alias("pages"))


# Sinks ---------------------------------------------------------------------------------------


@query(
    "append_rows",
    """SELECT o_orderkey, o_orderstatus, CAST(o_orderkey % 2 AS INT) AS load_no,
    (SELECT COUNT(*) FROM orders i WHERE i.o_orderkey % 2 = o.o_orderkey % 2) AS rows_written FROM orders o""",
)
def appended(t: Tables) -> DataFrame:
    store = new_store(t, "append")
    rows = t.orders.select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 2).cast("int").alias("load_no"))

    def append(n: int):
        def work(change: Change) -> int:
            change.create("orders", rows.schema)
            return change.append("orders", rows.filter(F.col("load_no") == n))

        return work

    # a load that is run again finds itself in the store
    counts = [store.commit(f"load {n}", append(n)) for n in (0, 1, 0)]
    written = F.when(F.col("load_no") == 0, F.lit(counts[0])).otherwise(F.lit(counts[1])).cast("bigint")
    return store.table("orders").withColumn("rows_written", written)


@query(
    "audit_log",
    """SELECT 'event' AS event_type, 'orders' AS event_source, n || ' records in state ' || s AS description
    FROM (SELECT o_orderstatus AS s, COUNT(*) AS n FROM orders GROUP BY 1) UNION ALL
    SELECT 'warning', 'orders', 'cheap: ' || COUNT(*) || ' rows' FROM orders WHERE o_totalprice < 50000
    HAVING COUNT(*) > 0""",
)
def audit(t: Tables) -> DataFrame:
    store = new_store(t, "log")
    states = t.orders.groupBy("o_orderstatus").count()
    text = F.concat("count", F.lit(" records in state "), "o_orderstatus")
    store.commit("states", lambda change: append_audit(change, audit_row(states, "event", "orders", text)))
    checks = {"cheap": F.col("o_totalprice") < 50000, "free": F.col("o_totalprice") <= 0}
    found = F.concat("check_name", F.lit(": "), "bad_rows", F.lit(" rows"))
    store.commit("checks", lambda change: append_audit(change, warnings(quality_counts(t.orders, checks), "orders", found)))
    return store.table("log")


# Workbooks -----------------------------------------------------------------------------------


def order_books(t: Tables) -> DataFrame:
    """Workbook bytes with two sheets and up to 250 orders each, written by Spark tasks."""
    row = F.struct(
        F.col("o_orderkey").alias("k"),
        F.array(F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_totalprice").cast("string"),
                F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("first"),
        F.array(F.col("o_orderkey").cast("string"), F.lit(None).cast("string"),
                F.col("o_custkey").cast("string"), F.lit(None).cast("string")).alias("second"),
    )
    books = (
        t.orders.select(F.expr("o_orderkey div 250").alias("book"), row.alias("row"))
        .groupBy("book")  # at most 250 rows each
        .agg(F.array_sort(F.collect_list("row")).alias("rows"))
    )
    return encode_workbooks(
        books.select(
            F.concat(F.lit("orders-"), "book", F.lit(".xlsx")).alias("file"),
            F.array(
                F.struct(F.array(*map(F.lit, ["key", "state", "price", "day"])).alias("headers"),
                         F.col("rows.first").alias("rows")),
                F.struct(F.array(*map(F.lit, ["key", "empty", "customer", "gone"])).alias("headers"),
                         F.col("rows.second").alias("rows")),
            ).alias("sheets"),
        ),
        {"price": "number", "key": "number", "customer": "number", "day": "date"},
    )


@query(
    "scan_workbooks",
    """SELECT 'orders-' || o_orderkey // 250 || '.xlsx' AS file, sheet,
    CAST(row_number() OVER (PARTITION BY sheet, o_orderkey // 250 ORDER BY o_orderkey) AS INT) AS row_no,
    o_orderkey AS k, CASE WHEN sheet = 0 THEN o_orderstatus END AS state,
    CASE WHEN sheet = 0 THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS amount,
    CASE WHEN sheet = 0 THEN CAST(o_orderdate AS DATE) END AS day
    FROM orders, (VALUES (0), (1)) v(sheet)""",
)
def scanned_books(t: Tables) -> DataFrame:
    rows = sheet_rows(decode_workbooks(order_books(t)))
    return rows.select(
        "file", "sheet", "row_no", cell_at(0).cast("bigint").alias("k"), cell_at(1).alias("state"),
        coerce_numeric(cell_at(2)).alias("amount"), parse_date(cell_at(3), R.DATES).alias("day"),
    )


@query(
    "landing_status",
    """SELECT 'orders-' || b || CASE WHEN b % 4 = 3 THEN '.cut' ELSE '.xlsx' END AS file,
    CASE WHEN b % 4 = 3 THEN 'unreadable' ELSE 'read' END AS status, CASE WHEN b % 4 = 3 THEN 0 ELSE 2 END AS sheets,
    CASE WHEN b % 4 = 3 THEN 0 ELSE 2 * n END AS rows
    FROM (SELECT o_orderkey // 250 AS b, COUNT(*) AS n FROM orders GROUP BY 1)""",
)
def landed_status(t: Tables) -> DataFrame:
    """Every fourth workbook was cut off on its way and gives no row at all, but a line in the status."""
    cut = F.regexp_extract("file", r"-(\d+)", 1).cast("int") % 4 == 3
    files = order_books(t).select(
        F.when(cut, F.regexp_replace("file", "xlsx$", "cut")).otherwise(F.col("file")).alias("file"),
        F.when(cut, F.expr("substring(content, 1, CAST(length(content) * 0.6 AS INT))")).otherwise(F.col("content")).alias("content"),
    )
    return landing_status(decode_workbooks(files)).drop("error")


@query(
    "unread_pages",
    "SELECT o_orderkey // 100 AS page_no FROM orders WHERE o_orderkey // 100 % 3 = 2 GROUP BY 1",
)
def pages_unread(t: Tables) -> DataFrame:
    """Pages that arrived cut off; nothing of them is flattened."""
    pages = t.orders.select(F.expr("o_orderkey div 100").alias("page_no")).distinct()
    whole = F.lit('{"items": [], "pages": 1}')
    bodies = pages.withColumn("body", F.when(F.col("page_no") % 3 == 2, F.substring(whole, 1, 12)).otherwise(whole))
    return unread_pages(bodies, "body", VACANCY_PAGE, "items", ["page_no"]).select("page_no")


HEADER_VARIANTS = (
    ("pickers", R.PICKER_HEADER),
    ("couriers", (*R.COURIER_HEADER, "Примечание")),
    ("revenues", R.REVENUE_HEADER),
    (None, (*R.REVENUE_HEADER, "ID2")),
    ("requests", ("ТК", "Тип ресурса", "01.06.22", "Ночь", "Доп потребность")),
    (None, ("ТК", "Тип ресурса", "01.06.22", "Ночь")),
    ("preferences", R.PREFERENCE_HEADER),
    ("preferences", tuple(h for h in R.PREFERENCE_HEADER if h != "phone")),
    ("outputs", R.OUTPUT_HEADER),
    ("hours", (*R.HOURS_HEADER, "01.06.22", "Итого")),
    (None, ("c_custkey",)),
)


@query(
    "route_signature",
    "SELECT file, len(headers) AS columns, CASE"
    f" WHEN headers[1:28] = {sql_list(R.PICKER_HEADER)} THEN 'pickers'"
    f" WHEN headers[1:26] = {sql_list(R.COURIER_HEADER)} THEN 'couriers'"
    f" WHEN headers[1:5] = {sql_list(R.HOURS_HEADER)} THEN 'hours'"
    f" WHEN headers = {sql_list(R.REVENUE_HEADER)} THEN 'revenues'"
    f" WHEN headers[1:2] = {sql_list(R.REQUEST_HEADER)} AND list_contains(headers, 'Ночь')"
    " AND list_contains(headers, 'Доп потребность') THEN 'requests'"
    f" WHEN headers = {sql_list(R.PREFERENCE_HEADER)} OR"
    f" headers = {sql_list(h for h in R.PREFERENCE_HEADER if h != 'phone')} THEN 'preferences'"
    f" WHEN headers = {sql_list(R.OUTPUT_HEADER)} THEN 'outputs' END AS kind"
    " FROM (SELECT c_custkey AS file, CASE c_custkey % 11 "
    + " ".join(f"WHEN {i} THEN {sql_list(h)}" for i, (_, h) in enumerate(HEADER_VARIANTS))
    + " END AS headers FROM customer)",
)
def routed(t: Tables) -> DataFrame:
    variants = F.array(*[F.array(*map(F.lit, h)) for _, h in HEADER_VARIANTS])
    files = t.customer.select(
        F.col("c_custkey").alias("file"), F.get(variants, (F.col("c_custkey") % 11).cast("int")).alias("headers")
    )
    return route(files, R.SIGNATURES, "headers").select(
        "file", F.size("headers").cast("bigint").alias("columns"), "kind"
    )


@query(
    "drop_unnamed",
    """SELECT c_custkey AS file, col_no, header FROM (SELECT c_custkey, CAST(col_no AS INT) AS col_no,
    CASE WHEN (c_custkey + col_no) % 4 = 0 THEN 'Unnamed: ' || col_no ELSE c_mktsegment || col_no END AS header
    FROM customer, range(1, 7) r(col_no)) WHERE header NOT LIKE '%Unnamed:%'""",
)
def named_headers(t: Tables) -> DataFrame:
    cells = t.customer.select(
        "c_custkey", "c_mktsegment", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("col_no")
    )
    empty = (F.col("c_custkey") + F.col("col_no")) % 4 == 0
    header = F.when(empty, F.concat(F.lit("Unnamed: "), "col_no")).otherwise(F.concat("c_mktsegment", "col_no"))
    return drop_unnamed(cells.select(F.col("c_custkey").alias("file"), "col_no", header.alias("header")), "header")


@query(
    "column_range",
    """SELECT c_custkey AS file, unnest(range(3, 3 + c_custkey % 4)) AS col_no,
    unnest(list_transform(range(1, 1 + c_custkey % 4), lambda i: c_mktsegment || i)) AS header FROM customer""",
)
def between_columns(t: Tables) -> DataFrame:
    count = (F.col("c_custkey") % 4).cast("int")
    all_days = F.transform(F.array(*map(F.lit, (1, 2, 3))), lambda i: F.concat("c_mktsegment", i))
    headers = F.concat(
        F.array(F.lit("ТК"), F.lit("Тип ресурса")), F.slice(all_days, F.lit(1), count),
        F.array(F.lit("Ночь"), F.lit("Доп потребность")),
    )
    files = t.customer.select(F.col("c_custkey").alias("file"), headers.alias("headers"))
    places = files.select("*", F.explode(column_range(F.col("headers"), "Тип ресурса", "Ночь")).alias("col_no"))
    return places.select("file", "col_no", F.get("headers", (F.col("col_no") - 1).cast("int")).alias("header"))


@query(
    "date_headers",
    """SELECT file, CAST(i - 1 AS INT) AS col_no, day FROM (SELECT c_custkey AS file, i,
    CASE i WHEN 2 THEN DATE '2022-06-01' + CAST(c_custkey % 30 AS INT)
    WHEN 3 THEN DATE '1995-06-01' + CAST(c_custkey % 30 AS INT)
    WHEN 4 THEN CASE WHEN c_custkey % 2 = 0 THEN DATE '2022-07-31' END END AS day
    FROM customer, range(1, 6) r(i)) WHERE day IS NOT NULL""",
)
def header_days(t: Tables) -> DataFrame:
    step = (F.col("c_custkey") % 30).cast("int")
    headers = F.array(
        F.col("c_name"),
        F.date_format(F.date_add(F.lit("2022-06-01").cast("date"), step), "dd.MM.yy"),
        F.date_format(F.date_add(F.lit("1995-06-01").cast("date"), step), "dd.MM.yy"),
        F.when(F.col("c_custkey") % 2 == 0, "2022-07-31 00:00:00").otherwise("Итого"),
        F.lit("31.02.22"),
    )
    found = F.explode(dated_columns(headers, R.DATES)).alias("d")
    return t.customer.select(F.col("c_custkey").alias("file"), found).select(
        "file", F.col("d.at").alias("col_no"), F.col("d.day").alias("day")
    )


@query(
    "trim_edges",
    """SELECT user_id, event_id, event_type FROM (SELECT *, MIN(event_id) OVER (PARTITION BY user_id) AS lo,
    MAX(event_id) OVER (PARTITION BY user_id) AS hi FROM events) WHERE event_id > lo AND event_id < hi""",
)
def trimmed(t: Tables) -> DataFrame:
    return trim_edges(t.events.select("user_id", "event_id", "event_type"), ["user_id"], "event_id")
