"""Projections, filters, cleaning, code mapping and classification."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from rosterlake.catalog.base import Tables, query, with_fx
from rosterlake.catalog.scans import LANDED_SQL, landed
from rosterlake.functions import coerce_numeric, first_integer, parse_date, prefix_code, strip, whole
from rosterlake.operators.clean import (
    clean_nonfinite, drop_optional, fill_activation, fill_defaults, snapshot_predicate, with_constants,
)
from rosterlake.operators.mapping import Rule, classify, map_codes, map_codes_table
from rosterlake.operators.quality import quality_counts, warnings
from rosterlake.plans import reports as R
from rosterlake.plans.pay import COURIER_DEFAULT_SPECIALITY, COURIER_SPECIALITY
from rosterlake.plans.vacancies import API_RULES, WEB_RULES
from rosterlake.sources.landing import landing_metadata


@query(
    "fill_defaults",
    """SELECT o_orderkey, COALESCE(CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END, 0) AS price,
    COALESCE(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END, '') AS priority FROM orders""",
)
def filled(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price",
        "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority",
    )
    return fill_defaults(rows, {"price": 0.0, "priority": ""})


def _odd_quantities(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber",
        "CASE l_linenumber WHEN 1 THEN double('NaN') WHEN 2 THEN double('Infinity') "
        "WHEN 3 THEN double('-Infinity') WHEN 4 THEN NULL ELSE l_quantity END AS quantity",
    )


@query(
    "clean_nonfinite",
    """SELECT l_orderkey, l_partkey, l_linenumber,
    CASE WHEN l_linenumber > 4 THEN l_quantity END AS quantity FROM lineitem""",
)
def finite_or_null(t: Tables) -> DataFrame:
    return clean_nonfinite(_odd_quantities(t), ["quantity"])


@query(
    "clean_nonfinite_default",
    """SELECT l_orderkey, l_partkey, l_linenumber,
    CASE WHEN l_linenumber > 4 THEN l_quantity ELSE 0 END AS quantity FROM lineitem""",
)
def finite_or_zero(t: Tables) -> DataFrame:
    return clean_nonfinite(_odd_quantities(t), ["quantity"], 0.0)


@query("drop_optional", "SELECT c_custkey, c_name FROM customer")
def optional_dropped(t: Tables) -> DataFrame:
    with_phone = t.customer.select("c_custkey", "c_name", F.col("c_acctbal").alias("phone"))
    without = t.customer.select("c_custkey", "c_name").filter("c_custkey % 2 = 1")
    return drop_optional(with_phone.filter("c_custkey % 2 = 0"), "phone").unionByName(
        drop_optional(without, "phone")
    )


@query(
    "provenance",
    f"""SELECT doc_id, 20 AS project_id, 3 AS speciality_id, TRY_CAST(split_part(file, '.', 2) AS DATE) AS file_date,
    CASE WHEN doc_id % 50 <> 0 THEN 'report.' || doc_id || '.xlsx' END AS filename FROM ({LANDED_SQL})""",
)
def stamped(t: Tables) -> DataFrame:
    rows = landing_metadata(landed(t), "file")
    return with_constants(rows, {"project_id": 20, "speciality_id": 3}).select(
        "doc_id", "project_id", "speciality_id", "file_date", "filename"
    )


@query(
    "prefix_code",
    """SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN 'ТК' || p_partkey
    ELSE 'ТК' || p_partkey END AS code FROM part""",
)
def store_codes(t: Tables) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 9 == 0, F.lit(None)).when(
        F.col("p_partkey") % 3 == 0, F.concat(F.lit("ТК"), "p_partkey")
    ).otherwise(F.col("p_partkey").cast("string"))
    return t.part.select("p_partkey", prefix_code(raw, "ТК").alias("code"))


@query(
    "first_integer",
    """SELECT p_partkey, COALESCE(TRY_CAST(regexp_extract(raw, '[0-9]+') AS BIGINT), 0) AS number FROM (
    SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN p_name
    ELSE p_brand || '/' || p_size END AS raw FROM part)""",
)
def leading_numbers(t: Tables) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 6 == 0, F.lit(None)).when(F.col("p_partkey") % 5 == 0, F.col("p_name"))
    text = raw.otherwise(F.concat("p_brand", F.lit("/"), "p_size"))
    return t.part.select("p_partkey", first_integer(text).alias("number"))


@query(
    "coerce_numeric",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL
    WHEN 2 THEN o_custkey + 0.5 ELSE o_custkey END::DOUBLE AS amount,
    CASE WHEN o_orderkey % 5 > 2 THEN o_custkey END AS code FROM orders""",
)
def coerced(t: Tables) -> DataFrame:
    text = (
        "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CASE o_orderkey % 3 WHEN 0 THEN concat('n/a ', o_custkey) "
        "WHEN 1 THEN concat(o_custkey, 'd') ELSE concat('0x', o_custkey, 'p3') END "
        "WHEN 2 THEN concat(o_custkey, '.5') WHEN 3 THEN concat(' ', o_custkey, ' ') "
        "ELSE CAST(o_custkey AS STRING) END"
    )
    rows = t.orders.selectExpr("o_orderkey", f"{text} AS text")
    is_whole = ~F.contains("text", F.lit("."))
    return rows.select(
        "o_orderkey", coerce_numeric(F.col("text")).alias("amount"),
        F.when(is_whole, coerce_numeric(F.col("text"), "bigint")).alias("code"),
    )


@query(
    "parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""",
)
def parsed_days(t: Tables) -> DataFrame:
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, F.date_format(day, "yyyy/M/d"))
        .when((kind == 1) & (F.col("o_custkey") % 2 == 0), F.date_format(day, "dd.MM.yy"))
        .when(kind == 1, F.date_format(day, "d.M.yy"))
        .when(kind == 2, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 3, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.col("o_orderpriority"))
    )
    return t.orders.select("o_orderkey", parse_date(text, R.DATES).alias("day"))


@query(
    "typed_casts",
    """SELECT event_id, COALESCE(CASE WHEN event_id % 3 <> 0 THEN event_id % 2 = 0 END, FALSE) AS flag,
    CAST(trunc(value) AS BIGINT) AS whole_value, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    CAST(ts AS DATE) AS day FROM events""",
)
def typed(t: Tables) -> DataFrame:
    flag = F.when(F.col("event_id") % 3 != 0, F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"))
    return t.events.select(
        "event_id", F.coalesce(flag.cast("boolean"), F.lit(False)).alias("flag"),
        whole(F.col("value")).alias("whole_value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"), F.to_date("ts").alias("day"),
    )


@query(
    "strip_text",
    "SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer",
)
def stripped(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit("  \t"))
    return t.customer.select("c_custkey", F.lower(strip(padded)).alias("segment"))


SEGMENTS = {"BUILDING": 1, "MACHINERY": 2, "HOUSEHOLD": 3}


@query(
    "map_codes",
    """SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 7 WHEN c_mktsegment = 'BUILDING' THEN 1
    WHEN c_mktsegment = 'MACHINERY' THEN 2 WHEN c_mktsegment = 'HOUSEHOLD' THEN 3 ELSE 0 END AS code FROM customer""",
)
def mapped(t: Tables) -> DataFrame:
    label = F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", map_codes(label, SEGMENTS, 0, 7).alias("code"))


@query(
    "map_codes_table",
    """SELECT c_custkey, 'NATION_' || c_custkey % 30 AS label, COALESCE(n_nationkey, -1) AS code
    FROM customer LEFT JOIN nation ON n_name = 'NATION_' || c_custkey % 30""",
)
def mapped_by_table(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.concat(F.lit("NATION_"), F.col("c_custkey") % 30).alias("label"))
    return map_codes_table(rows, "label", t.nation, "n_name", "n_nationkey", "code", -1)


@query(
    "remap_codes",
    with_fx(
        "SELECT id, CASE transport_id WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 4 THEN 2 ELSE 1 END AS speciality_id FROM fx_work",
        "fx_work",
    ),
)
def remapped(t: Tables) -> DataFrame:
    code = map_codes(F.col("transport_id"), COURIER_SPECIALITY, COURIER_DEFAULT_SPECIALITY)
    return t.fx_work().select("id", code.alias("speciality_id"))


@query(
    "unmapped_warning",
    """SELECT 'warning' AS event_type, 'customer' AS event_source,
    f || ' is 0 in ' || n || ' rows' AS description FROM (
    SELECT 'segment' AS f, COUNT(*) AS n FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
    UNION ALL SELECT 'nation', COUNT(*) FROM customer WHERE c_nationkey < 0) WHERE n > 0""",
)
def unmapped(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("code", map_codes(F.col("c_mktsegment"), SEGMENTS))
    counts = quality_counts(rows, {"segment": F.col("code") == 0, "nation": F.col("c_nationkey") < 0})
    text = F.format_string("%s is 0 in %d rows", F.col("check_name"), F.col("bad_rows"))
    return warnings(counts, "customer", text)


# Titles built from fragments, so that every rule and overwrite occurs.
HEADS = (
    "Водитель-курьер", "Курьер-водитель", "водитель - курьер", "Водитель курьер", "курьер водитель",
    "Водитель на доставку", "Авто-курьер", "Автокурьер", "Велокурьер", "Вело-курьер", "Мотокурьер",
    "Пеший курьер", "Курьер пеший", "Сборщик заказов", "Сборщик-курьер", "Комплектовщик заказов",
    "Сборщик (комплектовщик) заказов", "Водитель экспедитор", "Курьер", "Водителем курьером",
    "Курьер-почтальон (на авто)", "Водители курьеры", "Сбор товаров", "Комплектовка заказов",
    "Сборщик продуктов", "Курьер (вело)", "Курьер на велосипеде", "Курьер на служебном автомобиле",
    "Водитель на автомобиль компании / личном автомобиле", "Менеджер",
)
TAILS = (
    "", " на личном авто", " собственный транспорт", " на своем авто", " с автомобилем", " на авто компании",
    " на грузовом", " со своим авто", " с личным авто", " и сборщик", " с авто", " на авто",
)


def titles(t: Tables) -> DataFrame:
    heads, tails = F.array(*map(F.lit, HEADS)), F.array(*map(F.lit, TAILS))
    head = F.get(heads, (F.col("p_partkey") % len(HEADS)).cast("int"))
    tail = F.get(tails, F.expr(f"CAST(p_partkey div {len(HEADS)} % {len(TAILS)} AS INT)"))
    return t.part.select("p_partkey", F.concat(head, tail).alias("title"))


def _sql_texts(texts: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in texts) + "]"


TITLES_SQL = f"""SELECT p_partkey, {_sql_texts(HEADS)}[p_partkey % {len(HEADS)} + 1] ||
    {_sql_texts(TAILS)}[(p_partkey // {len(HEADS)}) % {len(TAILS)} + 1] AS title FROM part"""


def rules_sql(rules: Sequence[Rule], title: str, source: str, keep: str, out: str) -> str:
    """Rules applied one after another: each step overwrites the class of the step before."""
    sql = f"SELECT {keep}, {title}, 0 AS {out} FROM ({source})"
    for rule in rules:
        tests = [f"{title} = '{rule.equals}'"] if rule.equals else [f"contains({title}, '{p}')" for p in rule.parts]
        if rule.only_if is not None:
            tests.append(f"{out} = {rule.only_if}")
        step = f"CASE WHEN {' AND '.join(tests)} THEN {rule.code} ELSE {out} END AS {out}"
        sql = f"SELECT {keep}, {title}, {step} FROM ({sql})"
    return sql


_LOWERED = f"SELECT p_partkey, lower(title) AS title FROM ({TITLES_SQL})"


@query(
    "classify_titles",
    f"""SELECT a.p_partkey, a.title, a.api_class, w.web_class
    FROM ({rules_sql(API_RULES, 'title', _LOWERED, 'p_partkey', 'api_class')}) a
    JOIN ({rules_sql(WEB_RULES, 'title', _LOWERED, 'p_partkey', 'web_class')}) w USING (p_partkey)""",
)
def classified(t: Tables) -> DataFrame:
    rows = titles(t).withColumn("title", F.lower("title"))
    return classify(classify(rows, "title", "api_class", API_RULES), "title", "web_class", WEB_RULES)


def _gappy_orders() -> list[str]:
    return [
        "o_orderkey", "CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price",
        "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status",
    ]


@query(
    "filter_3vl",
    f"""SELECT o_orderkey FROM (SELECT {', '.join(_gappy_orders())} FROM orders)
    WHERE NOT (price > 200000 OR status = 'F')""",
)
def three_valued(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(*_gappy_orders())
    return rows.filter(~((F.col("price") > 200000) | (F.col("status") == "F"))).select("o_orderkey")


@query(
    "snapshot_predicate",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O' OR o_orderstatus <> 'O'
    AND CAST(o_orderdate AS DATE) = DATE '1997-03-09'""",
)
def current_orders(t: Tables) -> DataFrame:
    kept = snapshot_predicate(
        F.col("o_orderstatus") == "O", F.col("o_orderdate"), F.lit(date(1997, 3, 9))
    )
    return t.orders.filter(kept).select("o_orderkey", "o_orderstatus")


@query(
    "fill_activation",
    """SELECT event_id, COALESCE(s, CASE WHEN e IS NULL THEN CAST(day AS TIMESTAMP) + INTERVAL 6 HOUR
    ELSE e - to_minutes(30 * h) END) AS first_activation,
    COALESCE(e, COALESCE(s, CAST(day AS TIMESTAMP) + INTERVAL 6 HOUR) + to_minutes(30 * h)) AS last_deactivation
    FROM (SELECT event_id, CAST(ts AS DATE) AS day, CAST(event_id % 20 AS INT) AS h,
    CASE WHEN event_id % 3 <> 0 THEN ts END AS s, CASE WHEN event_id % 4 <> 0 THEN ts + INTERVAL 5 HOUR END AS e
    FROM events)""",
)
def activations(t: Tables) -> DataFrame:
    rows = t.events.selectExpr(
        "event_id", "CAST(ts AS DATE) AS day", "event_id % 20 / 2.0 AS hours",
        "CASE WHEN event_id % 3 <> 0 THEN ts END AS first_activation",
        "CASE WHEN event_id % 4 <> 0 THEN ts + INTERVAL '5' HOUR END AS last_deactivation",
    )
    return fill_activation(rows, "first_activation", "last_deactivation", "hours", "day").select(
        "event_id", "first_activation", "last_deactivation"
    )
