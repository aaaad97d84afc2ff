"""Loads into a store: several deliveries, several writers, and batches that are run again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from rosterlake.catalog.base import ORACLES, Tables, new_store, query, with_fx
from rosterlake.catalog.ingests import (
    DIVISION_LABELS, SENDER, _COURIER_CTES, _OUTPUT, _ORGS, _STORES, _code_sql, _grown, _labels_sql, addresses, cells_of, chunks, courier_chunks,
    dimensions, file_day, found_api_vacancies, hours_chunks, landing_name, output_chunks, picker_chunks, preference_chunks,
    request_chunks, revenue_chunks, stores_and_organisations, texts,
)
from rosterlake.catalog.logs import start_names
from rosterlake.catalog.pay import courier_inputs
from rosterlake.operators.quarantine import held_name
from rosterlake.operators.store import Change, Store
from rosterlake.plans import reports as R, stored
from rosterlake.plans.pay import COURIER_FACTS, MONTHS
from rosterlake.plans.shift_reports import PICKER_COLUMNS
from rosterlake.plans.vacancies import API_COLUMNS
from rosterlake.session import LARGE_ROWS, run_folder, settle
from rosterlake.sources.landing import landing_metadata
from rosterlake.streaming.ingest import commit_batches, landing_stream, reports_new

# Dictionaries --------------------------------------------------------------------------------

_ODD = "o_orderkey // 250 % 2 = 1"


@query(
    "dict_stored",
    with_fx(
        """SELECT a.tk_id, a.tk_name, COUNT(r.k) AS shifts FROM after a LEFT JOIN (SELECT DISTINCT 'ТК' || o_custkey % 40 AS tk_name,
        o_custkey || ' ' || CAST(o_orderdate AS DATE) AS k FROM orders) r ON r.tk_name = a.tk_name GROUP BY ALL""",
        stores=_STORES,
        odd=f"SELECT DISTINCT 'ТК' || o_custkey % 40 AS tk_name FROM orders WHERE {_ODD} AND o_custkey % 3 = 0",
        even="SELECT DISTINCT 'ТК' || o_custkey % 40 AS tk_name FROM orders",
        first=_grown("stores", "tk_id", "tk_name", "odd"), after=_grown("first", "tk_id", "tk_name", "even"),
    ),
)
def names_kept(t: Tables) -> DataFrame:
    """Names of two loads at once and of one delivered again: each has one id, and shifts are stored under it."""
    store = new_store(t, "names")
    start_names(t, store)
    sheets = courier_chunks(t)
    # the second load brings some of the first one's couriers, and is there first
    some = sheets.filter("CAST(regexp_extract(file, 'shifts-(\\\\d+)', 1) AS BIGINT) % 2 = 1").withColumn(
        "rows", F.expr("filter(rows, r -> CAST(substr(r[array_position(headers, 'КПП Курьера') - 1], 2) AS BIGINT) % 3 = 0)"))
    first = [lambda: store.commit("some", lambda change: stored.merge_couriers(change, some))]

    def load(change: Change) -> dict[str, int]:
        counts = stored.merge_couriers(change, sheets)
        if first:
            first.pop()()
        return counts

    store.commit("all", load)
    store.commit("again", lambda change: stored.merge_couriers(change, some))
    shifts = store.table(stored.COURIERS).groupBy("tk_id").agg(F.count("*").alias("n"))
    return store.table(stored.TKS).join(shifts, "tk_id", "left").select("tk_id", "tk_name", F.coalesce("n", F.lit(0)).alias("shifts"))


@query(
    "dict_log",
    with_fx(
        """SELECT 'event' AS event_type, 'dictionaries' AS event_source, d || ': new names ' || n AS description FROM (
        SELECT 'tks' AS d, (SELECT COUNT(*) FROM all_stores) - (SELECT COUNT(*) FROM stores) AS n
        UNION ALL SELECT 'organisations', (SELECT COUNT(*) FROM all_orgs) - (SELECT COUNT(*) FROM orgs)) WHERE n > 0""",
        **_COURIER_CTES,
    ),
)
def names_logged(t: Tables) -> DataFrame:
    """A load logs how many names it brought into each dictionary, once, however often it is run."""
    store = new_store(t, "names")
    start_names(t, store)
    for _ in range(2):
        store.commit("one", lambda change: stored.merge_couriers(change, courier_chunks(t)))
    return stored.run_log(store).filter("event_source = 'dictionaries'")


# Shifts --------------------------------------------------------------------------------------

_PICKED = {
    "picker_id": "picker_id", "employee_id": "employee_id", "tk_id": "a.tk_id",
    "division_id": _code_sql("division", R.DIVISIONS, 7), "date_": "date_", "picker_name": "CAST(NULL AS VARCHAR)",
    "organisation_id": "g.organisation_id", "first_activation": "CAST(date_ AS TIMESTAMP) + INTERVAL 6 HOUR",
    "last_deactivation": "CAST(date_ AS TIMESTAMP) + INTERVAL 6 HOUR", "picked_SKU": "picked",
    "SLA_reaction": "ROUND(sla, 4)", "SLA_pick": "ROUND(pick, 4)", "filename": "filename", "file_date": "file_date",
}


@query(
    "pickers_stored",
    with_fx(
        "SELECT " + ", ".join(f"{_PICKED.get(c, 'CAST(0 AS DOUBLE)')} AS {c}" for c in PICKER_COLUMNS)
        + """ FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY picker_id, date_
        ORDER BY step DESC, file_date DESC, filename DESC, event_id DESC) AS rn FROM raw) WHERE rn = 1) r
        JOIN names a ON a.tk_name = r.tk_name JOIN orgs2 g ON g.organisation_name = r.organisation_name""",
        stores=_STORES,
        orgs=_ORGS,
        raw=f"""SELECT event_id, 'P' || user_id AS picker_id, user_id AS employee_id, 'ТК' || user_id % 40 AS tk_name,
        'Org ' || user_id % 12 AS organisation_name, {_labels_sql(DIVISION_LABELS, 'event_id')} AS division,
        CAST(ts AS DATE) AS date_, CAST('0.' || lpad(CAST(event_id % 10000 * 10 + 3 AS VARCHAR), 6, '0') AS DOUBLE) AS sla,
        CASE WHEN event_id % 9 = 0 THEN 0 ELSE CAST('0.0' || event_id % 10000 || '3' AS DOUBLE) END AS pick,
        CAST(event_id % 50 AS DOUBLE) AS picked, 'p' || event_id // 250 AS filename,
        DATE '2022-06-01' + CAST(event_id // 250 % 20 AS INT) AS file_date, 1 - event_id // 250 % 2 AS step FROM events""",
        one="SELECT tk_name, organisation_name FROM raw WHERE step = 0",
        two="SELECT tk_name, organisation_name FROM raw WHERE step = 1",
        names1=_grown("stores", "tk_id", "tk_name", "one"), names=_grown("names1", "tk_id", "tk_name", "two"),
        orgs1=_grown("orgs", "organisation_id", "organisation_name", "one"),
        orgs2=_grown("orgs1", "organisation_id", "organisation_name", "two"),
    ),
)
def pickers_on_disk(t: Tables) -> DataFrame:
    """Two deliveries of picker shifts, of the odd books and then of the even ones, with all columns."""
    store = new_store(t, "pickers")
    start_names(t, store)
    book = "CAST(regexp_extract(file, 'p(\\\\d+)$', 1) AS BIGINT) % 2"
    for step in (1, 0):
        sheets = picker_chunks(t).filter(f"{book} = {step}")
        store.commit(f"books {step}", lambda change, x=sheets: stored.merge_pickers(change, x))
    return store.table(stored.PICKERS).select(*PICKER_COLUMNS)


@query(
    "log_pricing",
    with_fx(
        f"""SELECT 'event' AS event_type, 'courier pay' AS event_source, 'days ' || COUNT(DISTINCT date_) || ', rows ' || COUNT(*) AS description
        FROM fx_work WHERE date_ IN (SELECT date_ FROM fx_work WHERE full_payment_client IS NULL)
        UNION ALL SELECT 'warning', 'courier pay', 'no tariff for region ' || region_id || ', speciality ' || speciality_id || ' on '
        || date_ || ': ' || COUNT(*) || ' shifts' FROM ({ORACLES["unmatched_tariffs"]}) GROUP BY date_, region_id, speciality_id
        UNION ALL SELECT 'warning', 'courier pay', 'tariff ' || tariff_id || ' has ' || rows_found || ' prices of field ' || field_id
        FROM ({ORACLES["repeated_prices"]})""", "fx_work",
    ),
)
def pricing_logged(t: Tables) -> DataFrame:
    """What pricing logs: days and rows written, shifts without a tariff, and fields that a tariff prices twice."""
    work, tks, tariffs, prices = courier_inputs(t)
    table = work.withColumn("full_payment_client", F.col("full_payment_client").cast("double"))
    store = new_store(t, "pay")

    def before(change: Change) -> int:
        change.create(stored.COURIERS, table.schema, MONTHS, COURIER_FACTS)
        return change.append(stored.COURIERS, table)

    store.commit("before", before)
    store.commit("pay", lambda change: stored.price_couriers(change, tks, tariffs, prices))
    return stored.run_log(store)


@query("pending_facts", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_ FROM orders WHERE o_orderstatus = 'O'")
def pending_known(t: Tables) -> DataFrame:
    """Days that miss a result, as a stored table's version tells them without reading a row."""
    from rosterlake.plans.pay import pending_days

    store = new_store(t, "pending")
    work = t.fx_work()

    def before(change: Change) -> int:
        change.create(stored.COURIERS, work.schema, MONTHS, COURIER_FACTS)
        return change.append(stored.COURIERS, work)

    store.commit("before", before)
    return pending_days(Change(store, store.snapshot()), stored.COURIERS)


# Other reports -------------------------------------------------------------------------------


def _twice(store: Store, load) -> None:
    """The same batch two times, as a job does that was restarted after it had committed."""
    for _ in range(2):
        store.commit("one", load)


@query("revenues_stored", ORACLES["ingest_revenues"])
def revenues_once(t: Tables) -> DataFrame:
    store = new_store(t, "revenues")
    _twice(store, lambda change: stored.append_revenues(change, revenue_chunks(t), dimensions(t)))
    return store.table(stored.REVENUES)


@query(
    "revenues_held",
    """WITH o AS (SELECT o_orderkey // 200 AS b, o_orderkey % 19 = 0 OR o_orderkey % 6 = 5 AS gap FROM orders),
    f AS (SELECT b, bool_or(gap) AS bad, COUNT(*) AS n, COUNT(*) FILTER (gap) AS gaps FROM o GROUP BY b)
    SELECT 'rev-' || b || '.xlsx' AS filename, CASE WHEN bad AND (b % 2 = 0 OR n = gaps) THEN 'held' ELSE 'stored' END AS state,
    CASE WHEN bad AND b % 2 = 1 AND n > gaps THEN n - gaps ELSE n END AS n_rows,
    CASE WHEN bad AND (b % 2 = 0 OR n = gaps) THEN gaps ELSE 0 END AS n_bad FROM f""",
)
def revenues_held_back(t: Tables) -> DataFrame:
    """Files with gaps are held; every second one is then delivered again without the rows that had them."""
    store, dims = new_store(t, "held"), dimensions(t)
    _twice(store, lambda change: stored.append_revenues(change, revenue_chunks(t), dims, strict=True))
    held = store.table(held_name(stored.REVENUES)).select("filename").distinct()
    again = revenue_chunks(t, "o_orderkey div 200 % 2 = 1 AND o_orderkey % 19 <> 0 AND o_orderkey % 6 <> 5")
    again = landing_metadata(again, "file").join(settle(held, "held_files"), "filename", "left_semi").select(*again.columns)
    store.commit("corrected", lambda change: stored.append_revenues(change, again, dims, strict=True))
    counted = {"stored": store.table(stored.REVENUES).withColumn("reasons", F.lit("")), "held": store.table(held_name(stored.REVENUES))}
    rows = [r.groupBy("filename").agg(F.lit(state).alias("state"), F.count("*").alias("n_rows"), F.count_if(F.col("reasons") != "").alias("n_bad"))
            for state, r in counted.items()]
    return rows[0].unionByName(rows[1])


@query("requests_stored", ORACLES["ingest_requests"])
def requests_once(t: Tables) -> DataFrame:
    store = new_store(t, "requests")
    start_names(t, store)
    _twice(store, lambda change: stored.append_requests(change, request_chunks(t)))
    return store.table(stored.REQUESTS)


_OUTPUT_ALL = (*_OUTPUT, "schedule_date", "filename", "fix_date", "horario_reparto_id")


def _outputs_sql(values: dict[str, str], day: str, file: str, fixed: str, where: str, step: int) -> str:
    columns = ", ".join(f"CAST({e} AS VARCHAR) AS {c}" for c, e in values.items())
    return f"""SELECT {columns}, {day} AS schedule_date, {file} AS filename, {fixed} AS fix_date,
        CAST(o_orderkey AS VARCHAR) AS horario_reparto_id, {step} AS step FROM orders WHERE {where}"""


_MOVED = {**_OUTPUT, "city": "'moved'"}


@query(
    "outputs_stored",
    f"""SELECT {", ".join(_OUTPUT_ALL)} FROM (SELECT *, row_number() OVER (PARTITION BY horario_reparto_id ORDER BY step DESC) AS rn FROM (
    {_outputs_sql(_OUTPUT, "CAST(o_orderdate AS DATE)", "'out-' || o_orderkey // 300",
                  "DATE '2022-06-01' + CAST(o_orderkey // 300 % 20 AS INT)", "true", 0)}
    UNION ALL {_outputs_sql(_MOVED, "CAST(o_orderdate AS DATE) + 40", "'late'", "DATE '2022-07-01'", "o_orderkey % 3 = 0", 1)})) WHERE rn = 1""",
)
def outputs_on_disk(t: Tables) -> DataFrame:
    """Two deliveries of shift outputs; the second moves a third of the shifts to another date."""
    store = new_store(t, "outputs")
    values = {**_MOVED, "schedule_date": "date_format(date_add(CAST(o_orderdate AS DATE), 40), 'yyyy-MM-dd')", "horario_reparto_id": "o_orderkey"}
    rows = t.orders.filter("o_orderkey % 3 = 0").withColumn("book", F.expr("o_orderkey div 300"))
    late = chunks(rows, "o_orderkey", landing_name(F.lit("late"), F.lit(date(2022, 7, 1)), F.lit(SENDER)), F.lit(0),
                  texts(R.OUTPUT_HEADER), cells_of(R.OUTPUT_HEADER, values))
    for step, sheets in enumerate((output_chunks(t), late)):
        store.commit(f"delivery {step}", lambda change, x=sheets: stored.merge_outputs(change, x))
    return store.table(stored.OUTPUTS).select(*_OUTPUT_ALL)


# Preferences: column of the stored table and its SQL for delivery n; what is not named is null.
_GIVEN = ("first_name", "zones", "day_of_week_number", "time_start", "couriers_intervals_last_update")
_BLANKS = ("zones", "day_of_week_number", "time_start", "couriers_intervals_last_update")
_DAYS = (date(2024, 2, 1), date(2024, 2, 2), date(2024, 2, 4))


def _delivery_sql(n: int) -> dict[str, str]:
    day, file = f"DATE '{_DAYS[n]}'", f"'prefs-{n}.xlsx'"
    before = "SELECT NULL::BIGINT AS courier_id, NULL::DATE AS preferred_date, NULL AS first_name, NULL AS zones, NULL::INT AS day_of_week_number, " \
             "NULL AS time_start, NULL::TIMESTAMP AS couriers_intervals_last_update, NULL AS filename, NULL::DATE AS file_date WHERE false"
    state = f"SELECT * FROM state{n - 1}" if n else before
    differs = " OR ".join(f"COALESCE(n.{c} <> b.{c}, FALSE)" for c in _GIVEN)
    return {
        f"last{n}": f"""SELECT * FROM (SELECT user_id AS courier_id, CAST(isodow(ts) AS INT) AS day_of_week_number, 'N' || user_id AS first_name,
            event_type AS zones, CASE WHEN event_id % 4 <> 0 THEN CAST((event_id + {n}) % 24 AS VARCHAR) END AS time_start,
            CASE WHEN (event_id + {n}) % 29 <> 0 THEN date_trunc('second', ts) END AS couriers_intervals_last_update,
            row_number() OVER (PARTITION BY user_id, isodow(ts) ORDER BY event_id DESC) AS rn FROM events WHERE event_id % 4 <> {n}) WHERE rn = 1""",
        f"before{n}": state,
        f"blanked{n}": f"""SELECT courier_id, preferred_date, first_name, {', '.join(f'CASE WHEN NOT hit THEN {c} END AS {c}' for c in _BLANKS)},
            CASE WHEN hit THEN {file} ELSE filename END AS filename, CASE WHEN hit THEN {day} ELSE file_date END AS file_date FROM (
            SELECT *, courier_id IN (SELECT courier_id FROM last{n} WHERE couriers_intervals_last_update IS NULL)
            AND preferred_date BETWEEN {day} + 3 AND {day} + 5 AND preferred_date <= (SELECT MAX(preferred_date) FROM before{n}) AS hit FROM before{n})""",
        f"dated{n}": f"""SELECT l.*, d.preferred_date FROM last{n} l JOIN (VALUES ({day} + 3), ({day} + 4), ({day} + 5)) d(preferred_date)
            ON isodow(d.preferred_date) = l.day_of_week_number WHERE couriers_intervals_last_update IS NOT NULL""",
        f"state{n}": f"""SELECT COALESCE(b.courier_id, n.courier_id) AS courier_id, COALESCE(b.preferred_date, n.preferred_date) AS preferred_date,
            {', '.join(f'CASE WHEN n.courier_id IS NULL THEN b.{c} ELSE n.{c} END AS {c}' for c in _GIVEN)},
            CASE WHEN n.courier_id IS NOT NULL AND (b.courier_id IS NULL OR {differs}) THEN {file} ELSE b.filename END AS filename,
            CASE WHEN n.courier_id IS NOT NULL AND (b.courier_id IS NULL OR {differs}) THEN {day} ELSE b.file_date END AS file_date
            FROM blanked{n} b FULL JOIN dated{n} n ON b.courier_id = n.courier_id AND b.preferred_date = n.preferred_date""",
    }


_STATES = {k: v for n in range(3) for k, v in _delivery_sql(n).items()}
_ABSENT = ("last_name", "full_name", "type", "fraud", "delivery_provider_un_id", "delivery_provider_name", "delivery_service", "zone_ids",
           "couriers_zones_last_update", "day_of_week", "time_end", "time_interval")


@query(
    "preferences_stored",
    with_fx("SELECT *, " + ", ".join(f"NULL AS {c}" for c in _ABSENT) + " FROM state2", **_STATES),
)
def preferences_on_disk(t: Tables) -> DataFrame:
    """Three overlapping deliveries of preferences, the last two loaded at once, with all columns."""
    store = _preferences(t, [[0], [1, 2]])
    rows = store.table(stored.PREFERENCES)
    return rows.select("courier_id", "preferred_date", *_GIVEN, "filename", "file_date", *_ABSENT)


def _preferences(t: Tables, loads: list[list[int]]) -> Store:
    store = new_store(t, "preferences")
    for load in loads:
        sheets = [preference_chunks(t, n, _DAYS[n], f"prefs-{n}.xlsx") for n in load]
        delivered = sheets[0] if len(sheets) == 1 else sheets[0].unionByName(sheets[1])
        store.commit(f"load {load}", lambda change, x=delivered: stored.merge_preferences(change, x))
    return store


@query(
    "log_preferences",
    with_fx(
        """SELECT 'event' AS event_type, 'preferences' AS event_source, 'inserted ' || COUNT(*) || ', updated 0' AS description FROM state0
        UNION ALL SELECT 'warning', 'preferences', 'prefs-0.xlsx: type is empty in ' || COUNT(*) || ' rows' FROM events WHERE event_id % 4 <> 0""",
        **_STATES,
    ),
)
def preferences_logged(t: Tables) -> DataFrame:
    return stored.run_log(_preferences(t, [[0]]))


# Vacancies -----------------------------------------------------------------------------------

_API, _NEW = ORACLES["ingest_api_vacancies"].rsplit("WHERE", 1)


@query("vacancies_stored", f"{_API} WHERE event_id % 2 = 0 UNION ALL {_API} WHERE {_NEW}")
def vacancies_on_disk(t: Tables) -> DataFrame:
    """Vacancies of two crawls; as in SQL those that hold a null come in again. The second crawl is run twice."""
    store = new_store(t, "vacancies")
    found = settle(found_api_vacancies(t), "found")
    even = found.filter("CAST(vacancy_id AS BIGINT) % 2 = 0")
    for batch, rows in (("first", even), ("second", found), ("second", found)):
        store.commit(batch, lambda change, x=rows: stored.add_vacancies(change, x, "vacancies"))
    return store.table("vacancies").select(*API_COLUMNS)


@query(
    "log_vacancies",
    f"""SELECT 'event' AS event_type, 'vacancies' AS event_source, 'inserted ' || COUNT(*) AS description FROM ({_API} WHERE event_id % 2 = 0)
    UNION ALL SELECT 'event', 'vacancies', 'inserted ' || COUNT(*) FROM ({_API} WHERE event_id % 2 = 1)
    UNION ALL SELECT 'event', 'vacancies', 'nothing new'""",
)
def vacancies_logged(t: Tables) -> DataFrame:
    """The same where nulls are values like others: a further crawl of known vacancies adds nothing."""
    store = new_store(t, "vacancies")
    found = settle(found_api_vacancies(t), "found")
    even = found.filter("CAST(vacancy_id AS BIGINT) % 2 = 0")
    for n, rows in enumerate((even, found, found)):
        store.commit(f"crawl {n}", lambda change, x=rows: stored.add_vacancies(change, x, "vacancies", null_safe=True))
    return stored.run_log(store)


# Streams -------------------------------------------------------------------------------------


@query(
    "stream_reports",
    """SELECT 'courier_shifts' AS name, COUNT(DISTINCT (o_custkey, CAST(o_orderdate AS DATE))) AS rows FROM orders
    UNION ALL SELECT 'picker_shifts', COUNT(DISTINCT (user_id, CAST(ts AS DATE))) FROM events
    UNION ALL SELECT 'revenues', COUNT(*) FROM orders UNION ALL SELECT 'outputs', COUNT(*) FROM orders
    UNION ALL SELECT 'requests', 2 * COUNT(*) FROM customer
    UNION ALL SELECT 'hours', COUNT(*) FROM (""" + ORACLES["ingest_hours"] + """) WHERE filename <> 'old'""",
)
def streamed_reports(t: Tables) -> DataFrame:
    """One stream, many tables: a run that dies after some loads leaves nothing, and the next one loads each report once."""
    root, store = run_folder(t.spark, "reports"), new_store(t, "reports")
    tks, organisations = stores_and_organisations(t)
    store.commit("dictionaries", lambda change: stored.start(change, tks=tks, organisations=organisations, addresses=addresses(t)))
    for sheets in (courier_chunks(t), picker_chunks(t), hours_chunks(t), revenue_chunks(t), request_chunks(t), output_chunks(t)):
        sheets.write.options(**LARGE_ROWS).mode("append").parquet(f"{root}/landing")
    schema = courier_chunks(t).schema

    def dying(change: Change, rows: DataFrame) -> None:
        stored.merge_couriers(change, rows)
        stored.append_revenues(change, rows, dimensions(t))
        raise RuntimeError("the run ends here")

    # a failed batch, then the same batch, then a run without anything new
    try:
        commit_batches(landing_stream(t.spark, f"{root}/landing", schema=schema), store, f"{root}/checkpoint", dying)
    except Exception as err:
        if "the run ends here" not in str(err):
            raise
    for _ in range(2):
        reports_new(landing_stream(t.spark, f"{root}/landing", schema=schema), store, dimensions(t), f"{root}/checkpoint")
    names = (stored.COURIERS, stored.PICKERS, stored.REVENUES, stored.OUTPUTS, stored.REQUESTS, stored.HOURS)
    counts = [store.table(n).agg(F.lit(n).alias("name"), F.count("*").alias("rows")) for n in names]
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.unionByName(more)
    return whole
