"""Business rules on small literal tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterlake.plans import other_reports, pay, preferences, reports as R, stored
from rosterlake.plans.other_reports import apply_hours, load_hours, load_requests, load_revenues
from rosterlake.operators.store import Change, Store
from rosterlake.plans.shift_reports import COURIER_KEY, apply_shifts, load_couriers, load_pickers
from rosterlake.plans.slices import CONTRACT_COLUMNS, contract_slice
from rosterlake.plans.tariffs import date_bounds, effective_prices
from rosterlake.session import settle

DAY = date(2022, 6, 1)
CHUNK = "file string, sheet int, book_headers array<string>, headers array<string>, first_row int, is_last boolean, rows array<array<string>>"


def tariff(id_, state=3, start=date(2022, 1, 1), stop=None, state_date=None, created=date(2022, 1, 1), speciality=1):
    return (id_, 20, 1, speciality, state, start, stop, state_date, created)


def tariffs(spark, *rows):
    schema = (
        "id bigint, project_id int, region_id int, speciality_id int, state_id int, date_start date, date_stop date, "
        "state_date date, created date"
    )
    return spark.createDataFrame(list(rows), schema)


def prices(spark, *rows):
    schema = "tariff_id bigint, field_id int, cost decimal(10,2), amount decimal(10,2)"
    return spark.createDataFrame([(t, f, Decimal(str(c)), Decimal(str(a))) for t, f, c, a in rows], schema)


@pytest.mark.parametrize(
    "rows, winner",
    [
        ([tariff(1), tariff(2)], 2),  # the latest id wins
        ([tariff(1), tariff(2, state=1)], 1),  # other states do not count
        ([tariff(1), tariff(2, stop=date(2022, 5, 31))], 1),
        ([tariff(1), tariff(2, stop=DAY)], 2),  # the stop day counts
        ([tariff(1), tariff(2, state=4, state_date=date(2022, 5, 1))], 1),  # closed before
        ([tariff(1), tariff(2, state=4, state_date=DAY)], 2),
        ([tariff(1), tariff(2, state=4, state_date=DAY, created=DAY)], 1),  # closed when created
        ([tariff(1), tariff(2, start=date(2022, 6, 2))], 1),
        ([tariff(1), tariff(2, start=None)], 1),
        ([tariff(1), tariff(2, state=4, state_date=None)], 1),
    ],
)
def test_tariff_in_force(spark, rows, winner):
    days = spark.createDataFrame([(DAY,)], "date_ date")
    table = prices(spark, *[(i, 1, i, i * 10) for i in (1, 2)])
    found = effective_prices(tariffs(spark, *rows), table, days, date_bounds(days, "date_")).collect()
    assert [(r.date_, r.tariff_id, r.field_id, int(r.amount)) for r in found] == [(DAY, winner, 1, winner * 10)]


def work(spark, *rows):
    schema = (
        "id bigint, tk_id int, date_ date, transport_id int, active_time_hours double, orders_delivered int, "
        "daily_distance double, orders_over_twenty_kg int, orders_over_forty_kg int, full_payment_client double"
    )
    return spark.createDataFrame(list(rows), schema)


FIELDS = [(1, 10), (2, 5), (58, 500), (59, 7), (60, 3), (82, 9)]


def all_prices(spark, tariff_id=1, skip=()):
    return prices(spark, *[(tariff_id, f, p, p + 0.9) for f, p in FIELDS if f not in skip])


def stores(spark):
    return spark.createDataFrame([(1, "ТК1", 1), (2, "ТК2", None)], "tk_id int, tk_name string, region_id int")


def test_courier_pay_rules(spark):
    shifts = work(
        spark,
        (1, 1, DAY, 2, 12.0, 3, 100.0, 1, 2, None),  # long shift, few orders: minimum pay
        (2, 1, DAY, 2, 12.0, 30, 10.0, 0, 0, 1.0),  # priced again, its day is pending
        (3, 2, DAY, 2, 1.0, 1, 1.0, 0, 0, None),  # store without region
        (4, 1, date(2022, 6, 2), 2, 1.0, 1, 1.0, 0, 0, 1.0),  # day already done
        (5, 1, DAY, 1, 1.0, 1, 1.0, 0, 0, None),  # speciality 2 has no tariff
        (6, 1, DAY, None, 2.0, 1, 1.0, 0, 0, None),  # no transport: speciality 1
    )
    table = tariffs(spark, tariff(1))
    args = (stores(spark), table, all_prices(spark))
    paid = {r.id: r for r in pay.courier_pay(shifts, *args).collect()}
    assert set(paid) == {1, 2, 6}
    # prices are cut to whole numbers: 10.9 pays 10
    assert (paid[1].mandatory_client, paid[1].hour_client, paid[1].order_client) == (500, 0, 0)
    assert paid[1].mileage_doer == (100 - 8 * 3) * 3
    assert paid[1].full_payment_doer == 500 + 1 * 7 + 2 * 9 + 76 * 3
    assert (paid[2].mandatory_client, paid[2].hour_client, paid[2].mileage_client) == (0, 120, 0)
    assert paid[6].full_payment_client == 2 * 10 + 1 * 5
    assert [r.id for r in pay.courier_unmatched(shifts, *args[:2]).collect()] == [5]
    after = {r.id: r.full_payment_client for r in pay.courier_repriced(shifts, *args).collect()}
    assert after == {1: 753.0, 2: 270.0, 3: None, 4: 1.0, 5: None, 6: 25.0}


def test_missing_price_makes_the_total_zero(spark):
    shifts = work(spark, (1, 1, DAY, 2, 2.0, 1, 1.0, 0, 0, None))
    paid = pay.courier_pay(shifts, stores(spark), tariffs(spark, tariff(1)), all_prices(spark, skip=(82,))).first()
    assert (paid.hour_client, paid.orders_over_forty_kg_client, paid.full_payment_client) == (20, 0, 0)


def test_nothing_pending_gives_nothing(spark):
    shifts = work(spark, (1, 1, DAY, 2, 2.0, 1, 1.0, 0, 0, 5.0))
    args = (shifts, stores(spark), tariffs(spark, tariff(1)), all_prices(spark))
    assert pay.courier_pay(*args).count() == 0
    assert pay.courier_repriced(*args).first().full_payment_client == 5.0


def test_salted_pay_is_the_same(spark, rows):
    shifts = work(spark, *[(i, 1, DAY, 2, float(i % 14), i % 20, float(i % 90), 0, 1, None) for i in range(200)])
    args = (shifts, stores(spark), tariffs(spark, tariff(1)), all_prices(spark))
    assert rows(pay.courier_pay(*args, salts=8)) == rows(pay.courier_pay(*args))


def test_facts_are_not_shuffled_for_pricing(spark, tmp_path):
    shifts = work(spark, (1, 1, DAY, 2, 2.0, 1, 1.0, 0, 0, None))
    stores(spark).write.parquet(f"{tmp_path}/stores")
    plan = pay.courier_pay(
        shifts, spark.read.parquet(f"{tmp_path}/stores"), tariffs(spark, tariff(1)), all_prices(spark)
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_picker_pay_rules(spark):
    at = lambda h, m=0: datetime(2022, 6, 1, h, m)
    schema = (
        "id bigint, tk_id int, date_ date, file_date date, first_activation timestamp_ntz, last_deactivation "
        "timestamp_ntz, active_time_hours double, picked_SKU int, full_payment_doer double"
    )
    rows = [
        (1, 1, DAY, DAY, at(8, 30), at(20), 11.5, 23, None),
        (2, 1, DAY, DAY, at(8), at(10), 0.0, 5, None),  # no hours: no pay per item
        (3, 1, DAY, DAY, None, at(10), 1.0, 5, None),
        (4, 1, date(2022, 6, 2), date(2022, 5, 11), at(8), at(10), 1.0, 5, None),  # too old a file
        (5, 1, DAY, DAY, at(23), None, 1.0, 5, None),
    ]
    shifts = spark.createDataFrame(rows, schema)
    table = prices(spark, (7, 1, 100, 200), (7, 92, 2, 4))  # no night price
    args = (shifts, stores(spark), tariffs(spark, tariff(7, speciality=3)), table)
    paid = {r.id: r for r in pay.picker_pay(*args).collect()}
    assert set(paid) == {1, 2, 5}
    assert (paid[1].hour_day_doer, paid[1].picked_SKU_doer, paid[1].full_payment_client) == (1150, 46, 2300 + 92)
    assert (paid[2].hour_day_doer, paid[2].picked_SKU_doer) == (200, 0)
    assert (paid[5].hour_night_doer, paid[5].full_payment_doer) == (0, 0)
    assert pay.picker_repriced(*args).count() == 5


# Reports -------------------------------------------------------------------------------------


def chunk(spark, *parts):
    """Sheets given as (file, sheet, book_headers, headers, rows)."""
    data = [(f, s, list(b), list(h), 1, True, [list(map(lambda v: v and str(v), r)) for r in rows]) for f, s, b, h, rows in parts]
    return spark.createDataFrame(data, CHUNK)


def line(header, **values):
    return [values.get(h.replace(" ", "_").replace(",", "")) for h in header]


FILE = "31.2022-06-02.ops@mail.example.shifts.xlsx"


def test_second_sheet_holds_the_other_kind(spark):
    courier = line(R.COURIER_HEADER, КПП_Курьера="K1", ТК="5", Дата="2022/06/01", Транспорт="Авто")
    picker = line(R.PICKER_HEADER, КПП_Комплектовщика="P1", ТК="ТК5", Дата="2022/06/01", Организация="О")
    book = chunk(
        spark, (FILE, 0, R.PICKER_HEADER, R.PICKER_HEADER, [picker]), (FILE, 1, R.PICKER_HEADER, R.COURIER_HEADER, [courier]),
        ("x", 0, R.OUTPUT_HEADER, R.OUTPUT_HEADER, [["c"] * 14]), ("x", 1, R.OUTPUT_HEADER, R.COURIER_HEADER, [courier]),
    )
    tks = spark.createDataFrame([(3, "ТК9")], "tk_id bigint, tk_name string")
    orgs = spark.createDataFrame([], "organisation_id bigint, organisation_name string")
    couriers, pickers = load_couriers(book, tks, orgs), load_pickers(book, tks, orgs)
    row = couriers.rows.first()
    assert (row.courier_id, row.tk_id, row.transport_id, row.division_id, row.employee_id) == ("K1", 4, 2, 7, 0)
    # a missing organisation is a dictionary member like any other, and both times are filled
    assert couriers.organisations.count() == 1 and row.organisation_id == 1
    assert row.first_activation == row.last_deactivation == datetime(2022, 6, 1, 6)
    assert (row.filename, row.file_date) == ("shifts.xlsx", date(2022, 6, 2))
    assert pickers.rows.first().picker_id == "P1" and pickers.rows.count() == 1
    assert pickers.warnings.count() == 0


def test_shift_upsert_keeps_payments_in_a_stored_table(spark, tmp_path):
    tks = spark.createDataFrame([], "tk_id bigint, tk_name string")
    orgs = spark.createDataFrame([], "organisation_id bigint, organisation_name string")
    made = lambda n: line(R.COURIER_HEADER, КПП_Курьера="K1", ТК="5", Дата="2022/06/01", Заказов_доставлено=n)
    load = load_couriers(chunk(spark, (FILE, 0, R.COURIER_HEADER, R.COURIER_HEADER, [made(1), made(2)])), tks, orgs)
    empty = load.rows.drop("row_no").withColumn("full_payment_client", F.lit(None).cast("double")).limit(0)
    first = apply_shifts(empty, load, COURIER_KEY)
    assert [r.orders_delivered for r in first.collect()] == [2.0]
    paid = first.withColumn("full_payment_client", F.lit(99.0))
    store = Store(spark, f"{tmp_path}/store")

    def before(change):
        stored.start(change, tks=tks, organisations=orgs)
        change.create(stored.COURIERS, paid.schema, pay.MONTHS, pay.COURIER_FACTS)
        return change.append(stored.COURIERS, paid)

    store.commit("before", before)
    again = chunk(spark, (FILE, 0, R.COURIER_HEADER, R.COURIER_HEADER, [made(7)]))
    assert store.commit("again", lambda change: stored.merge_couriers(change, again)) == {"inserted": 0, "updated": 1}
    found = store.table(stored.COURIERS).collect()
    assert [(r.orders_delivered, r.full_payment_client) for r in found] == [(7.0, 99.0)]
    # a later load looks names up in the stored dictionary, and gives new ones further ids
    more = line(R.COURIER_HEADER, КПП_Курьера="K2", ТК="6", Дата="2022/06/01", Организация="new")
    store.commit("more", lambda change: stored.merge_couriers(change, chunk(spark, (FILE, 0, R.COURIER_HEADER, R.COURIER_HEADER, [more]))))
    assert {r.tk_name: r.tk_id for r in store.table(stored.TKS).collect()} == {"ТК5": 1, "ТК6": 2}
    assert {r.courier_id: r.tk_id for r in store.table(stored.COURIERS).collect()} == {"K1": 1, "K2": 2}


def test_hours_replace_covered_dates(spark, rows):
    headers = (*R.HOURS_HEADER, "01.06.22", "2022-06-02 00:00:00", "Итого")
    body = [
        ["sub"] * 8, ["A", "Иван", "Сборщик", "7", " Москва ", "8", None, "8"],
        ["B", "Пётр", "Повар", "x", "Тверь", "0", "0", "0"], ["total"] * 8,
    ]
    book = chunk(spark, ("25.2022-06-03.a@b.example.h", 0, headers, headers, body))
    regions = spark.createDataFrame([(1, "Москва")], "id int, legal_name string")
    tks = spark.createDataFrame([(5, 1, "A")], "tks_id bigint, city_id int, address string")
    load = load_hours(book, regions, tks)
    assert rows(load.tks) == [(5, 1, "A"), (6, None, "B")]
    assert rows(load.rows, "doer_name", "doer_id", "tks_id", "speciality_id", "worked_hours", "report_date") == [
        ("Иван", 7, 5, 3, 8.0, DAY)
    ]
    assert rows(load.dates) == [(DAY,), (date(2022, 6, 2),)]
    assert load.warnings.first().description == "speciality_id is 0 in 1 rows"
    old = load.rows.withColumn("doer_name", F.lit("old"))
    table = old.unionByName(old.withColumn("report_date", F.lit(date(2022, 6, 2)))).unionByName(
        old.withColumn("report_date", F.lit(date(2022, 6, 9)))
    )
    assert rows(apply_hours(table, load), "doer_name", "report_date") == [("old", date(2022, 6, 9)), ("Иван", DAY)]


def revenue_dims(spark):
    named = lambda *r: spark.createDataFrame(list(r), "id int, name string")
    users = spark.createDataFrame([(3, "ops@mail.example")], "id int, email string")
    regions = spark.createDataFrame([(1, "Москва")], "id int, legal_name string")
    return users, named((20, "П")), regions, named((2, "С"))


def test_revenues_report_gaps_and_load_all_the_same(spark, rows):
    body = [[None, "2022-06-01 00:00:00", "10.5", "1", "П", "Москва", "С", None], ["4", None, "x", "1", "?", "?", "?", "z"]]
    book = chunk(spark, (FILE, 0, R.REVENUE_HEADER, R.REVENUE_HEADER, body))
    load = load_revenues(book, *revenue_dims(spark))
    assert rows(load.rows, "doer_id", "date", "amount", "created_by", "project_id", "region_id", "speciality_id", "notes") == [
        (0, DAY, 10.5, 3, 20, 1, 2, ""), (4, None, None, 3, None, None, None, "z"),
    ]
    assert rows(load.audit, "event_type", "description") == [("error", "column date has empty cells")]
    assert load_revenues(book, *revenue_dims(spark), strict=True).rows.count() == 1


def test_requests_follow_the_first_sheets_dates(spark, rows):
    first = ("ТК", "Тип ресурса", "2022-06-01 00:00:00", "2022-06-02 00:00:00", "Unnamed: 4", "Ночь", "Доп потребность")
    second = ("Unnamed: 0", "Тип ресурса", "2022-06-02 00:00:00", "2022-06-03 00:00:00", "Ночь", "Доп потребность")
    book = chunk(
        spark, (FILE, 0, first, first, [["1", "Курьер (кол-во)", "3", "нет", "junk", "1", None]]),
        (FILE, 1, first, second, [["ТК1", "Пикер (кол-во)", "4", "5", None, "2"]]),
    )
    tks = spark.createDataFrame([(8, "ТК1")], "tk_id bigint, tk_name string")
    found = rows(load_requests(book, tks).rows, "tk_id", "resource_id", "requested_date", "doer_count", "is_night")
    assert found == [
        (8, 1, DAY, 3.0, "1"), (8, 1, date(2022, 6, 2), None, "1"), (8, 2, DAY, None, None), (8, 2, date(2022, 6, 2), 4.0, None),
    ]


# Preferences ---------------------------------------------------------------------------------


def preference(courier, weekday, zones, updated="2022-05-30 10:00:00"):
    return line(
        R.PREFERENCE_HEADER, courier_id=courier, day_of_week_number=weekday, zones=zones,
        couriers_intervals_last_update=updated,
    )


def delivered(spark, name, body):
    return chunk(spark, (name, 0, R.PREFERENCE_HEADER, R.PREFERENCE_HEADER, body))


def kept_preferences(spark, tmp_path, rows):
    store = Store(spark, f"{tmp_path}/store")

    def work(change):
        change.create("p", rows.schema, preferences.DAYS)
        return change.append("p", rows)

    store.commit("first", work)
    return store


def test_preferences_withdrawn_then_filled(spark, tmp_path):
    # 1 June 2022 is a Wednesday; its template fills Saturday 4 (6), Sunday 5 (7) and Monday 6 (1)
    one = "31.2022-06-01.ops@mail.example.one"
    rows = preferences.preference_rows(delivered(spark, one, [
        preference(1, 6, "first"), preference(1, 6, "last"), preference(1, 7, "x", None), preference(2, 1, "m"),
        preference(2, 3, "unused"),
    ]))
    template = preferences.split_template(rows)
    assert [r.courier_id for r in template.withdrawn.collect()] == [1]
    empty = template.rows.drop("row_no", "file").withColumn("preferred_date", F.lit(DAY)).limit(0)
    after = preferences.apply_template(empty, template, DAY, "one").select(empty.columns)
    found = {(r.courier_id, r.preferred_date.day): (r.zones, r.filename) for r in after.collect()}
    assert found == {(1, 4): ("last", "one"), (2, 6): ("m", "one")}

    # stored form, with a second delivery that withdraws courier 2 and repeats courier 1
    store = kept_preferences(spark, tmp_path, after)
    two = "31.2022-06-02.ops@mail.example.two"
    more = preferences.preference_rows(delivered(spark, two, [
        preference(2, 1, "m", None), preference(1, 1, "new"), preference(3, 2, "t"),
    ]))
    store.commit("two", lambda change: preferences.store_deliveries(change, "p", more, [(date(2022, 6, 2), "two")]))
    table = store.table("p")
    found = {(r.courier_id, r.preferred_date.day): (r.zones, r.filename) for r in table.collect()}
    # day 6 was loaded and is blanked; the provenance of the blanked row moves with it
    assert found == {(1, 4): ("last", "one"), (2, 6): (None, "two"), (1, 6): ("new", "two"), (3, 7): ("t", "two")}


def test_deliveries_in_one_pass_equal_one_by_one(spark, tmp_path):
    import random

    rnd = random.Random(11)
    bodies = []
    for n in range(5):
        body = [
            preference(rnd.choice([1, 2, 3, 4, None]), day, rnd.choice(["a", "b", None]), rnd.choice(["2022-05-30 10:00:00"] * 4 + [None]))
            for day in range(1, 8) for _ in range(3)
        ]
        bodies.append((f"31.2022-06-0{1 + n // 2 + n}.ops@mail.example.f{n}", body))
    all_rows = [preferences.preference_rows(delivered(spark, name, body)) for name, body in bodies]
    empty = preferences.split_template(all_rows[0]).rows.drop("row_no", "file").withColumn("preferred_date", F.lit(DAY)).limit(0)
    before = preferences.apply_template(empty, preferences.split_template(all_rows[0]), DAY, "f0").select(empty.columns)
    store, schema = kept_preferences(spark, tmp_path, before), before.schema
    table = store.table("p")
    one_by_one = spark.createDataFrame(table.collect(), schema)
    for rows in all_rows[1:]:
        first = rows.select("file_date", "filename").first()
        state = preferences.apply_template(one_by_one, preferences.split_template(rows), *first).select(schema.names)
        one_by_one = spark.createDataFrame(state.collect(), schema)
    later = all_rows[1]
    for rows in all_rows[2:]:
        later = later.unionByName(rows)
    store.commit("later", lambda change: preferences.store_deliveries(change, "p", later))
    after = store.table("p")
    assert sorted(map(repr, after.collect())) == sorted(map(repr, one_by_one.collect()))
    assert after.count() > 20


def test_contract_slice(spark):
    base = {c: None for c in CONTRACT_COLUMNS}
    made = [
        {**base, "id": 1, "is_active": True, "changed": datetime(2020, 1, 1)},
        {**base, "id": 2, "is_active": False, "changed": datetime(2022, 5, 31, 12)},
        {**base, "id": 3, "is_active": False, "changed": datetime(2022, 6, 1)},
        {**base, "id": 4, "is_active": None, "changed": datetime(2022, 5, 31)},
    ]
    types = {"id": "int", "is_active": "boolean", "changed": "timestamp_ntz"}
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in CONTRACT_COLUMNS)
    frame = spark.createDataFrame([tuple(m[c] for c in CONTRACT_COLUMNS) for m in made], schema)
    found = contract_slice(frame, DAY).collect()
    assert sorted(r.id for r in found) == [1, 2] and found[0].fix_date == date(2022, 5, 31)


def test_last_delivery_of_a_date_counts(spark, rows):
    """Two reports cover 2 June, and the later one has no hours there; an unread header and cell are told."""
    from rosterlake.plans.other_reports import load_hours

    def report(file, headers, cells):
        head = [*R.HOURS_HEADER, *headers, "Итого"]
        body = [[None] * len(head), ["Addr", "Doer", "Сборщик", "7", "City", *cells, "9"], [None] * len(head)]
        return (file, 0, head, head, 1, True, body, None)

    from rosterlake.sources.workbook import SCHEMA
    chunks = spark.createDataFrame([
        report("23.2022-06-05.a@b.example.h1.xlsx", ["1.06.22", "02.06.22", "June"], ["8", "8", "1"]),
        report("23.2022-06-06.a@b.example.h2.xlsx", ["02.06.22", "2022-06-03 00:00:00"], ["0", "many"]),
    ], SCHEMA)
    regions = spark.createDataFrame([(1, "City")], "id int, legal_name string")
    tks = spark.createDataFrame([(1, 1, "Addr")], "tks_id int, city_id int, address string")
    load = load_hours(chunks, regions, tks)
    assert [(r.report_date.day, r.worked_hours) for r in load.rows.collect()] == [(1, 8.0)]
    assert sorted(r.report_date.day for r in load.dates.collect()) == [1, 2, 3]
    assert rows(load.problems, "problem", "value", "found") == [("hours are no number", "many", 1), ("unread date header", "June", 1)]


def test_repricing_a_stored_table_touches_pending_days_only(spark, tmp_path):
    done, same = date(2022, 7, 2), date(2022, 6, 2)
    shifts = work(spark, (1, 1, DAY, 2, 1.0, 1, 1.0, 0, 0, None), (2, 1, done, 1, 1.0, 1, 1.0, 0, 0, 4.0), (3, 1, same, 1, 1.0, 1, 1.0, 0, 0, 5.0))
    store = Store(spark, f"{tmp_path}/store")

    def before(change):
        change.create("work", shifts.schema, pay.MONTHS, pay.COURIER_FACTS)
        return change.append("work", shifts)

    store.commit("before", before)
    july = store.snapshot().files("work", ["2022-07"])
    args = (stores(spark), tariffs(spark, tariff(1)), all_prices(spark))
    plain = {r.id: r.full_payment_client for r in pay.courier_repriced(shifts, *args).collect()}
    # the days come from the version: nothing is scanned
    pending = pay.pending_days(Change(store, store.snapshot()), "work")
    assert [r.date_ for r in pending.collect()] == [DAY] and "FileScan" not in pending._jdf.queryExecution().executedPlan().toString()
    assert store.commit("pay", lambda change: pay.reprice_couriers_stored(change, "work", *args)) == {"days": 1, "rows": 1}
    assert {r.id: r.full_payment_client for r in store.table("work").collect()} == plain
    assert store.snapshot().files("work", ["2022-07"]) == july
    assert store.commit("pay 2", lambda change: pay.reprice_couriers_stored(change, "work", *args)) == {"days": 0, "rows": 0}


def test_headers_are_parsed_once_per_chunk_not_per_row(spark, monkeypatch):
    """Headers that come out of a grouping's key are not parsed in a filter below that grouping."""
    rows = spark.range(40).selectExpr("id div 20 AS book", "id")
    grouped = rows.groupBy("book").agg(F.collect_list(F.array(F.lit("Addr 1"), F.lit("A"), F.lit("Сборщик"), F.lit("1"), F.lit("ASIA"),
                                                              F.col("id").cast("string"), F.lit("2"), F.lit("9"))).alias("rows"))
    headers = F.concat(F.array(*map(F.lit, R.HOURS_HEADER)), F.array(
        F.concat(F.col("book") + 1, F.lit(".6.22")), F.concat(F.lit("June "), "book"), F.lit("Итого")))
    chunks = grouped.select(
        F.concat(F.lit("31.2022-06-01.boss@mail.example.h"), "book").alias("file"), F.lit(0).alias("sheet"), headers.alias("book_headers"),
        headers.alias("headers"), F.lit(1).alias("first_row"), F.lit(True).alias("is_last"), "rows")
    plans = {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return settle(df, label)

    monkeypatch.setattr(other_reports, "settle", seen)
    regions = spark.createDataFrame([(1, "ASIA")], "id int, legal_name string")
    load = load_hours(chunks, regions, spark.createDataFrame([(1, 1, "Addr 1")], "tks_id int, city_id int, address string"))
    plans["problems"] = load.problems._jdf.queryExecution().optimizedPlan().toString()
    for label in ("covered", "problems"):
        assert not [line for line in plans[label].splitlines() if "Filter" in line and "gettimestamp" in line], label
    assert sorted(r.report_date.day for r in load.dates.collect()) == [1, 2]
    assert {(r.value, r.found) for r in load.problems.collect()} == {("June 0", 1), ("June 1", 1)}


def test_loads_read_only_their_own_kinds_of_a_batch(spark, tmp_path, monkeypatch):
    headers = {"c": R.COURIER_HEADER, "p": R.PICKER_HEADER, "h": (*R.HOURS_HEADER, "1.6.22", "Итого"), "v": R.REVENUE_HEADER,
               "q": (*R.REQUEST_HEADER, "1.6.22", *R.REQUEST_ALSO), "f": R.PREFERENCE_HEADER, "o": R.OUTPUT_HEADER, "x": ("else",)}
    found = [(k, 0, list(h), list(h), 1, True, []) for k, h in headers.items()]
    found.append(("2", 1, list(R.OUTPUT_HEADER), list(R.PREFERENCE_HEADER), 1, True, []))
    batch = settle(stored.with_kinds(spark.createDataFrame(found, CHUNK)), "batch", stored.KINDS)
    got, plans = {}, {}

    def load(name):
        def run(change, chunks, **dims):
            got[name] = sorted(r.file for r in chunks.collect())
            plans[name] = chunks._jdf.queryExecution().executedPlan().toString()
            assert chunks.columns == [c.split()[0] for c in CHUNK.split(", ")]
        return run

    for name in ("merge_couriers", "merge_pickers", "replace_hours", "append_revenues", "append_requests", "merge_preferences", "merge_outputs"):
        monkeypatch.setattr(stored, name, load(name))
    want = {"merge_couriers": ["c", "p"], "merge_pickers": ["c", "p"], "replace_hours": ["h"], "append_revenues": ["v"], "append_requests": ["q"],
            "merge_preferences": ["2", "f"], "merge_outputs": ["2", "o"]}
    dims = stored.Dimensions(None, None, None, None)
    stored.load_reports(None, batch, dims)
    assert got == want and all("PartitionFilters: [" in p and "PartitionFilters: []" not in p for p in plans.values())
    stored.load_reports(None, spark.createDataFrame(found, CHUNK), dims)  # chunks whose kinds are not known yet
    assert got == want
