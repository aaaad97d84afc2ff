"""Hazards of single operators on small literal frames."""

import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rosterlake import functions as fn
from rosterlake.operators import aggregate, clean, dictionary, joins, mapping, quality, reshape, writes
from rosterlake.plans import reports as R
from rosterlake.plans.vacancies import API_RULES, WEB_RULES
from rosterlake.sources import landing

D = date


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# Functions -----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, number",
    [("emp-12/7", 12), ("no digits", 0), (None, 0), ("007", 7), ("9" * 30, 0)],
)
def test_first_integer(spark, text, number):
    assert value(spark, fn.first_integer(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize("code, full", [("12", "ТК12"), ("ТК12", "ТК12"), ("аТК", "аТК"), (None, None)])
def test_prefix_code(spark, code, full):
    assert value(spark, fn.prefix_code(F.lit(code).cast("string"), "ТК")) == full


@pytest.mark.parametrize("text, number", [("1e3", 1000.0), (" 7 ", 7.0), ("x", None), (None, None), ("", None)])
def test_coerce_numeric(spark, text, number):
    assert value(spark, fn.coerce_numeric(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize(
    "text, day",
    [
        ("2022/05/01", D(2022, 5, 1)), ("01.05.22", D(2022, 5, 1)), ("01.05.95", D(1995, 5, 1)),
        ("29.02.96", D(1996, 2, 29)), ("01.05.68", D(2068, 5, 1)), ("2022-05-01 00:00:00", D(2022, 5, 1)),
        ("31.02.22", None), ("Итого", None), (None, None),
    ],
)
def test_parse_date(spark, text, day):
    assert value(spark, fn.parse_date(F.lit(text).cast("string"), R.DATES)) == day


def test_strip_removes_no_break_spaces(spark):
    assert value(spark, fn.strip(F.lit("  Москва\t "))) == "Москва"


def test_finite_or_and_safe_ratio(spark):
    nan, inf = float("nan"), float("inf")
    frame = spark.createDataFrame([(1, nan), (2, inf), (3, -inf), (4, None), (5, 2.5)], "i int, v double")
    kept = {r.i: r.v for r in clean.clean_nonfinite(frame, ["v"], 0.0).collect()}
    assert kept == {1: 0.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 2.5}
    assert value(spark, fn.safe_ratio(F.lit(3.0), F.lit(0.0))) == 0.0


@pytest.mark.parametrize("number, cut", [(2.9, 2), (-2.9, -2), (7.0, 7), (None, None)])
def test_whole_cuts_towards_zero(spark, number, cut):
    assert value(spark, fn.whole(F.lit(number).cast("double"))) == cut


@pytest.mark.parametrize(
    "start, finish, night_early, day, night_late",
    [
        (5.0, 12.0, 1.0, 0.0, 0.0),  # begins before 6: no day hours
        (8.0, 20.0, 0.0, 12.0, 0.0),
        (8.0, None, 0.0, 14.0, 0.0),  # an open end counts to the band's end
        (22.5, 23.5, 0.0, 0.0, 1.0),
        (20.0, 3.0, 0.0, 0.0, 0.0),  # overnight
        (0.0, 4.0, 4.0, 0.0, 0.0),
    ],
)
def test_overlap_hours(spark, start, finish, night_early, day, night_late):
    s, f = F.lit(start), F.lit(finish).cast("double")
    assert value(spark, fn.overlap_hours(s, f, 0, 6)) == night_early
    assert value(spark, fn.overlap_hours(s, f, 6, 22)) == day
    assert value(spark, fn.overlap_hours(s, f, 22, 24)) == night_late


# Cleaning and mapping ------------------------------------------------------------------------


def test_fill_activation(spark, rows):
    at = lambda h: datetime(2022, 5, 1, h)
    frame = spark.createDataFrame(
        [(1, None, None, 2.5, D(2022, 5, 1)), (2, None, at(12), 2.0, D(2022, 5, 1)),
         (3, at(9), None, 1.5, D(2022, 5, 1)), (4, at(9), at(10), 9.0, D(2022, 5, 1))],
        "i int, s timestamp_ntz, e timestamp_ntz, h double, d date",
    )
    filled = rows(clean.fill_activation(frame, "s", "e", "h", "d"), "i", "s", "e")
    assert filled == [
        (1, at(6), datetime(2022, 5, 1, 8, 30)), (2, at(10), at(12)),
        (3, at(9), datetime(2022, 5, 1, 10, 30)), (4, at(9), at(10)),
    ]


@pytest.mark.parametrize("label, code", [("Волга", 1), ("ММФ", 9), ("нечто", 0), (None, 7)])
def test_division_codes(spark, label, code):
    assert value(spark, mapping.map_codes(F.lit(label).cast("string"), R.DIVISIONS, 0, R.NO_DIVISION)) == code


def by_hand(title, rules):
    """The rules applied one at a time."""
    code = 0
    for rule in rules:
        hit = title == rule.equals if rule.equals is not None else all(p in title for p in rule.parts)
        if hit and rule.only_if in (None, code):
            code = rule.code
    return code


@pytest.mark.parametrize("rules", [API_RULES, WEB_RULES], ids=["api", "web"])
def test_classify_each_rule_and_random_mixtures(spark, rules):
    parts = sorted({p for r in rules for p in (*r.parts, r.equals) if p})
    rng = random.Random(5)
    titles = ["", "менеджер", *parts, *[" ".join(r.parts) or r.equals for r in rules]]
    titles += [" ".join(rng.sample(parts, rng.randint(1, 4))) for _ in range(400)]
    frame = spark.createDataFrame([(t,) for t in titles] + [(None,)], "title string")
    found = {r.title: r.code for r in mapping.classify(frame, "title", "code", rules).collect()}
    assert found.pop(None) == 0
    assert found == {t: by_hand(t, rules) for t in titles}


@pytest.mark.parametrize(
    "title, api, web",
    [
        ("водитель-курьер на грузовом", 0, 1), ("курьер на личном авто", 10, 10),
        ("курьер на авто компании", 11, 11), ("сборщик заказов", 3, 3), ("курьер-сборщик", 0, 0),
        ("водитель экспедитор", 9, 9), ("велокурьер", 4, 4), ("мотокурьер", 7, 0),
    ],
)
def test_known_titles(title, api, web):
    assert (by_hand(title, API_RULES), by_hand(title, WEB_RULES)) == (api, web)


# Joins ---------------------------------------------------------------------------------------


def test_null_keys_match_only_when_asked(spark):
    left = spark.createDataFrame([(1, None), (2, "a")], "i int, k string")
    right = spark.createDataFrame([(None, 7), ("a", 8)], "k string, v int")
    assert joins.dim_join(left, right, {"k": "k"}).count() == 1
    assert joins.dim_join(left, right, {"k": "k"}, null_safe=True).count() == 2


def test_salted_join_equals_plain_join(spark, rows):
    fact = spark.range(500).selectExpr("id", "if(id % 3 = 0, 0, id % 7) AS k", "if(id % 5 = 0, null, id) AS x")
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (9, "d")], "k bigint, v string")
    for how in ("inner", "left"):
        plain = rows(joins.dim_join(fact, dim, {"k": "k"}, how))
        assert rows(joins.dim_join(fact, dim, {"k": "k"}, how, salts=4)) == plain


def brute_pairs(days, intervals):
    return sorted((d, i) for d in days for i, a, b in intervals if a <= d and (b is None or d <= b))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 150), st.one_of(st.none(), st.integers(-20, 120))), min_size=1, max_size=12),
    st.sets(st.integers(0, 200), min_size=1, max_size=15),
    st.sampled_from([1, 7, 30]),
)
def test_interval_operators_against_brute_force(spark, spans, offsets, bin_days):
    base = D(2021, 12, 20)
    days = [base + timedelta(days=o) for o in offsets]
    intervals = [
        (i, base + timedelta(days=s), None if n is None else base + timedelta(days=s + n))
        for i, (s, n) in enumerate(spans)
    ]
    points = spark.createDataFrame([(d,) for d in days], "day date")
    ranges = spark.createDataFrame([(i, a, b, i % 2) for i, a, b in intervals], "i int, a date, b date, k int")
    horizon = F.lit(max(days))
    joined = joins.interval_join(points, ranges, "day", "a", "b", horizon, bin_days=bin_days)
    assert sorted((r.day, r.i) for r in joined.collect()) == brute_pairs(days, intervals)
    best = joins.interval_max(points, ranges, "day", "a", "b", horizon, ["k"], "i", "top")
    wanted = {}
    for d, i in brute_pairs(days, intervals):
        wanted[d, i % 2] = max(i, wanted.get((d, i % 2), -1))
    assert {(r.day, r.k): r.top for r in best.collect()} == wanted


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A key holding a third of the rows is split when the other side is too large to broadcast."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    other = spark.newSession()
    for k, v in small.items():
        other.conf.set(k, v)
    fact = other.range(0, 200_000, 1, 8).selectExpr("id", "if(id % 3 = 0, 0, id % 5000) AS k")
    dim = other.range(5000).selectExpr("id AS k", "id * 2 AS v")
    joined = joins.dim_join(fact, dim, {"k": "k"}, "left")
    assert len(joined.collect()) == 200_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


# Aggregation and reshape ---------------------------------------------------------------------


def test_keep_last_cuts_hot_keys_before_the_shuffle(spark, rows):
    frame = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, None)], "k int, n int, v string")
    last = aggregate.keep_last(frame, ["k"], ["n"])
    assert rows(last) == [(1, 3, "c"), (2, 1, None)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_pivot_undoes_unpivot(spark, rows):
    wide = spark.createDataFrame([(1, 5, None), (2, None, 7)], "id int, v_1 int, v_2 int")
    long = reshape.unpivot_columns(wide, ["id"], ["v_1", "v_2"], "f", "v").selectExpr(
        "id", "CAST(substr(f, 3) AS INT) AS f", "v"
    )
    assert rows(reshape.pivot_fields(long, ["id"], "f", [1, 2], ["v"])) == rows(wide)


def test_weekly_template_emits_matching_weekdays(spark, rows):
    frame = spark.createDataFrame([(c, w) for c in "ab" for w in range(1, 8)], "c string, w int")
    out = reshape.weekly_template(frame, "w", F.lit(D(2024, 2, 1)), (3, 5), "day")
    assert rows(out, "c", "w", "day") == sorted(
        (c, w, d) for c in "ab" for w, d in ((7, D(2024, 2, 4)), (1, D(2024, 2, 5)), (2, D(2024, 2, 6)))
    )


def test_null_columns_and_counts(spark, rows):
    frame = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "a int, b int, c string")
    assert rows(quality.null_columns(frame, allowed=["a"])) == [("b", 2)]
    assert rows(quality.quality_counts(frame, {"a": F.col("a").isNull()})) == [("a", 1)]


# Dictionaries --------------------------------------------------------------------------------


def test_dict_grow_numbers_new_names(spark, rows):
    dim = spark.createDataFrame([(4, "b"), (9, "a")], "id bigint, name string")
    report = spark.createDataFrame([("c",), ("a",), ("c",), (None,)], "n string")
    assert rows(dictionary.dict_grow(dim, "id", report, {"n": "name"})) == [(10, None), (11, "c"), (4, "b"), (9, "a")]
    again = dictionary.dict_grow(dictionary.dict_grow(dim, "id", report, {"n": "name"}), "id", report, {"n": "name"})
    assert again.count() == 4


def test_dict_grow_from_nothing(spark, rows):
    dim = spark.createDataFrame([], "id bigint, name string")
    report = spark.createDataFrame([("b",), ("a",)], "n string")
    assert rows(dictionary.dict_grow(dim, "id", report, {"n": "name"})) == [(1, "a"), (2, "b")]


def test_dense_numbers_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(0, 5000, 1, 7).selectExpr("format_string('%05d', (id * 7919) % 5000) AS name")
        numbered = dictionary.dense_numbers(frame, ["name"], "n")
        assert all(int(r.name) + 1 == r.n for r in numbered.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


# Writes --------------------------------------------------------------------------------------

TARGET = [(1, "a", 10, "old"), (2, "b", 20, "old"), (3, None, 30, "old")]


def target(spark):
    return spark.createDataFrame(TARGET, "k int, v string, n int, file string")


def test_upsert_last_row_wins_and_other_columns_survive(spark, rows):
    updates = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (4, "z", 1), (None, "p", 1), (None, "q", 2)],
                                    "k int, v string, o int")
    out = writes.upsert(target(spark), updates, ["k"], ["v"], ["o"], action="action")
    assert rows(out, "k", "v", "n", "action") == [
        (None, "p", None, "inserted"), (None, "q", None, "inserted"), (1, "a", 10, "kept"),
        (2, "y", 20, "updated"), (3, None, 30, "kept"), (4, "z", None, "inserted"),
    ]


def test_upsert_can_set_null(spark, rows):
    updates = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(writes.upsert(target(spark), updates, ["k"], ["v"]), "k", "v")[0] == (1, None)


def test_provenance_moves_only_on_change(spark, rows):
    updates = spark.createDataFrame(
        [(1, "a", "new"), (2, "c", "new"), (3, "x", "new"), (4, "n", "new")], "k int, v string, file string"
    )
    out = writes.upsert(target(spark), updates, ["k"], ["v"], provenance=["file"])
    # a null never differs, so the row of key 3 keeps its file
    assert rows(out, "k", "v", "file") == [(1, "a", "old"), (2, "c", "new"), (3, "x", "old"), (4, "n", "new")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 6), st.sampled_from("abc"), st.integers(0, 99)), max_size=10, unique_by=lambda r: r[::2]))
def test_upsert_is_idempotent(spark, rows, batch):
    updates = spark.createDataFrame(batch, "k int, v string, o int")
    once = writes.upsert(target(spark), updates, ["k"], ["v"], ["o"])
    assert rows(writes.upsert(once, updates, ["k"], ["v"], ["o"])) == rows(once)


def test_keyed_update_leaves_other_keys(spark, rows):
    updates = spark.createDataFrame([(2, None), (9, 5)], "k int, n int")
    assert rows(writes.keyed_update(target(spark), updates, ["k"], ["n"]), "k", "n") == [(1, 10), (2, None), (3, 30)]


def test_replace_dates_drops_a_covered_date_without_rows(spark, rows):
    table = spark.createDataFrame([(D(2022, 5, 1), 1), (D(2022, 5, 2), 2), (None, 3)], "d date, n int")
    report = spark.createDataFrame([(D(2022, 5, 3), 9)], "d date, n int")
    dates = spark.createDataFrame([(D(2022, 5, 1),), (D(2022, 5, 3),)], "d date")
    assert rows(writes.replace_dates(table, report, "d", dates)) == [(None, 3), (D(2022, 5, 2), 2), (D(2022, 5, 3), 9)]


def test_insert_if_absent_nulls(spark, rows):
    table = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    batch = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "c"), (3, "c")], "k int, v string")
    assert rows(writes.insert_if_absent(table, batch, ["k", "v"])) == [(2, None), (2, None), (3, "c")]
    assert rows(writes.insert_if_absent(table, batch, ["k", "v"], null_safe=True)) == [(3, "c")]


@pytest.mark.parametrize("until, blanked", [(2, []), (3, [4]), (4, [4, 5]), (9, [4, 5, 6])])
def test_blank_withdrawn_stops_at_the_last_loaded_day(spark, until, blanked):
    table = spark.createDataFrame(
        [(c, D(2022, 5, d), "z", "old") for c in (1, 2) for d in range(2, 9)], "c int, d date, z string, f string"
    )
    gone = spark.createDataFrame([(1,), (1,)], "c int")
    out = writes.blank_withdrawn(
        table, gone, "c", "d", F.lit(D(2022, 5, 1)), F.lit(D(2022, 5, 1) + timedelta(days=until)), (3, 4, 5),
        ["z"], {"f": F.lit("new")},
    ).collect()
    assert len(out) == 14
    assert sorted(r.d.day for r in out if r.z is None) == blanked
    assert all((r.z is None) == (r.f == "new") and (r.z is not None or r.c == 1) for r in out)


def test_upsert_keeps_newer_stored_rows(spark, rows):
    target = spark.createDataFrame([(1, "new", 5), (2, "old", 1), (3, "none", None)], "k int, v string, at int")
    updates = spark.createDataFrame([(1, "late", 4), (2, "fresh", 2), (3, "any", 1), (4, "first", 1)], target.schema)
    after = writes.upsert(target, updates, ["k"], ["v", "at"], newer=["at"])
    assert rows(after, "k", "v") == [(1, "new"), (2, "fresh"), (3, "any"), (4, "first")]


# Landing -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, day, sender, original",
    [
        ("31.2022-05-11.ops@mail.example.a.b.xlsx", D(2022, 5, 11), "ops@mail.example", "a.b.xlsx"),
        ("readme.txt", None, None, None),
        ("x.y.z", None, None, None),
    ],
)
def test_landing_metadata(spark, name, day, sender, original):
    frame = spark.createDataFrame([(name,)], "file string")
    row = landing.landing_metadata(frame, "file").first()
    assert (row.file_date, row.sender, row.filename) == (day, sender, original)


@pytest.mark.parametrize("text, number, whole", [
    ("12", 12.0, 12), (" 12.5 ", 12.5, 12), ("-3e2", -300.0, -300), ("12d", None, None), ("5F", None, None), ("0x1p3", None, None),
    ("9007199254740993", 9007199254740992.0, 9007199254740993), ("1234567890123456789012345", 1.2345678901234568e24, None),
    ("1e30", 1e30, None), ("", None, None), ("NaN", None, None), (None, None, None),
])
def test_numbers_are_decimal_numbers(spark, text, number, whole):
    row = spark.createDataFrame([(text,)], "t string").select(fn.coerce_numeric(F.col("t")), fn.coerce_integer(F.col("t"))).first()
    assert tuple(row) == (number, whole)


@pytest.mark.parametrize("text", ["1.06.22", "01.6.22", "2022/6/1", "2022-6-1 00:00:00", "2022-06-01"])
def test_days_and_months_of_one_digit(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(fn.parse_date(F.col("t"), R.DATES)).first()[0] == D(2022, 6, 1)


def test_texts_without_a_format_s_separators_are_not_parsed(spark):
    """A text that cannot fit costs an exception in the parser; the result is that of trying every format."""
    texts = ["1.6.22", "2022/6/1", "2022-06-01 00:00:00", "2022-6-1", "Июнь", "Кол-во", "1.6/22", "", " ", "31.02.22", "2022-06-01T01:02:03",
             "2022-06-01t01:02:03", "2022-06-01 01:02:03.123456", "1.6.99", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain_day = [F.try_to_date("t", f) for f in R.DATES]
    plain_day[1] = F.when(F.year(plain_day[1]) >= 2069, F.add_months(plain_day[1], -1200)).otherwise(plain_day[1])
    plain_time = [F.try_to_timestamp("t", F.lit(f)).cast("timestamp_ntz") for f in R.TIMES]
    got = df.select(fn.parse_date(F.col("t"), R.DATES).alias("d"), fn.parse_timestamp(F.col("t"), R.TIMES).alias("s"),
                    F.coalesce(*plain_day).alias("e"), F.coalesce(*plain_time).alias("u"))
    assert all(r.d == r.e and r.s == r.u for r in got.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(t#" in plan
    assert got.filter("d IS NOT NULL").count() == 5
