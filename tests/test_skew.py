"""Hot keys and the join that salts them alone."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import joins, skew


def keyed(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")


@pytest.mark.parametrize("slots", [1, 3, skew.SLOTS])
def test_hot_keys_are_exact(spark, rows, slots):
    rnd = random.Random(slots)
    keys = [rnd.choice([0, 0, 0, None, None, 1, *range(2, 60)]) for _ in range(700)]
    counts = Counter(keys)
    for one_in in (1, 2, 10, 40):
        want = [(k, n, -(-n * one_in // 700)) for k, n in counts.items() if n * one_in >= 700]
        assert rows(skew.hot_keys(keyed(spark, keys), ["k"], one_in, slots)) == sorted(
            want, key=lambda r: [(v is not None, str(v)) for v in r])


def test_hot_keys_of_several_columns_and_of_no_rows(spark, rows):
    pairs = spark.range(100).selectExpr("id % 2 AS a", "if(id % 4 = 0, 'x', string(id)) AS `b.c`")
    assert rows(skew.hot_keys(pairs, ["a", "b.c"], 10)) == [(0, "x", 25, 3)]
    assert skew.hot_keys(keyed(spark, []), ["k"]).count() == 0
    with pytest.raises(ValueError):
        skew.hot_keys(pairs, ["a"], 0)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_the_plain_join(spark, rows, how, null_safe):
    rnd = random.Random(5)
    fact = keyed(spark, [rnd.choice([0, 0, 0, 0, None, 1, *range(2, 30)]) for _ in range(500)])
    # other type and name of the key, two rows of the hot key, a null key, keys without facts
    dim = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (None, "d"), (7, "e"), (99, "f")], "d bigint, v string")
    plain = rows(joins.dim_join(fact, dim, {"k": "d"}, how, null_safe))
    assert rows(skew.skew_join(fact, dim, {"k": "d"}, how, null_safe, 10)) == plain
    assert len(plain) > 100
    for a, b in ((fact.limit(0), dim), (fact, dim.limit(0))):
        assert rows(skew.skew_join(a, b, {"k": "d"}, how, null_safe)) == rows(joins.dim_join(a, b, {"k": "d"}, how, null_safe))


def test_same_name_of_the_key_and_repeated_rows(spark, rows):
    fact = keyed(spark, [1] * 50 + [2, 3]).select("k").withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert Counter(r["v"] for r in skew.skew_join(fact, dim, {"k": "k"}, "left", one_in=5).collect()) == {"x": 50, "y": 1, None: 1}
    with pytest.raises(ValueError):
        skew.skew_join(fact, dim, {"k": "k"}, "full")


def test_only_hot_keys_are_salted_and_repeated(spark):
    fact = keyed(spark, [0] * 500 + list(range(1, 501)))
    hot = skew.hot_keys(fact, ["k"], 50)
    assert [tuple(r) for r in hot.collect()] == [(0, 500, 25)]
    salted = skew.spread(fact, hot, ["k"])
    per = {(r["k"], r["_salt"]): r["count"] for r in salted.groupBy("k", "_salt").count().collect()}
    assert {s for k, s in per if k != 0} == {0}
    assert len([s for k, s in per if k == 0]) == 25
    # a hot key's parts are about even
    assert max(n for (k, _), n in per.items() if k == 0) < 50
    dim = spark.range(-5, 300).selectExpr("id AS d")
    # 305 rows and 24 more of the hot key
    assert skew.repeated(dim, hot, {"k": "d"}).count() == 329
    assert salted.drop("_salt").exceptAll(fact).isEmpty()
