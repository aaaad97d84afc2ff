"""Join operators.

No join here carries a broadcast hint: Spark broadcasts a side whose size it has checked against
``spark.sql.autoBroadcastJoinThreshold`` (from statistics, or measured at run time by AQE) and
shuffles otherwise, splitting hot partitions. ``salts`` splits a hot key explicitly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    how: str = "inner",
    null_safe: bool = False,
    salts: int = 1,
) -> DataFrame:
    """Join a fact to a dimension on ``{fact column: dimension column}``.

    The key columns of the dimension are dropped unless they share the fact's name, in which case
    the fact's column is kept. ``null_safe`` lets null keys match each other. With ``salts`` > 1
    the rows of one fact key go to that many partitions and the dimension is repeated for each.
    """
    keys = {d: f"_dim_{i}" for i, d in enumerate(on.values())}
    dim = dim.withColumnsRenamed(keys)
    cond = None
    for f_name, d_name in on.items():
        left, right = F.col(f_name), F.col(keys[d_name])
        same = left.eqNullSafe(right) if null_safe else left == right
        cond = same if cond is None else cond & same
    if salts > 1:
        row = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
        fact = fact.withColumn("_salt", F.pmod(row, F.lit(salts)).cast("int"))
        dim = dim.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cond = cond & (F.col("_salt") == F.col("_dim_salt"))
    return fact.join(dim, cond, how).drop("_salt", "_dim_salt", *keys.values())


def lookup_chain(fact: DataFrame, lookups: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Left lookups one after another; each dimension brings its remaining columns."""
    for dim, on in lookups:
        fact = dim_join(fact, dim, on, "left")
    return fact


def lookup_default(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str], value: str, default, flag: str
) -> DataFrame:
    """Left lookup of one value with a default; ``flag`` marks rows that were not found."""
    joined = dim_join(fact, dim, on, "left")
    return joined.withColumn(flag, F.col(value).isNull()).withColumn(
        value, F.coalesce(F.col(value), F.lit(default))
    )


def member_rows(fact: DataFrame, members: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    return fact.join(members.select(*columns), list(columns), "left_semi")


def _equal_rows(
    rows: DataFrame, other: DataFrame, columns: Sequence[str], null_safe: bool, how: str
) -> DataFrame:
    renamed = other.select(*[F.col(c).alias(f"_o_{c}") for c in columns])
    cond = None
    for c in columns:
        left, right = F.col(c), F.col(f"_o_{c}")
        same = left.eqNullSafe(right) if null_safe else left == right
        cond = same if cond is None else cond & same
    return rows.join(renamed, cond, how)


def absent_rows(
    batch: DataFrame, table: DataFrame, columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of ``batch`` with no row in ``table`` equal in all columns.

    As with SQL equality a null in any compared column means "not present", unless ``null_safe``.
    """
    return _equal_rows(batch, table, columns, null_safe, "left_anti")


def present_rows(
    table: DataFrame, batch: DataFrame, columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of ``table`` equal in all columns to a row of ``batch``."""
    return _equal_rows(table.select(*columns), batch, columns, null_safe, "left_semi")


def frontier(places: DataFrame, searches: Sequence[Mapping[str, object]]) -> DataFrame:
    """One row per place and search, by exploding the literal list of searches on each place."""
    names = list(searches[0])
    rows = F.array(*[F.struct(*[F.lit(s[n]).alias(n) for n in names]) for s in searches])
    return places.withColumn("_search", F.explode(rows)).select(
        *places.columns, *[F.col(f"_search.{n}").alias(n) for n in names]
    )


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    start: str,
    stop: str,
    horizon: Column,
    on: Sequence[str] = (),
    bin_days: int = 30,
) -> DataFrame:
    """Days within ``[start, stop]``; a null stop is open-ended.

    Each interval is cut at ``horizon`` (a day no point exceeds) and repeated once per bin of
    ``bin_days`` days it touches, so the match is an equi-join on the bin that Spark can hash,
    shuffle and split; the exact bounds are checked after it. ``on`` adds equal keys.
    """
    epoch = F.lit("1970-01-01").cast("date")
    last = F.least(F.coalesce(F.col(stop), horizon), horizon)

    def bin_of(day: Column) -> Column:
        return F.floor(F.datediff(day, epoch) / F.lit(bin_days)).cast("int")

    cut = intervals.withColumn("_last", last).filter(F.col(start) <= F.col("_last"))
    bins = cut.withColumn("_bins", F.sequence(bin_of(F.col(start)), bin_of(F.col("_last"))))
    binned = bins.withColumn("_bin_i", F.explode("_bins")).drop("_bins", "_last")
    binned = binned.withColumnsRenamed({k: f"_i_{k}" for k in on})
    cond = F.col("_bin_p") == F.col("_bin_i")
    for k in on:
        cond = cond & (F.col(k) == F.col(f"_i_{k}"))
    if bin_days > 1:
        inside = F.col(stop).isNull() | (F.col(point) <= F.col(stop))
        cond = cond & (F.col(point) >= F.col(start)) & inside
    return (
        points.withColumn("_bin_p", bin_of(F.col(point)))
        .join(binned, cond)
        .drop("_bin_p", "_bin_i", *[f"_i_{k}" for k in on])
    )


def interval_max(
    days: DataFrame,
    intervals: DataFrame,
    day: str,
    start: str,
    stop: str,
    horizon: Column,
    keys: Sequence[str],
    value: str,
    out: str,
) -> DataFrame:
    """Largest value per day and key among the intervals that hold the day.

    The same as ``interval_join`` and a group maximum, without its day by interval rows: an
    interval becomes its full months and the single days left at its ends, the maximum per key is
    taken of those, and a day then looks up its own and its month's.
    """
    last = F.least(F.coalesce(F.col(stop), horizon), horizon)
    cut = intervals.withColumns({"_from": F.col(start), "_last": last}).filter("_from <= _last")

    def month(d: Column) -> Column:
        return F.trunc(d, "month")

    begins_month = month(F.col("_from")) == F.col("_from")
    cut = cut.withColumns(
        {
            "_full": F.when(begins_month, F.col("_from")).otherwise(F.add_months(month(F.col("_from")), 1)),
            "_rest": month(F.date_add("_last", 1)),
        }
    )
    full, rest = F.col("_full"), F.col("_rest")
    none = F.array().cast("array<date>")
    months = F.when(
        full < rest, F.sequence(full, F.add_months(rest, -1), F.expr("INTERVAL 1 MONTH"))
    ).otherwise(none)
    head = F.when(
        F.col("_from") < full, F.sequence("_from", F.least(F.date_sub(full, 1), F.col("_last")))
    ).otherwise(none)
    tail = F.when((rest >= full) & (rest <= F.col("_last")), F.sequence(rest, F.col("_last"))).otherwise(none)

    def spans(dates: Column, whole_month: bool) -> Column:
        return F.transform(dates, lambda d: F.struct(F.lit(whole_month).alias("m"), d.alias("d")))

    covered = cut.select(
        *keys, value, F.explode(F.concat(spans(months, True), spans(head, False), spans(tail, False))).alias("_s")
    )
    best = covered.groupBy(*keys, "_s").agg(F.max(value).alias(out))
    own, whole = (
        F.struct(F.lit(m).alias("m"), d.alias("d")) for m, d in ((False, F.col(day)), (True, month(F.col(day))))
    )
    probes = days.select(day, F.explode(F.array(own, whole)).alias("_s"))
    return best.join(probes, "_s").groupBy(day, *keys).agg(F.max(out).alias(out))
