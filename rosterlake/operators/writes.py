"""Write semantics of a keyed table, as new states of that table.

The state functions return the whole next state and never touch storage. The functions on a ``Change``
store it; they read and write only the partitions concerned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rosterlake.operators.aggregate import keep_last
from rosterlake.operators.joins import absent_rows, member_rows, present_rows
from rosterlake.operators.store import Change
from rosterlake.session import settle


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    order: Sequence[str] = (),
    provenance: Sequence[str] = (),
    action: str | None = None,
    newer: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys; on a known key overwrite only the listed columns.

    ``order`` decides which of several updates of one key wins; without it there must be one row
    per key. A row with a null key never meets another and is always inserted. ``provenance``
    columns are overwritten only when one of ``update_columns`` differs (``<>``, so null never
    differs). ``action`` names a column telling inserted, updated and kept rows apart. With ``newer``
    columns, which both tables hold, a stored row only gives way to one that is not older by them.
    """
    given = [c for c in target.columns if c in updates.columns]
    keyed = _all_present(keys)
    latest = updates.filter(keyed)
    if order:
        latest = keep_last(latest, keys, order)
    latest = latest.select(given)
    old = target.withColumn("_in_target", F.lit(True)).alias("old")
    new = latest.withColumn("_in_updates", F.lit(True)).alias("new")
    cond = reduce(and_, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
    both = old.join(new, cond, "full_outer")

    known = F.coalesce(F.col("old._in_target"), F.lit(False))
    hit = F.col("new._in_updates").isNotNull()
    if newer:
        before, after = (F.struct(*[F.col(f"{side}.{c}").alias(c) for c in newer]) for side in ("old", "new"))
        hit = hit & (~known | (after >= before))
    hit = F.coalesce(hit, F.lit(False))
    differs = reduce(
        or_,
        [F.coalesce(F.col(f"old.{c}") != F.col(f"new.{c}"), F.lit(False)) for c in update_columns],
        F.lit(False),
    )

    def value(name: str) -> Column:
        if name not in given:
            return F.col(f"old.{name}")
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in provenance:
            return F.when(hit & (~known | differs), after).otherwise(before)
        if name in update_columns:
            return F.when(hit, after).otherwise(before)
        return F.when(known, before).otherwise(after)

    columns = [value(c).alias(c) for c in target.columns]
    if action:
        kind = F.when(known & hit, F.lit("updated")).when(hit, F.lit("inserted")).otherwise(F.lit("kept"))
        columns.append(kind.alias(action))
    # rows with a null key join nothing, and stay out of the shuffle the last rows already had
    keyless = updates.filter(~keyed).select(given)
    if action:
        keyless = keyless.withColumn(action, F.lit("inserted"))
    return both.select(*columns).unionByName(keyless, allowMissingColumns=True)


def keyed_update(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Set columns for the keys present in ``updates`` (one row per key), leave the rest alone."""
    new = updates.select(*keys, *columns).withColumn("_hit", F.lit(True)).alias("new")
    cond = reduce(and_, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
    joined = target.alias("old").join(new, cond, "left")
    hit = F.col("new._hit").isNotNull()
    return joined.select(
        *[
            F.when(hit, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            if c in columns
            else F.col(f"old.{c}")
            for c in target.columns
        ]
    )


def replace_dates(
    target: DataFrame, report: DataFrame, column: str, dates: DataFrame | None = None
) -> DataFrame:
    """Drop the rows of every date the report covers, then add the report.

    ``dates`` lists the covered dates when the report may hold none of a date's rows.
    """
    # a row per day at most; written out, so that its true size is known and the table stays in place
    covered = settle((report if dates is None else dates).select(column).distinct(), "dates")
    return target.join(covered, column, "left_anti").select(target.columns).unionByName(
        report, allowMissingColumns=True
    )


def insert_if_absent(
    target: DataFrame, batch: DataFrame, columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of a batch to append: those equal in all columns to no row of the table or the batch.

    With SQL equality a row holding a null equals nothing, itself included, and is always added;
    ``null_safe`` makes a rerun add nothing.
    """
    rows = batch.select(*columns)
    if null_safe:
        fresh = rows.dropDuplicates()
    else:
        whole = _all_present(columns)
        fresh = rows.filter(whole).dropDuplicates().unionByName(rows.filter(~whole))
    # a small batch is sent to the table's scan, which then only yields the rows both hold
    fresh = settle(fresh, "batch")
    known = present_rows(target, fresh, columns, null_safe)
    return absent_rows(fresh, known, columns, null_safe)


def blank_withdrawn(
    target: DataFrame,
    withdrawn: DataFrame,
    key: str,
    day: str,
    delivered: Column,
    loaded_until: Column,
    offsets: Sequence[int],
    blank: Sequence[str],
    stamps: Mapping[str, Column],
) -> DataFrame:
    """Null out columns of withdrawn keys on ``delivered + offset`` days that are already loaded."""
    gone = withdrawn.select(F.col(key).alias("_gone")).distinct()
    joined = target.join(gone, F.col(key) == F.col("_gone"), "left")
    ahead = F.datediff(F.col(day), delivered)
    hit = (
        F.col("_gone").isNotNull()
        & ahead.isin(list(offsets))
        & (ahead <= F.datediff(loaded_until, delivered))
    )
    hit = F.coalesce(hit, F.lit(False))
    changed = {c: F.when(~hit, F.col(c)) for c in blank}
    changed.update({c: F.when(hit, v).otherwise(F.col(c)) for c, v in stamps.items()})
    return joined.withColumns(changed).drop("_gone")


def daily_slice(df: DataFrame, columns: Sequence[str], as_of: Column, out: str = "fix_date") -> DataFrame:
    """Current rows stamped with the day before ``as_of``."""
    return df.select(*columns, F.date_sub(as_of, 1).alias(out))


# Stored tables -------------------------------------------------------------------------------


def merge_rows(
    change: Change,
    name: str,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    order: Sequence[str] = (),
    provenance: Sequence[str] = (),
    newer: Sequence[str] = (),
    anywhere: bool = False,
) -> dict[str, int]:
    """Upsert into a stored table; only the partitions the updates fall into are read and written, once.

    A key's row must stay in its partition, unless ``anywhere``: then the partitions that hold one of the keys are
    looked up first, in a scan of the key and partition columns, and rows may move. Returns the rows inserted and updated.
    """
    updates = settle(updates, "updates")
    parts = change.parts(name, updates)
    if anywhere:
        held = member_rows(change.read(name), updates.select(*keys).distinct(), keys)
        parts = sorted({*parts, *change.parts(name, held)})
    merged = upsert(change.read(name, parts), updates, keys, update_columns, order, provenance, "_action", newer)
    counts = change.replace(name, merged, parts, "_action")
    return {kind: counts[kind] for kind in ("inserted", "updated")}


def replace_covered(change: Change, name: str, report: DataFrame, dates: DataFrame, column: str) -> int:
    """``replace_dates`` on a stored table whose partition depends on the date alone; returns the rows of the report.

    Old rows of covered dates go and the report's come in one version. Dates the report covers (``dates``) without having
    rows for them lose their rows too.
    """
    report = settle(report, "report")
    covered = settle(dates.select(column).unionByName(report.select(column)).distinct(), "dates")
    parts = change.parts(name, covered)
    kept = absent_rows(change.read(name, parts), covered.filter(F.col(column).isNotNull()), [column])
    marked = kept.withColumn("_action", F.lit("kept")).unionByName(report.withColumn("_action", F.lit("inserted")), allowMissingColumns=True)
    return change.replace(name, marked, parts, "_action")["inserted"]


#: Partitions of a key index: the first two hex digits of a key.
KEY_PARTS = "substring(row_key, 1, 2)"


def add_absent(change: Change, name: str, batch: DataFrame, columns: Sequence[str], null_safe: bool = False) -> int:
    """``insert_if_absent`` on a stored table, by an index of its rows' keys; returns how many rows were added.

    A row's key is a digest of the compared columns. The index, a table of its own in 256 partitions by key, holds
    nothing else, and a batch reads only the partitions its keys fall into; the table itself is not read.
    """
    index = f"{name}_keys"
    change.create(index, StructType([StructField("row_key", StringType())]), KEY_PARTS)
    key = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    keyed = settle(batch.withColumn("row_key", key), "batch")
    # as in SQL a row holding a null equals nothing, unless it shall
    comparable = F.lit(True) if null_safe else _all_present(columns)
    known = change.read(index, change.parts(index, keyed))
    fresh = absent_rows(keyed.filter(comparable).dropDuplicates(["row_key"]), known, ["row_key"])
    fresh = settle(fresh.withColumn("_known", F.lit(True)).unionByName(keyed.filter(~comparable).withColumn("_known", F.lit(False))), "fresh")
    change.append(index, fresh.filter("_known"))
    return change.append(name, fresh)
