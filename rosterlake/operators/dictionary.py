"""Conformed dictionaries: finding and numbering names a report brings in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from rosterlake.operators.store import Change
from rosterlake.session import settle


def dict_diff(report: DataFrame, dim: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Distinct ``{report column: dimension column}`` values the dimension lacks.

    Set semantics: null is a value like any other.
    """
    found = report.select(*[F.col(r).alias(d) for r, d in keys.items()]).distinct()
    known = dim.select(*[F.col(d).alias(f"_k_{d}") for d in keys.values()])
    cond = None
    for d in keys.values():
        same = F.col(d).eqNullSafe(F.col(f"_k_{d}"))
        cond = same if cond is None else cond & same
    return found.join(known, cond, "left_anti")


def dense_numbers(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Number rows 1, 2, … in a global order without moving them to one task.

    Rows are range-partitioned and numbered inside their partition; each partition is then shifted
    by the rows before it. The numbered rows are written out first, so that the shift counts exactly
    the partitions the numbers come from, also when an executor is lost.
    """
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), (in_part + 1).alias("_row")),
        "numbers",
    )
    # one row per partition
    sizes = ranged.groupBy("_part").agg(F.max("_row").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    return ranged.join(shifts, "_part").select(*df.columns, (F.col("_row") + F.col("_shift")).alias(out))


def dict_grow(
    dim: DataFrame,
    id_column: str,
    report: DataFrame,
    keys: Mapping[str, str],
    above: int = 0,
) -> DataFrame:
    """The dimension with the report's new values appended under the next free ids, which are greater than ``above`` too.

    It is written out: the ids are given once, and the facts are joined to a table of known size. Without
    new values the dimension itself is returned.
    """
    fresh = settle(dict_diff(report, dim, keys), "fresh")
    if fresh.isEmpty():
        return dim
    numbered = dense_numbers(fresh, list(keys.values()), "_n")
    top = dim.agg(F.greatest(F.coalesce(F.max(id_column), F.lit(0)), F.lit(above)).alias("top")).scalar()
    id_type = dim.schema[id_column].dataType
    added = numbered.select(
        (top + F.col("_n")).cast(id_type).alias(id_column),
        *keys.values(),
    )
    return settle(dim.unionByName(added, allowMissingColumns=True), "dictionary")


# Stored dictionaries -------------------------------------------------------------------------

_LAST = "last_id"


def start_dictionary(change: Change, name: str, dim: DataFrame, id_column: str) -> None:
    """Store a dictionary unless there is one of the name; from then on ids are given by the store alone."""
    if name not in change.tables:
        change.create(name, dim.schema)
        keep_growth(change, name, id_column, dim.limit(0), dim)


def last_id(change: Change, name: str) -> int:
    """The greatest id that was ever given; reading it makes the change wait for others that give ids."""
    return change.note(name, _LAST) or 0


def keep_growth(change: Change, name: str, id_column: str, before: DataFrame, after: DataFrame) -> int:
    """Store what a load added to a dictionary, in the same version as the load's rows; returns how many names.

    The ids up to the new last one are taken from then on. If another load stored ids first, the change is outdated, and
    the names are looked up again before any id is given.
    """
    if after is before:
        return 0
    fresh = settle(after.join(before.select(id_column), id_column, "left_anti").select(after.columns), "new_names")
    added = change.append(name, fresh)
    if added:
        change.set_note(name, _LAST, max(int(fresh.agg(F.max(id_column)).first()[0]), last_id(change, name)))
    return added
