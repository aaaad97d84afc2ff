"""Data-quality counts and audit rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rosterlake.operators.store import Change

AUDIT_COLUMNS = ("event_type", "event_source", "description")
LOG_SCHEMA = StructType([StructField(c, StringType()) for c in AUDIT_COLUMNS])


def quality_counts(df: DataFrame, checks: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows failing each check, as ``(<by…>, check_name, bad_rows)``, in one pass over the data.

    With ``by`` columns, such as the file name, they are counted for each of their values.
    """
    names = list(checks)
    counted = df.groupBy(*by).agg(*[F.count_if(checks[n]).alias(n) for n in names])
    return counted.unpivot(list(by), names, "check_name", "bad_rows")


def null_columns(df: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """Names of the columns that hold a null, the allowed ones left out, in one pass."""
    names = [c for c in df.columns if c not in set(allowed)]
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    return counted.unpivot([], names, "column_name", "null_rows").filter("null_rows > 0")


def audit_row(counts: DataFrame, event: str, source: str, text: Column) -> DataFrame:
    """Audit rows built from count rows."""
    return counts.select(
        F.lit(event).alias("event_type"), F.lit(source).alias("event_source"), text.alias("description")
    )


def warnings(counts: DataFrame, source: str, text: Column) -> DataFrame:
    """A warning per check that found rows."""
    return audit_row(counts.filter("bad_rows > 0"), "warning", source, text)


def empty_load_warning(df: DataFrame, source: str, text: str) -> DataFrame:
    """A warning row when a load has no rows, otherwise no row."""
    return audit_row(
        df.limit(1).agg(F.count("*").alias("n")).filter("n = 0"), "warning", source, F.lit(text)
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows_found")).filter("rows_found > 1")


def append_audit(change: Change, rows: DataFrame, name: str = "log") -> int:
    """Append audit rows to the run log of a store, in the same version as what they tell of; returns how many."""
    change.create(name, LOG_SCHEMA)
    return change.append(name, rows)


def log_counts(change: Change, source: str, counts: Mapping[str, int], text: str = "nothing new") -> None:
    """An event that tells the rows per action, as they were counted while the rows were written."""
    told = ", ".join(f"{kind} {n}" for kind, n in counts.items()) if sum(counts.values()) else text
    append_audit(change, change.spark.createDataFrame([("event", source, told)], LOG_SCHEMA))
