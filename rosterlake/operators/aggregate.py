"""Grouping, distinct and top-1 operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def group_max(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Largest value per key, combined on the map side first."""
    return df.groupBy(*keys).agg(F.max(value).alias(out))


def distinct_values(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Distinct values of some columns, over the rows that pass a filter."""
    rows = df if where is None else df.filter(where)
    return rows.select(*columns).distinct()


def pending_values(df: DataFrame, result: str, column: str) -> DataFrame:
    """Distinct values of ``column`` among rows whose result is still missing."""
    return distinct_values(df, [column], F.col(result).isNull())


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in the given order.

    Spark cuts each map task to one row per key before the shuffle (a window group limit), so a
    hot key does not reach one task whole.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def last_date(df: DataFrame, column: str, default: Column, out: str) -> DataFrame:
    """One row: the largest date, or the default for an empty table."""
    return df.agg(F.coalesce(F.max(column), default).alias(out))


def top_rows(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of an order, as a top-k report without a full sort."""
    return df.orderBy(*order).limit(n)
