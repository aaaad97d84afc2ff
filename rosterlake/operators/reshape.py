"""Long ↔ wide reshaping and expansion of weekly templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.functions import coerce_numeric, iso_weekday, parse_date


def pivot_fields(
    df: DataFrame, keys: Sequence[str], field: str, fields: Sequence[int], values: Sequence[str]
) -> DataFrame:
    """One row per key with a column ``<value>_<field>`` for every listed field.

    The fields are given, so no pass over the data is needed to find them, and each map task
    combines its rows before the shuffle. A field that a key has twice gives all its values from one
    of the two rows, the larger by the values in order.
    """
    whole = F.struct(*[F.col(v) for v in values])
    kept = [F.max(F.when(F.col(field) == f, whole)).alias(f"_{f}") for f in fields]
    spread = df.groupBy(*keys).agg(*kept)
    return spread.select(*keys, *[F.col(f"_{f}")[v].alias(f"{v}_{f}") for v in values for f in fields])


def unpivot_columns(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """Wide columns to rows ``(ids, name, value)``."""
    return df.unpivot(list(ids), list(columns), name, value)


def dated_columns(headers: Column, formats: Sequence[str]) -> Column:
    """Positions of the headers that are dates, as ``array<struct<day, at>>``.

    Names and totals are not dates and drop out, whatever columns a file carries.
    """
    parsed = F.transform(
        headers, lambda h, i: F.struct(parse_date(h, formats).alias("day"), i.alias("at"))
    )
    return F.filter(parsed, lambda d: d["day"].isNotNull())


def unpivot_cells(rows: DataFrame, ids: Sequence[str], day: str, value: str) -> DataFrame:
    """Sheet rows (``cells`` with ``days`` from ``dated_columns``) to one row per date.

    Values are numbers, null where a cell is empty or not numeric. Rows are repeated inside their
    task; nothing is shuffled.
    """
    dated = rows.select(*ids, "cells", F.explode("days").alias("_day"))
    return dated.select(
        *ids,
        F.col("_day.day").alias(day),
        coerce_numeric(F.get(F.col("cells"), F.col("_day.at"))).alias(value),
    )


def weekly_template(
    template: DataFrame, weekday: str, delivered: Column, offsets: tuple[int, int], out: str
) -> DataFrame:
    """Emit each template row on the days of ``delivered + offsets`` that fall on its weekday."""
    first, last = offsets
    days = F.sequence(F.date_add(delivered, first), F.date_add(delivered, last))
    return template.withColumn(out, F.explode(days)).filter(iso_weekday(F.col(out)) == F.col(weekday))


def union_sheets(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack two sheets by column name; a column one of them lacks becomes null."""
    return first.unionByName(second, allowMissingColumns=True)
