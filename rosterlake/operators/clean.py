"""Filling, cleaning and stamping of delivered rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.functions import add_hours, finite_or


def select_as(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Keep and rename columns: ``{target: source}``."""
    return df.select(*[F.col(f"`{source}`").alias(target) for target, source in columns.items()])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace null and NaN by a default per column."""
    return df.fillna(dict(defaults))


def clean_nonfinite(df: DataFrame, columns: Sequence[str], default=None) -> DataFrame:
    """Replace null, NaN and infinities by ``default`` (null unless given)."""
    return df.withColumns({c: finite_or(F.col(c), default) for c in columns})


def drop_optional(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns that may be absent."""
    return df.drop(*columns)


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add constant or provenance columns; values are literals or expressions."""
    return df.withColumns(
        {name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()}
    )


def fill_activation(
    df: DataFrame, start: str, end: str, hours: str, day: str, first_hour: int = 6
) -> DataFrame:
    """Complete missing shift bounds.

    Both missing: the shift starts at ``first_hour`` of its day. Start missing: end − hours.
    End missing: the (completed) start + hours.
    """
    s, e, h = F.col(start), F.col(end), F.col(hours)
    morning = F.col(day).cast("timestamp_ntz") + F.expr(f"INTERVAL '{first_hour}' HOUR")
    begin = F.coalesce(s, F.when(e.isNotNull(), add_hours(e, h, -1)).otherwise(morning))
    return df.withColumn(start, begin).withColumn(end, F.coalesce(e, add_hours(s, h)))


def snapshot_predicate(active: Column, changed: Column, as_of_day: Column) -> Column:
    """Active rows, or inactive rows that were changed on the given day."""
    return active | (~active & (F.to_date(changed) == as_of_day))
