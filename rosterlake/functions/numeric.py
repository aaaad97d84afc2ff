"""Column expressions over numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def finite_or(value: Column, default) -> Column:
    """``default`` for null, NaN and both infinities."""
    number = value.cast("double")
    bad = value.isNull() | F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.when(bad, F.lit(default)).otherwise(value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 where it would be null or infinite."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def whole(value: Column) -> Column:
    """Integer part, cut towards zero."""
    return value.cast("bigint")


def clock_hours(ts: Column) -> Column:
    """Time of day in hours, minutes as a fraction, seconds dropped."""
    return F.hour(ts) + F.minute(ts) / F.lit(60.0)


def overlap_hours(start: Column, finish: Column, low: int, high: int) -> Column:
    """Hours of a shift inside ``[low, high]`` when the shift starts inside the band, else 0.

    A missing finish counts as the upper bound, and a start before ``low`` gives 0.
    """
    end = F.when(finish < high, finish).otherwise(F.lit(float(high)))
    return F.when((start >= low) & (start <= end), end - start).otherwise(F.lit(0.0))
