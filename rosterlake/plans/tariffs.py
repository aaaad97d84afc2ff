"""Effective-dated tariffs: which price holds on a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.functions import whole
from rosterlake.operators.joins import dim_join, interval_max
from rosterlake.operators.quality import duplicate_keys
from rosterlake.operators.reshape import pivot_fields

# Tariff states.
ACTIVE, CLOSED = 3, 4

PRICE_KEY = ("date_", "project_id", "region_id", "speciality_id")


def date_bounds(days: DataFrame, column: str) -> tuple[Column, Column]:
    """First and last date of a small table of days, as literals the scans can filter by."""
    first, last = days.agg(F.min(column), F.max(column)).first()
    return F.lit(first).cast("date"), F.lit(last).cast("date")


def tariffs_in_force(tariffs: DataFrame, days: DataFrame, bounds: tuple[Column, Column]) -> DataFrame:
    """Latest tariff per day, project, region and speciality.

    Active tariffs count to their stop date, closed ones to the day they were closed unless that
    is the day they were created. ``days`` holds distinct days within ``bounds``.
    """
    first, last = bounds
    state = F.col("state_id")
    closed_later = F.to_date("created") != F.to_date("state_date")
    stop = F.when(state == CLOSED, F.to_date("state_date")).otherwise(F.to_date("date_stop"))
    usable = tariffs.filter((state == ACTIVE) | ((state == CLOSED) & closed_later))
    usable = usable.filter("date_start is not null").select(
        "id", *PRICE_KEY[1:], F.greatest(F.to_date("date_start"), first).alias("_start"), stop.alias("_stop"),
    )
    return interval_max(days, usable, "date_", "_start", "_stop", last, PRICE_KEY[1:], "id", "tariff_id")


def effective_prices(
    tariffs: DataFrame, prices: DataFrame, days: DataFrame, bounds: tuple[Column, Column]
) -> DataFrame:
    """Prices in force, one row per day, project, region, speciality and field."""
    held = tariffs_in_force(tariffs, days, bounds)
    columns = prices.select(F.col("tariff_id").alias("_tariff"), "field_id", "cost", "amount")
    return dim_join(held, columns, {"tariff_id": "_tariff"})


def wide_prices(
    tariffs: DataFrame,
    prices: DataFrame,
    days: DataFrame,
    bounds: tuple[Column, Column],
    fields: Sequence[int],
    integers: bool,
) -> DataFrame:
    """Prices in force with a column per field, one row per day, project, region and speciality.

    The prices are spread per tariff before they meet the facts, so that a fact is joined once and
    never multiplied by the number of fields.
    """
    listed = prices.filter(F.col("field_id").isin(list(fields)))
    if integers:
        listed = listed.withColumns({"cost": whole(F.col("cost")), "amount": whole(F.col("amount"))})
    spread = pivot_fields(listed, ["tariff_id"], "field_id", fields, ["cost", "amount"])
    held = tariffs_in_force(tariffs, days, bounds)
    # a tariff with none of the fields still holds; its prices are missing
    return dim_join(held, spread.withColumnRenamed("tariff_id", "_tariff"), {"tariff_id": "_tariff"}, "left")


def repeated_prices(prices: DataFrame, fields: Sequence[int]) -> DataFrame:
    """Tariffs and fields with more than one price; ``wide_prices`` takes one whole price of them."""
    return duplicate_keys(prices.filter(F.col("field_id").isin(list(fields))), ["tariff_id", "field_id"])

