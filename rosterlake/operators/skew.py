"""Joins on keys of which a few hold much of the rows: those keys are found, and they alone are salted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType

from rosterlake.operators.joins import dim_join
from rosterlake.session import settle

#: A key is hot if it holds at least one in so many rows.
ONE_IN = 50
#: Slots of the sketch that finds where hot keys can be.
SLOTS = 1 << 16


def hot_keys(rows: DataFrame, keys: Sequence[str], one_in: int = ONE_IN, slots: int = SLOTS) -> DataFrame:
    """Keys that hold at least one in ``one_in`` rows: the key columns, ``rows_found`` and ``salts``.

    ``salts`` is the number of parts to cut the key's rows into, so that none holds more than that share. A null
    key counts like any other. The result is exact and has ``one_in`` rows at most.

    The rows are first counted by a hash of their key in ``slots`` slots, one row of a count-min sketch, which
    each task brings down to so many rows before the shuffle. A hot key's slot is at least as full as the key, so only keys of
    full slots, also ``one_in`` at most, are counted one by one. Both passes read the key columns only.
    """
    if one_in < 1 or slots < 1:
        raise ValueError("one_in and slots must be positive")
    named = rows.select(*[F.col(f"`{k}`") for k in keys])
    slot = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(slots)).cast("int")
    sketch = settle(named.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")), "key_sketch")
    total = sketch.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # a slot is full if it holds its share of all rows, so there are no more than one_in of them
    full = [r["slot"] for r in sketch.filter(F.col("n") * one_in >= total).collect()]
    share = F.col("rows_found") * one_in
    counted = named.filter(slot.isin(full)).groupBy(*[f"`{k}`" for k in keys]).agg(F.count("*").alias("rows_found"))
    return counted.filter(share >= total).withColumn("salts", F.ceil(share / F.lit(total)).cast("int"))


def _salted_by(df: DataFrame, hot: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """The rows with ``_salts``, the number of parts of their key; ``on`` names hot keys by the frame's columns."""
    return dim_join(df, hot.select(*on.values(), F.col("salts").alias("_salts")), on, "left", null_safe=True)


def spread(fact: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with ``_salt``: 0, but for hot keys a number below the key's ``salts``, which the whole row decides.

    So a task that runs again gives the same salts. Rows that are equal in all columns stay together.
    """
    named = {k: f"_hot_{i}" for i, k in enumerate(keys)}
    whole: list[Column] = [F.col(f"`{f.name}`") for f in fact.schema if not isinstance(f.dataType, MapType)]
    salted = _salted_by(fact, hot.withColumnsRenamed(named), named)
    return salted.withColumn("_salt", F.pmod(F.xxhash64(*whole), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")


def repeated(dim: DataFrame, hot: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Dimension rows with ``_dim_salt``: once, but those of a hot key once for each of its salts."""
    named = {f: f"_hot_{i}" for i, f in enumerate(on)}
    salted = _salted_by(dim, hot.withColumnsRenamed(named), {d: named[f] for f, d in on.items()})
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return salted.withColumn("_dim_salt", F.explode(salts)).drop("_salts")


def skew_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    how: str = "inner",
    null_safe: bool = False,
    one_in: int = ONE_IN,
) -> DataFrame:
    """``dim_join`` in which the rows of hot keys are spread over as many partitions as their share asks for.

    ``how`` is ``inner`` or ``left``. Other keys are neither salted nor are their dimension rows repeated, so a dimension
    grows by ``one_in`` parts of hot keys' rows at most. Rows with a null key, which meet nothing unless ``null_safe``, are spread in the
    same way. The table of hot keys has at most ``one_in`` rows and is settled, so Spark knows its size.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a salted join is inner or left, not {how}")
    hot = settle(hot_keys(fact, list(on), one_in), "hot_keys")
    return dim_join(
        spread(fact, hot, list(on)), repeated(dim, hot, on), {**on, "_salt": "_dim_salt"}, how, null_safe
    ).drop("_salt")
