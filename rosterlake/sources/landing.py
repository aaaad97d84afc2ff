"""Delivered files: names, senders, and recognising reports by their header."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake.session import settle


def landing_metadata(df: DataFrame, name: str) -> DataFrame:
    """Split a landing name ``N.YYYY-MM-DD.sender.original``; N counts the characters before
    ``original``. Adds ``file_date``, ``sender`` and ``filename``."""
    full = F.col(name)
    parts = F.split(full, r"\.", 3)
    prefix = F.get(parts, F.lit(0)).try_cast("int")
    day = F.get(parts, F.lit(1))
    sender_at = F.length(F.get(parts, F.lit(0))) + F.length(day) + F.lit(3)
    return df.withColumns(
        {
            "file_date": F.try_to_date(day, "yyyy-MM-dd"),
            "sender": F.substr(full, sender_at, prefix - sender_at),
            "filename": F.substr(full, prefix + F.lit(1)),
        }
    )


def delivery_filter(
    df: DataFrame,
    sender: str,
    name: str,
    senders: Sequence[str] = (),
    domains: Sequence[str] = (),
    skip_suffixes: Sequence[str] = (".png",),
) -> DataFrame:
    """Keep deliveries of accepted senders (addresses or parts of one) and drop attachments by suffix."""
    accepted = F.col(sender).isin(list(senders)) if senders else F.lit(False)
    for domain in domains:
        accepted = accepted | F.contains(F.col(sender), F.lit(domain))
    for suffix in skip_suffixes:
        accepted = accepted & ~F.endswith(F.col(name), F.lit(suffix))
    return df.filter(accepted)


def landed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Landed files as ``(file, content)``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("_metadata.file_name").alias("file"), "content")
    )


@dataclass(frozen=True)
class Signature:
    """How a report kind is recognised: the whole header, or its first columns, and columns that
    must occur somewhere."""

    kind: str
    prefix: tuple[str, ...]
    exact: bool = False
    contains: tuple[str, ...] = ()

    def fits(self, headers: Column) -> Column:
        wanted = F.array(*[F.lit(h) for h in self.prefix])
        hit = headers == wanted if self.exact else F.slice(headers, 1, len(self.prefix)) == wanted
        for name in self.contains:
            hit = hit & F.array_contains(headers, name)
        return hit


def route(df: DataFrame, signatures: Sequence[Signature], headers: str, out: str = "kind") -> DataFrame:
    """Kind of each header by the first fitting signature, null when none fits."""
    kind = F.lit(None).cast("string")
    for signature in reversed(signatures):
        kind = F.when(signature.fits(F.col(headers)), F.lit(signature.kind)).otherwise(kind)
    return df.withColumn(out, kind)


def drop_unnamed(df: DataFrame, header: str) -> DataFrame:
    """Leave out header cells that are placeholders for an empty header."""
    return df.filter(~F.contains(F.col(header), F.lit("Unnamed:")))


def column_range(headers: Column, first: str, last: str) -> Column:
    """Positions (1-based) strictly between two named columns."""
    low, high = F.array_position(headers, first), F.array_position(headers, last)
    positions = F.sequence(F.lit(1).cast("bigint"), F.size(headers).cast("bigint"))
    return F.filter(positions, lambda p: (p > low) & (p < high))


def trim_edges(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Drop the first and the last row of each group.

    The two bounds per group are combined on the map side, written out and joined back, so no group
    has to fit into one task and the rows stay in place while the bounds are small.
    """
    bounds = df.groupBy(*keys).agg(F.min(order).alias("_low"), F.max(order).alias("_high"))
    bounds = settle(bounds, "bounds")
    inside = (F.col(order) > F.col("_low")) & (F.col(order) < F.col("_high"))
    return df.join(bounds, list(keys)).filter(inside).select(df.columns)
