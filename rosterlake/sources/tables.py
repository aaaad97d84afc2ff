"""Table scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, location: str, columns: Sequence[str] | None = None, fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a table (parquet, orc, csv, jdbc …) and keep a few columns; the scan reads only those."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    table = reader.load() if fmt == "jdbc" else reader.load(location)
    return table.select(*columns) if columns else table
