"""Registered queries: each operator and pipeline over the given tables, with equivalent SQL."""

from rosterlake.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates, cleaning, ingests, joining, logs, pay, scans, stores, streams, writing,
)
from rosterlake.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
