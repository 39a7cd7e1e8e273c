"""The register of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register the function under its own name, with its DuckDB twin."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register
