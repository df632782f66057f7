"""Name to query, and name to SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def range_of(expression: str, source: str) -> str:
    """SQL for one row with the range of an expression: lo, hi and sc, the scale."""
    return f"""select min(v) as lo, max(v) as hi, case when max(v) = min(v) then 1.0 else max(v) - min(v) end as sc
    from (select {expression} as v from {source})"""
