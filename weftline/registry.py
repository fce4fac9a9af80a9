"""Where queries register, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable], Callable]:
    """Register a query under its function's name. It is given a reader of the driver's tables by name."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
