"""Named queries over the driver tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quorumlens.catalog.adapters import plain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows are checked."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            return plain(fn(spark, sf))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
