"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def exact(expression: str, digits: int) -> str:
    """SQL for decimal rounding by exact value, ties to even."""
    return f"CAST(format('{{:.{digits}f}}', CAST({expression} AS DOUBLE)) AS DOUBLE)"
