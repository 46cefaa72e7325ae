"""The table of queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``check`` is SQL giving the same rows from the same tables."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if check is not None:
            ORACLES[name] = check
        return function

    return register
