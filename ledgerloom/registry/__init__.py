"""Registered queries, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under a name; without SQL only its rows are counted."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add


def load_all() -> None:
    from ledgerloom.registry import jobs, layout, ledger, loads, weather  # noqa: F401
