"""The registered query of every operator; the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import contracts  # noqa: F401

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import contracts  # noqa: F401

    return dict(SQL)
