"""Register a query once: how Spark builds it, its output types, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..oracle import finish
from ..session import tune
from ..sources.sample_tables import SampleTables

SPARK_TYPES = {"s": "string", "i": "bigint", "d": "double"}


@dataclass(frozen=True)
class Query:
    build: Callable[[SampleTables], DataFrame]
    columns: str
    sql: str | None

    def run(self, spark: SparkSession, path: str) -> DataFrame:
        result = self.build(SampleTables(tune(spark), path))
        return result.select(*[F.col(name).cast(SPARK_TYPES[kind]).alias(name)
                               for name, kind in (c.split(":") for c in self.columns.split())])


QUERIES: dict[str, Query] = {}


def register(name: str, columns: str, sql: str | None = None):
    def keep(build: Callable[[SampleTables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = Query(build, columns, sql)
        return build
    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query.run for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: finish(query.sql, query.columns) for name, query in QUERIES.items() if query.sql}
