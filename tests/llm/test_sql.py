"""Queries with SQL give the rows that DuckDB gives; the others are named with the reason why they have none."""

import duckdb
import pytest

from patronage.llm import oracle_sql, queries
from tests.llm.conftest import DATA

WITHOUT_SQL = {
    "op2_language", "op8_quality_neighbours",  # learned models
    "op3_simhash",  # DuckDB has no XXH64
    "op4_quality_rules",  # accuracies by expectation-maximisation
    "op5_vantage_points",  # a component that is not finite, and double sums in a fixed order
    "op6_packing", "op9_token_counts", "op10_bpe",  # token ids
    "op7_secrets",  # leftmost non-overlapping matches with places, entropy of windows
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    found = queries()[name](spark, DATA)
    columns = sorted(found.columns)
    result = duck.execute(oracle_sql()[name])
    places = [[c[0] for c in result.description].index(c) for c in columns]
    assert ordered(found.select(*columns).collect()) == ordered(tuple(r[i] for i in places) for r in result.fetchall())


def test_every_query_has_sql_or_a_reason():
    assert set(queries()) == set(oracle_sql()) | WITHOUT_SQL and not set(oracle_sql()) & WITHOUT_SQL
