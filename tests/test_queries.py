"""Every registered query with SQL gives the same rows as DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA
from patronage import queries as registered

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SQL = registered.oracle_sql()
FITTED = {"clv_predictions", "clv_metrics", "churn_predictions", "churn_metrics", "churn_importances", "next_purchase",
          "survival_concordance", "segment_clusters", "cluster_search"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    result = registered.queries()[name](spark, DATA)
    columns = sorted(result.columns)
    expected = duck.execute(SQL[name])
    places = [[c[0] for c in expected.description].index(c) for c in columns]
    found = ordered(tuple(r) for r in result.select(*columns).collect())
    assert found == ordered(tuple(r[i] for i in places) for r in expected.fetchall())


def test_only_fitted_models_have_no_sql():
    assert set(registered.queries()) - set(SQL) == FITTED


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
