"""Every query that has SQL beside it gives the same rows in DuckDB."""

import glob
import os

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry_module

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(shaped, key=lambda row: tuple((cell is None, str(cell)) for cell in row))


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, db, name):
    result = QUERIES[name](spark, SF)
    expected = db.sql(SQL[name])
    assert table(result.columns, result.collect()) == table(list(expected.columns), expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["source", "target", "weight"]
