"""Every registered query against plain SQL in another engine, on whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = ["orders", "lineitem"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(value, 7) if isinstance(value, float) else value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(cells, key=repr)


def test_every_query_has_an_oracle():
    assert set(entry_module.PLANS) <= set(entry_module.queries()) & set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry_module.PLANS))
def test_matches_oracle(spark, sf_dir, duck, name):
    result = entry_module.queries()[name](spark, sf_dir)
    actual = table_of(result.columns, result.collect())
    cursor = duck.execute(entry_module.oracle_sql()[name])
    expected = table_of([c[0] for c in cursor.description], cursor.fetchall())
    assert actual == expected
    assert actual[1], "a query without rows checks nothing"


def test_entry(spark):
    flagship = entry_module.entry(spark)
    assert flagship.columns == ["machine_id", "fraction"]
    assert flagship.count() == 10
