"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from workload import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Spark type -> DuckDB type
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}

# What no plan may hold: Python workers, and joins that pair everything with everything.
UNWANTED = ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    rows = [tuple(row) for row in result.select(*columns).collect()]
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]

    cursor = duck.execute(driver.oracle_sql()[name])
    described = {column[0]: str(column[1]) for column in cursor.description}
    order = [list(described).index(column) for column in columns]
    expected = [tuple(row[i] for i in order) for row in cursor.fetchall()]

    assert {c: TYPES[t] for c, t in result.dtypes} == described
    assert rows, "compares nothing"
    assert in_order(rows) == in_order(expected)


def test_entry(spark):
    assert driver.entry(spark).count() == 3


def test_every_query_has_sql():
    assert QUERIES.keys() <= driver.queries().keys()
    assert QUERIES.keys() <= driver.oracle_sql().keys()
