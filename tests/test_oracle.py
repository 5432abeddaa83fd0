"""Every registered query against DuckDB on the same tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()
# The training-data operators are tested by themselves (tests/llm), where they are present.
QUERIES = {name: query for name, query in QUERIES.items() if not name.startswith("op") and name != "pipeline"}
ORACLES = {name: sql for name, sql in ORACLES.items() if name in QUERIES}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def comparable(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = Counter(tuple(comparable(row[c]) for c in columns) for row in df.collect())

    cursor = database.execute(ORACLES[name])
    described = {column[0]: str(column[1]) for column in cursor.description}
    order = [column[0] for column in cursor.description]
    positions = [order.index(c) for c in columns]
    theirs = Counter(tuple(comparable(row[p]) for p in positions) for row in cursor.fetchall())

    assert sorted(order) == columns
    assert {f.name: TYPE_NAMES[f.dataType.simpleString()] for f in df.schema.fields} == described
    assert sum(ours.values()) > 0
    assert ours == theirs


def test_flagship(spark):
    assert entry_points.entry(spark).columns == ["sentiment", "count", "percentage"]
