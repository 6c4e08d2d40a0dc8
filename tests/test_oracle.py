"""Every registered query against its oracle, row by row.

The queries that write a folder per day take the better part of a minute each on
a local disk; RUN_DAY_WRITES=1 adds them.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.test_skew import FOLDER, WRITES
from verification.oracle import oracles
from verification.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
ORACLES = oracles()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def table_rows(table):
    columns = sorted(table.column_names)
    return columns, sorted(zip(*[table[c].to_pylist() for c in columns]), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    if name in WRITES and not os.environ.get("RUN_DAY_WRITES"):
        pytest.skip("writes a folder per day")
    got = QUERIES[name](spark, FOLDER).toArrow()
    expected = duck.sql(ORACLES[name]).to_arrow_table()
    assert table_rows(got) == table_rows(expected)
    for column in expected.column_names:
        assert got.schema.field(column).type == expected.schema.field(column).type, column


def test_entry(spark):
    frame = entry.entry(spark)
    assert len(frame.columns) == 24 and frame.count() == 4275
