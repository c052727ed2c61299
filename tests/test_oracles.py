"""Every registered query against its SQL in DuckDB, on the sample tables."""

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registered  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
CORPUS = registered._corpus()[0]
QUERIES = {name: query for name, query in registered.queries().items() if name not in CORPUS}
ORACLES = {name: sql for name, sql in registered.oracle_sql().items() if name not in CORPUS}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in ("events", "orders"):
        connection.execute(
            f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def rows(columns, records):
    """Rows with columns in name order, in a fixed row order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(record[i] for i in order) for record in records), key=repr)


def equal(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-12, abs_tol=1e-12)
    return type(left) is type(right) and left == right


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    assert sorted(frame.columns) == sorted(names)
    ours, theirs = rows(frame.columns, frame.collect()), rows(names, expected.fetchall())
    assert len(ours) == len(theirs) > 0
    for left, right in zip(ours, theirs):
        assert all(map(equal, left, right)), (left, right)


def test_entry(spark):
    assert registered.entry(spark).columns == list(registered.HOUR.gold_columns)
