"""Every query against the same query in SQL on another engine."""

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pulsetrail.plans.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: query for name, query in queries().items() if name in all_queries()}
SQL = {name: sql for name, sql in oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is None, "" if v is None else v) for v in row])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry(spark).columns == ["key", "value", "event_time_ms", "due_ms"]
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = database.execute(SQL[name])
    names = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(names)
    columns = sorted(names)
    ours = _sorted([tuple(row[c] for c in columns) for row in result.collect()])
    at = [names.index(c) for c in columns]
    theirs = _sorted([tuple(row[i] for i in at) for row in expected.fetchall()])
    assert len(ours) == len(theirs) > 0
    different = [
        (column, x, y)
        for a, b in zip(ours, theirs)
        for column, x, y in zip(columns, a, b)
        if x != y and not (x != x and y != y)
    ]
    assert not different, f"{len(different)} values differ, first: {different[:3]}"
