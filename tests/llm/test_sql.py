"""The corpus queries that SQL can express, against DuckDB."""

from pathlib import Path

import duckdb
import pytest

from pulsetrail.llm.oracle import all_sql
from pulsetrail.llm.queries import all_queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_same_as_sql(spark, name):
    database = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        database.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    wanted = database.sql(all_sql()[name])
    columns = sorted(wanted.columns)
    found = all_queries()[name](spark, SF)
    assert sorted(found.columns) == columns
    ours, theirs = found.select(*columns).collect(), wanted.select(", ".join(columns)).fetchall()
    assert sorted(map(str, map(tuple, ours))) == sorted(map(str, theirs))
