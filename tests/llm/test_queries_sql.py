"""Queries that SQL can express, against DuckDB on whole tables."""

from pathlib import Path

import duckdb
import pytest

from wavelane.llm.oracles import ORACLES
from wavelane.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = database.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = sorted(map(str, (tuple(r) for r in result.select(*columns).collect())))
    assert got == sorted(map(str, expected.fetchall()))
