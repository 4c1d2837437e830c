"""Every registered query against its SQL counterpart, on whole tables."""

from decimal import Decimal
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry
from wavelane.suite.oracles import ORACLES
from wavelane.suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def canonical(columns, rows):
    """Rows as sorted tuples with columns in name order and floats to nine digits."""

    def cell(value):
        if isinstance(value, (float, Decimal)):
            return f"{float(value) + 0.0:.9g}" if value == value else "nan"
        return str(value)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    result = registry.queries()[name](spark, SF_DIR)
    got = canonical(result.columns, [tuple(row) for row in result.collect()])
    expected = database.execute(registry.oracle_sql()[name])
    want = canonical([d[0] for d in expected.description], expected.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert want[1], "the comparison must not be about nothing"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns[:3] == ["PATIENT_ID", "CHANNEL", "ALERT_DATE"]
    assert isinstance(result.toPandas(), pd.DataFrame)
