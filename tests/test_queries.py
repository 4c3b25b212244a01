"""Every registered query against its SQL twin in DuckDB, over the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from shelfdiff.plans.catalog import Tables
from tools.compare import rows_of

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("SET TimeZone='UTC'")
    for table in Tables.NAMES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name in entry.oracle_sql():
        result = duck.sql(entry.oracle_sql()[name])
        assert got == rows_of(result.columns, result.fetchall())
    else:
        assert got[1]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["source_id", "week"]
    assert {r.source_id for r in df.collect()} == {"cu", "orion", "starbucks"}
