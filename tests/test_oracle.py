"""Every query against its SQL counterpart in DuckDB, on whole tables."""

import os
from pathlib import Path

import __spark_entry__ as entry_point
import duckdb
import pytest
from candlewick.plans import catalog

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, database, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    ours = ordered(tuple(row) for row in frame.select(columns).collect())
    result = database.execute(entry_point.oracle_sql()[name])
    assert sorted(c[0] for c in result.description) == columns
    names = [c[0] for c in result.description]
    theirs = ordered(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns[:2] == ["date", "symbol"]
    assert frame.count() == 1089
