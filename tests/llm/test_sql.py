"""Every dealt query that SQL can express against its SQL in DuckDB, on whole tables."""

import os
from pathlib import Path

import duckdb
import pytest

from candlewick.llm import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        files = f"{file}/*.parquet" if file.is_dir() else file
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{files}')")
    yield connection
    connection.close()


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, database, name):
    frame = queries.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    ours = ordered(tuple(row) for row in frame.select(columns).collect())
    result = database.execute(queries.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    theirs = ordered(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
