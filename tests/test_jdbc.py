"""The parts that need no database; see the README for what is left untested."""

import datetime as dt

import duckdb
import pytest
from helpers import bars, day, rows

from candlewick.operators import replace
from candlewick.schema import FEATURE_COLUMNS
from candlewick.sinks.jdbc import _stamped, bounds_query, jdbc_options, lost_keys_query, replace_statements, slice_predicates

MYSQL = "jdbc:mysql://localhost:3306/prices"


def test_options_from_environment():
    assert jdbc_options({"MYSQL_DB": "prices"}) == {"user": "root", "url": MYSQL}
    full = {
        "MYSQL_HOST": "db",
        "MYSQL_PORT": "3307",
        "MYSQL_DB": "prices",
        "MYSQL_USER": "loader",
        "MYSQL_PASSWORD": "x",
    }
    assert jdbc_options(full) == {"user": "loader", "password": "x", "url": "jdbc:mysql://db:3307/prices"}
    assert jdbc_options({}, url="jdbc:redshift://h/d", user="u") == {"url": "jdbc:redshift://h/d", "user": "u"}
    with pytest.raises(ValueError):
        jdbc_options({})


def test_run_date_statements():
    delete, insert = replace_statements(MYSQL, "stock_prices", "staged", "replace_run_date", day(0))
    assert delete == ("DELETE FROM stock_prices WHERE CAST(`date` AS DATE) = CAST(? AS DATE)", ["2024-01-01"])
    assert insert[0].startswith("INSERT INTO stock_prices (`date`, `symbol`, `open`")
    assert " FROM staged s JOIN (SELECT `task_id`, MIN(`attempt_id`) AS `attempt_id` FROM staged GROUP BY `task_id`) a" in insert[0]


def test_other_statements():
    url = "jdbc:postgresql://h/d"
    (dates, _), _ = replace_statements(url, "t", "s", "replace_batch_dates")
    assert dates.startswith('DELETE FROM t WHERE "date" IN (SELECT "date" FROM s) OR "date" IS NULL AND EXISTS')
    (upsert, _), _ = replace_statements(url, "t", "s", "upsert_by_key")
    for name in ("symbol", "date"):  # null keys are equal, as in the Parquet warehouse
        assert f'(s."{name}" = t."{name}" OR s."{name}" IS NULL AND t."{name}" IS NULL)' in upsert
    with pytest.raises(ValueError):
        replace_statements(url, "t", "s", "replace_run_date")
    with pytest.raises(ValueError):
        replace_statements(url, "t", "s", "append")


POSTGRES = "jdbc:postgresql://h/d"
COLUMNS = ", ".join(f'"{c}" {"DATE" if c == "date" else "VARCHAR" if c in ("symbol", "volume_category") else "DOUBLE"}' for c in FEATURE_COLUMNS)


@pytest.fixture
def tables():
    """The statements run in this process's own in-memory tables; no database server is there."""
    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE t ({COLUMNS}); CREATE TABLE s ({COLUMNS}, task_id BIGINT, attempt_id BIGINT)")
    yield connection
    connection.close()


def fill(connection, table, found, *stamps):
    marks = ", ".join("?" * (3 + len(stamps)))
    names = ", ".join(["date", "symbol", "close", *["task_id", "attempt_id"][: len(stamps)]])
    for row in found:
        connection.execute(f"INSERT INTO {table} ({names}) VALUES ({marks})", [*row, *stamps])


STORED = [(day(i), s, 1.0) for i in range(4) for s in ("A", "B", None)] + [(None, "A", 1.0)]
BATCH = [(day(1), "A", 2.0), (day(2), "A", 2.0), (day(2), None, 2.0), (day(9), "C", 2.0), (None, "B", 2.0)]


@pytest.mark.parametrize("mode", ["replace_run_date", "replace_batch_dates", "upsert_by_key"])
def test_statements_equal_the_operators_and_take_one_attempt(spark, tables, mode):
    """Rows staged twice by a repeated task are inserted once; null keys are keys."""
    fill(tables, "t", STORED)
    fill(tables, "s", BATCH[:3], 0, 7)
    fill(tables, "s", BATCH[3:], 1, 8)
    fill(tables, "s", BATCH[:3], 0, 9)  # the first task again
    for text, parameters in replace_statements(POSTGRES, "t", "s", mode, day(1)):
        tables.execute(text, parameters)
    found = tables.execute("SELECT date, symbol, close FROM t").fetchall()
    target, batch = (bars(spark, [(d, s, c, 1) for d, s, c in part]) for part in (STORED, BATCH))
    operator = getattr(replace, mode)
    expected = operator(target, batch, day(1)) if mode == "replace_run_date" else operator(target, batch)
    key = lambda r: tuple(map(str, r))
    assert sorted(found, key=key) == sorted(map(tuple, expected.select("date", "symbol", "close").collect()), key=key)


def test_partial_batches_are_counted(tables):
    fill(tables, "t", STORED)
    fill(tables, "s", BATCH, 0, 1)
    assert tables.execute(lost_keys_query(POSTGRES, "t", "s")).fetchone() == (4,)  # B and null of day 1, B of day 2, A without date
    fill(tables, "s", [(day(1), "B", 1.0), (day(1), None, 1.0), (day(2), "B", 1.0), (None, "A", 1.0)], 0, 1)
    assert tables.execute(lost_keys_query(POSTGRES, "t", "s")).fetchone() == (0,)


@pytest.mark.parametrize("slices", [1, 3, 8, 100])
def test_slices_hold_every_row_once(tables, slices):
    fill(tables, "t", STORED)
    bounds = tables.execute(bounds_query(POSTGRES, "t")).fetchone()
    predicates = slice_predicates(POSTGRES, *bounds, slices)
    assert len(predicates) == min(slices, 4) + 1
    counts = [tables.execute(f"SELECT COUNT(*) FROM t WHERE {p}").fetchone()[0] for p in predicates]
    assert sum(counts) == len(STORED) and counts[-1] == 1 and max(counts[:-1]) - min(counts[:-1]) <= 3
    days = slice_predicates(POSTGRES, day(1), day(2), slices, no_date=False)
    assert sum(tables.execute(f"SELECT COUNT(*) FROM t WHERE {p}").fetchone()[0] for p in days) == 6
    noon = duckdb.sql(f"SELECT COUNT(*) FROM (SELECT TIMESTAMP '2024-01-03 12:00:00' AS date) WHERE {days[-1]}")
    assert noon.fetchall() == [(1,)]
    assert slice_predicates(POSTGRES, None, None, slices) == ['"date" IS NULL']
    assert slice_predicates(MYSQL, dt.date(2024, 1, 1), dt.date(2024, 1, 1), 4, no_date=False) == [
        "`date` >= CAST('2024-01-01' AS DATE) AND `date` < CAST('2024-01-02' AS DATE)"
    ]


def test_rows_are_stamped_with_task_and_attempt(spark):
    frame = bars(spark, [(day(i), "A", 1.0, 1) for i in range(20)]).repartition(4)
    stamped = _stamped(frame)
    assert rows(stamped.select(frame.columns)) == rows(frame)
    tasks = stamped.select("task_id", "attempt_id").distinct().collect()
    assert {r.task_id for r in tasks} == {0, 1, 2, 3} and len({r.attempt_id for r in tasks}) == len(tasks) == 4
