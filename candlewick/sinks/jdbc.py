"""The warehouse table in a relational database.

Executors append in batches to a staging table; one driver-side transaction
then deletes and inserts inside the database, so readers see the old rows or
the new ones. No row passes through the driver.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.schema import FEATURE_COLUMNS, KEYS
from candlewick.sinks.warehouse import MODES

COLUMN_TYPES = "symbol VARCHAR(32), volume_category VARCHAR(8)"
STAMPS = ("task_id", "attempt_id")
STAMP_TYPES = ", task_id BIGINT, attempt_id BIGINT"


def jdbc_options(env: Mapping[str, str] | None = None, **overrides: str) -> dict[str, str]:
    """Connection options from MYSQL_HOST, _PORT, _DB, _USER and _PASSWORD.

    Pass ``url`` (and ``driver``) for any other JDBC database.
    """
    env = os.environ if env is None else env
    options = {"user": env.get("MYSQL_USER", "root"), **overrides}
    if "MYSQL_PASSWORD" in env:
        options.setdefault("password", env["MYSQL_PASSWORD"])
    if "url" not in options:
        if "MYSQL_DB" not in env:
            raise ValueError("set MYSQL_DB or pass url")
        host, port = env.get("MYSQL_HOST", "localhost"), int(env.get("MYSQL_PORT", 3306))
        options["url"] = f"jdbc:mysql://{host}:{port}/{env['MYSQL_DB']}"
    return options


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    dates: tuple[dt.date, dt.date] | None = None,
    partitions: int = 8,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table in slices by date, one task each; with ``dates`` (first, last) only those days.

    Without ``dates`` one query measures the first and last date; rows without
    date are a slice of their own.
    """
    reader = spark.read.format("jdbc").options(fetchsize=fetch_size, **options)
    if dates is None:
        measured = reader.option("query", bounds_query(options["url"], table)).load().first()
        slices = slice_predicates(options["url"], *measured, partitions)
    else:
        slices = slice_predicates(options["url"], *dates, partitions, no_date=False)
    connection = {"fetchsize": str(fetch_size), **{k: str(v) for k, v in options.items() if k != "url"}}
    return spark.read.jdbc(options["url"], table, predicates=slices, properties=connection)


def bounds_query(url: str, table: str) -> str:
    date = _quoted(url, "date")
    return f"SELECT CAST(MIN({date}) AS DATE) AS first_date, CAST(MAX({date}) AS DATE) AS last_date FROM {table}"


def slice_predicates(
    url: str, first: dt.date | None, last: dt.date | None, slices: int, no_date: bool = True
) -> list[str]:
    """Conditions that each row with a date from ``first`` to ``last``, or with none, meets once.

    A slice is a number of whole days; the last day counts to its end, whatever
    time the column holds.
    """
    date = _quoted(url, "date")
    found = [f"{date} IS NULL"] if no_date or first is None else []
    if first is None:
        return found
    days = (last - first).days + 1
    count = max(1, min(slices, days))
    cuts = [first + dt.timedelta(days=days * i // count) for i in range(count + 1)]
    day = lambda d: f"CAST('{d.isoformat()}' AS DATE)"
    return [f"{date} >= {day(a)} AND {date} < {day(b)}" for a, b in zip(cuts, cuts[1:], strict=False)] + found


def append_rows(
    rows: DataFrame,
    options: Mapping[str, str],
    table: str,
    mode: str = "append",
    batch_size: int = 10_000,
    connections: int = 8,
    more_types: str = "",
) -> None:
    """Batched inserts, at most ``connections`` at a time.

    The rows are dealt to as many tasks by their content, so that the stages
    before keep their own number of tasks and a repeated one deals them alike.
    """
    (
        rows.repartition(connections, F.xxhash64(*rows.columns))
        .transform(_stamped if more_types else lambda dealt: dealt)
        .write.format("jdbc")
        .options(
            dbtable=table,
            batchsize=batch_size,
            isolationLevel="READ_COMMITTED",
            truncate=True,
            createTableColumnTypes=COLUMN_TYPES + more_types,
            **options,
        )
        .mode(mode)
        .save()
    )


def _stamped(rows: DataFrame) -> DataFrame:
    """Each row with the task and the attempt that write it."""

    def stamp(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        marks = (context.partitionId(), context.taskAttemptId())
        for batch in batches:
            columns = [pa.array([mark] * batch.num_rows, pa.int64()) for mark in marks]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *STAMPS])

    return rows.mapInArrow(stamp, T.StructType([*rows.schema, *[T.StructField(name, T.LongType()) for name in STAMPS]]))


def _quoted(url: str, name: str) -> str:
    mark = "`" if url.startswith("jdbc:mysql") else '"'
    return f"{mark}{name}{mark}"


def replace_statements(
    url: str, table: str, staging: str, mode: str, run_date: dt.date | None = None
) -> list[tuple[str, list[str]]]:
    """The DELETE of a load mode and the INSERT of the staged rows, with their parameters.

    A task whose executor is lost after its commit runs again, so its rows are
    staged twice, each time under another attempt; the INSERT takes one attempt
    of each task.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    date = _quoted(url, "date")
    parameters: list[str] = []
    if mode == "replace_run_date":
        if run_date is None:
            raise ValueError("replace_run_date needs a run_date")
        where = f"CAST({date} AS DATE) = CAST(? AS DATE)"
        parameters = [run_date.isoformat()]
    elif mode == "replace_batch_dates":
        where = _batch_dates(url, staging)
    else:
        where = f"EXISTS (SELECT 1 FROM {staging} s WHERE {_same_key(url, 's', table)})"
    columns = [_quoted(url, name) for name in FEATURE_COLUMNS]
    task, attempt = (_quoted(url, name) for name in STAMPS)
    first = f"(SELECT {task}, MIN({attempt}) AS {attempt} FROM {staging} GROUP BY {task})"
    return [
        (f"DELETE FROM {table} WHERE {where}", parameters),
        (
            f"INSERT INTO {table} ({', '.join(columns)}) SELECT {', '.join('s.' + c for c in columns)} FROM {staging} s"
            f" JOIN {first} a ON s.{task} = a.{task} AND s.{attempt} = a.{attempt}",
            [],
        ),
    ]


def lost_keys_query(url: str, table: str, staging: str) -> str:
    """How many stored rows ``replace_batch_dates`` would delete without a staged row of their key."""
    kept = f"EXISTS (SELECT 1 FROM {staging} s WHERE {_same_key(url, 's', table)})"
    return f"SELECT COUNT(*) FROM {table} WHERE ({_batch_dates(url, staging)}) AND NOT {kept}"


def _batch_dates(url: str, staging: str) -> str:
    date = _quoted(url, "date")
    return f"{date} IN (SELECT {date} FROM {staging}) OR {date} IS NULL AND EXISTS (SELECT 1 FROM {staging} s WHERE s.{date} IS NULL)"


def _same_key(url: str, left: str, right: str) -> str:
    """Null keys are equal, as in the Parquet warehouse."""
    pairs = [(f"{left}.{_quoted(url, key)}", f"{right}.{_quoted(url, key)}") for key in KEYS]
    return " AND ".join(f"({a} = {b} OR {a} IS NULL AND {b} IS NULL)" for a, b in pairs)


def load_table(
    batch: DataFrame,
    options: Mapping[str, str],
    table: str,
    mode: str,
    run_date: dt.date | None = None,
    allow_partial: bool = False,
) -> None:
    """Load ``batch`` into a database table with one of the three modes.

    As in the Parquet warehouse, ``replace_batch_dates`` refuses a batch that
    lacks symbols stored for its dates; then nothing is changed.
    """
    spark = batch.sparkSession
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"  # its own, whatever else is being loaded
    statements = replace_statements(options["url"], table, staging, mode, run_date)
    statements.append((f"DROP TABLE {staging}", []))
    guarded = mode == "replace_batch_dates" and not allow_partial
    append_rows(batch.select(FEATURE_COLUMNS), options, staging, "overwrite", more_types=STAMP_TYPES)
    _in_one_transaction(spark, options, statements, lost_keys_query(options["url"], table, staging) if guarded else None)


def _in_one_transaction(
    spark: SparkSession, options: Mapping[str, str], statements: list[tuple[str, list[str]]], guard: str | None = None
) -> None:
    """Run all statements or none; ``guard`` counts rows, and a count other than zero stops before the first."""
    if "driver" in options:
        spark._jvm.java.lang.Class.forName(options["driver"])
    connection = spark._jvm.java.sql.DriverManager.getConnection(
        options["url"], options.get("user"), options.get("password")
    )
    try:
        connection.setAutoCommit(False)
        if guard is not None:
            found = connection.prepareStatement(guard).executeQuery()
            found.next()
            if found.getLong(1):
                raise ValueError("the batch lacks symbols stored for its dates; use upsert_by_key or allow_partial")
        for text, parameters in statements:
            statement = connection.prepareStatement(text)
            for position, value in enumerate(parameters, start=1):
                statement.setString(position, value)
            statement.executeUpdate()
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
