"""Tables of dated rows in folders by period, in which a load becomes visible at one commit.

A load writes its periods into a folder of its own, ``<uri>/load=<id>/<period>=<first day>``, and
then a manifest that names the folder of every period. The manifest is one small file that is
renamed into place; the one with the largest number holds. A driver that dies before leaves the
table as it was, whatever it has written, and the load can be run again. The folders that the
manifest before the last one names stay, for readers that have just begun; older ones are deleted.
There must be one writer at a time: a second one fails when both write the same manifest.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import storage

PERIODS = ("day", "month", "year")
#: What a folder is called that holds the rows without date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
#: Few rows a page, so that rows of few symbols can be found by the pages' statistics.
PAGE_ROWS = 2_000

Period = dt.date | None


@dataclass(frozen=True)
class PeriodTable:
    """Rows of ``schema``, which has a column ``date``, under ``uri``; one folder per day, month or year.

    ``derived`` gives rows that are kept up to date beside the table: it is applied to the rows of the
    periods of a load, with the period's column among them, and must keep that column.
    """

    spark: SparkSession
    uri: str
    schema: T.StructType
    period: str = "month"
    derived: Callable[[DataFrame], DataFrame] | None = None

    def __post_init__(self):
        if self.period not in PERIODS:
            raise ValueError(f"period must be one of {PERIODS}, not {self.period!r}")

    def exists(self) -> bool:
        return self._last() > 0

    def periods(self) -> dict[Period, str]:
        """The load that holds each period."""
        return self._manifest(self._last())[0]

    def landing(self) -> int:
        """The largest landing number of any load; 0 without any."""
        return self._manifest(self._last())[1]

    def read(self, periods: Collection[Period] | None = None) -> DataFrame:
        """Rows of some periods, or of all, with the period's column; other folders are not even listed."""
        return self._read(self.uri, self.schema, periods)

    def read_derived(self, periods: Collection[Period] | None = None) -> DataFrame:
        """The derived rows of some periods, or of all."""
        empty = self.derived(self._read(self.uri, self.schema, ()))
        return self._read(f"{self.uri}/_derived", T.StructType([f for f in empty.schema if f.name != self.period]), periods)

    def replace(self, rows: DataFrame, touched: Collection[Period] | None = None, landing: int = 0) -> None:
        """Let ``rows`` be all rows of the ``touched`` periods, and of those that they lie in.

        Touched periods without rows are empty afterwards. ``landing`` is committed with them, so that
        a caller who numbers what it adds can tell what is in the table already.
        """
        number = self._last()
        loads, landed = self._manifest(number)
        load = uuid.uuid4().hex
        folder = f"{self.uri}/load={load}"
        self._write(rows.select(self.schema.names).withColumn(self.period, self.start(F.col("date"))), folder)
        written = {self._of_folder(name) for name in storage.folders_in(self.spark, folder)}
        if self.derived is not None and written:
            schema = T.StructType([*self.schema.fields, T.StructField(self.period, T.DateType())])
            fresh = self.derived(self.spark.read.schema(schema).parquet(folder))
            fresh.repartition(self.period).write.partitionBy(self.period).parquet(f"{self.uri}/_derived/load={load}")
        loads = {p: old for p, old in loads.items() if p not in (touched or ())} | dict.fromkeys(written, load)
        self._commit(number + 1, loads, max(landing, landed))
        self._forget(number + 1)

    def start(self, day: Column) -> Column:
        return day if self.period == "day" else F.trunc(day, self.period).cast("date")

    def first_day(self, day: dt.date) -> dt.date:
        if self.period == "day":
            return day
        return day.replace(day=1) if self.period == "month" else day.replace(month=1, day=1)

    def last_day(self, day: dt.date) -> dt.date:
        days = {"day": 1, "month": 31, "year": 366}[self.period]
        return self.first_day(self.first_day(day) + dt.timedelta(days=days)) - dt.timedelta(days=1)

    def of(self, rows: DataFrame) -> set[Period]:
        """The periods that rows lie in; there are no more of them than the calendar has days."""
        return {row[0] for row in rows.select(self.start(F.col("date"))).distinct().collect()}

    def _write(self, rows: DataFrame, folder: str) -> None:
        """The rebalance brings each period together so that files are few, and
        lets adaptive execution split a period too big for one task. Rows by
        symbol make pages of neighbouring symbols.
        """
        by = [c for c in ("symbol", "date") if c in rows.columns]
        (
            rows.hint("rebalance", F.col(self.period))
            .sortWithinPartitions(self.period, *by)
            .write.option("parquet.page.row.count.limit", PAGE_ROWS)
            .partitionBy(self.period)
            .parquet(folder)
        )

    def _read(self, uri: str, schema: T.StructType, periods: Collection[Period] | None) -> DataFrame:
        schema = T.StructType([*schema.fields, T.StructField(self.period, T.DateType())])
        loads = self.periods()
        wanted = loads if periods is None else {p: loads[p] for p in periods if p in loads}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        folders = [f"{uri}/load={load}/{self._folder(p)}" for p, load in sorted(wanted.items(), key=str)]
        columns = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
        return self.spark.read.schema(columns).option("basePath", uri).parquet(*folders).drop("load")

    def _folder(self, period: Period) -> str:
        return f"{self.period}={NO_DATE if period is None else period.isoformat()}"

    def _of_folder(self, name: str) -> Period:
        day = name.partition("=")[2]
        return None if day == NO_DATE else dt.date.fromisoformat(day)

    def _last(self) -> int:
        names = [uri.rsplit("/", 1)[1] for uri in storage.files_in(self.spark, f"{self.uri}/_manifest")]
        return max([int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit()], default=0)

    def _manifest(self, number: int) -> tuple[dict[Period, str], int]:
        if not number:
            return {}, 0
        found = json.loads(storage.read_text(self.spark, f"{self.uri}/_manifest/{number:012d}.json"))
        return {None if day is None else dt.date.fromisoformat(day): load for day, load in found["loads"]}, found["landing"]

    def _commit(self, number: int, loads: dict[Period, str], landing: int) -> None:
        entries = sorted(([p.isoformat() if p else None, load] for p, load in loads.items()), key=str)
        text = json.dumps({"landing": landing, "loads": entries})
        storage.write_once(self.spark, f"{self.uri}/_manifest/{number:012d}.json", text)

    def _forget(self, number: int) -> None:
        """Delete what the last two manifests don't name, and manifests before them."""
        if number < 3:
            return
        kept = {*self._manifest(number)[0].items(), *self._manifest(number - 1)[0].items()}
        for period, load in set(self._manifest(number - 2)[0].items()) - kept:
            for uri in (self.uri, f"{self.uri}/_derived"):
                storage.delete(self.spark, f"{uri}/load={load}/{self._folder(period)}")
        storage.delete(self.spark, f"{self.uri}/_manifest/{number - 2:012d}.json")
