"""The warehouse table as Parquet partitioned by period, and its three load modes."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.columns import iso_date, number_or_null
from candlewick.operators.replace import lost_keys, replace_batch_dates, replace_run_date, upsert_by_key
from candlewick.operators.report import symbol_parts
from candlewick.schema import FEATURE_COLUMNS, FEATURE_SCHEMA
from candlewick.sinks.periods import PERIODS, PeriodTable

MODES = ("replace_run_date", "replace_batch_dates", "upsert_by_key")


def warehouse_rows(rows: DataFrame) -> DataFrame:
    """The ten columns in warehouse types: ISO date text, doubles, a whole volume, null for NaN."""
    return rows.select(
        iso_date(F.col("date")).alias("date"),
        F.col("symbol").cast("string").alias("symbol"),
        *[F.col(name).cast("double").alias(name) for name in ("open", "high", "low", "close")],
        F.col("volume").cast("long").alias("volume"),
        number_or_null(F.col("price_change_pct")).alias("price_change_pct"),
        F.col("moving_avg_7d").cast("double").alias("moving_avg_7d"),
        F.col("volume_category").cast("string").alias("volume_category"),
    )


@dataclass(frozen=True)
class Warehouse:
    """A table of features under ``uri``, one folder per day, month or year.

    The period changes no result. Choose it so that a period fills files of some
    hundred megabytes: days for very many symbols, years for few. A load becomes
    visible at one commit (see ``PeriodTable``); counts, sums and extremes per
    symbol and period are kept up to date with it.
    """

    spark: SparkSession
    uri: str
    period: str = "month"

    def __post_init__(self):
        if self.period not in PERIODS:
            raise ValueError(f"period must be one of {PERIODS}, not {self.period!r}")

    @property
    def table(self) -> PeriodTable:
        return PeriodTable(self.spark, self.uri, FEATURE_SCHEMA, self.period, lambda rows: symbol_parts(rows, self.period))

    def exists(self) -> bool:
        return self.table.exists()

    def read(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """Rows from ``first`` to ``last``, inclusive; folders outside are not read."""
        if first is None and last is None:
            return self.table.read().select(FEATURE_COLUMNS)
        since, until = first or dt.date.min, last or dt.date.max
        periods = [p for p in self.table.periods() if p is not None and p <= until and self.table.last_day(p) >= since]
        rows = self.table.read(periods)
        if first is not None:
            in_folder = F.col(self.period) >= F.lit(self.table.first_day(first))
            rows = rows.filter(in_folder & (F.col("date") >= F.lit(first)))
        if last is not None:
            in_folder = F.col(self.period) <= F.lit(self.table.first_day(last))
            rows = rows.filter(in_folder & (F.col("date") <= F.lit(last)))
        return rows.select(FEATURE_COLUMNS)

    def parts(self) -> DataFrame:
        """Rows, closes, their sum and extremes, and dates per symbol and period; the table is not read.

        ``summary_of_parts``, ``counts_of_parts`` and ``run_summary_of_parts`` of them are the table's reports.
        """
        return self.table.read_derived().drop(self.period)

    def ends(self) -> tuple[dt.date, dt.date] | None:
        """The first and last day of the periods with dates; reads no row."""
        days = [p for p in self.table.periods() if p is not None]
        return (min(days), self.table.last_day(max(days))) if days else None

    def load(
        self,
        batch: DataFrame,
        mode: str,
        run_date: dt.date | None = None,
        allow_partial: bool = False,
    ) -> None:
        """Write ``batch`` into the table.

        The batch is read more than once, so pass rows read back from the
        processed zone rather than an expensive plan. Only the periods the
        load touches are read and rewritten.
        """
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
        if mode == "replace_run_date" and run_date is None:
            raise ValueError("replace_run_date needs a run_date")
        batch = batch.select(FEATURE_COLUMNS)
        if not self.exists():
            self.table.replace(batch)
            return
        periods = self._periods(batch, run_date if mode == "replace_run_date" else None)
        touched = self.table.read(periods).select(FEATURE_COLUMNS)
        if mode == "replace_run_date":
            now = replace_run_date(touched, batch, run_date)
        elif mode == "replace_batch_dates":
            if not allow_partial and not lost_keys(touched, batch).isEmpty():
                raise ValueError(
                    "the batch lacks symbols stored for its dates; use upsert_by_key or allow_partial"
                )
            now = replace_batch_dates(touched, batch)
        else:
            now = upsert_by_key(touched, batch)
        self.table.replace(now, periods)

    def _periods(self, batch: DataFrame, run_date: dt.date | None) -> set[dt.date | None]:
        """Periods that hold a date of the batch, or the run date; rows without date are one."""
        return self.table.of(batch) | ({self.table.first_day(run_date)} if run_date else set())

    def _touched(self, batch: DataFrame, run_date: dt.date | None) -> DataFrame:
        """Stored rows of the periods that a load would rewrite."""
        return self.table.read(self._periods(batch, run_date)).select(FEATURE_COLUMNS)
