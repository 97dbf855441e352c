"""Cleaning rules and data-quality reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.columns import is_missing
from candlewick.schema import KEYS

REQUIRED = ["close", "volume", "date"]


def clean(bars: DataFrame) -> DataFrame:
    """Rows with a date, a positive close and a positive volume.

    The null-drop comes first because a NaN close would pass ``> 0``.
    """
    return bars.dropna(how="any", subset=REQUIRED).filter(
        (F.col("close") > 0) & (F.col("volume") > 0)
    )


def validate(bars: DataFrame, run_date: dt.date) -> DataFrame:
    """``clean`` plus no dates after ``run_date``."""
    return clean(bars).filter(F.col("date") <= F.lit(run_date))


def failed_rules(bars: DataFrame, run_date: dt.date) -> dict[str, Column]:
    """One condition per rule, never null; a missing value fails only its own rule."""
    types = dict(bars.dtypes)
    missing = {name: is_missing(name, types[name]) for name in REQUIRED}

    def broken(name: str, test: Column) -> Column:
        return ~missing[name] & F.coalesce(test, F.lit(False))

    return {
        "null_date": missing["date"],
        "null_close": missing["close"],
        "null_volume": missing["volume"],
        "bad_close": broken("close", F.col("close") <= 0),
        "bad_volume": broken("volume", F.col("volume") <= 0),
        "future_date": broken("date", F.col("date") > F.lit(run_date)),
    }


def removal_metrics(bars: DataFrame, run_date: dt.date) -> list[Column]:
    """Aggregates for ``agg`` or ``observe``: all rows, rows failing each rule, rows removed and kept."""
    rules = failed_rules(bars, run_date)
    fails = F.lit(False)
    for condition in rules.values():
        fails = fails | condition
    return [
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(condition).alias(name) for name, condition in rules.items()],
        F.count_if(fails).alias("removed_rows"),
        F.count_if(~fails).alias("kept_rows"),
    ]


def removal_counts(bars: DataFrame, run_date: dt.date) -> DataFrame:
    """One row of ``removal_metrics``, from one pass."""
    return bars.agg(*removal_metrics(bars, run_date))


def missing_symbols(bars: DataFrame, universe: Iterable[str]) -> DataFrame:
    """Symbols of the expected universe that have no row."""
    names = list(universe)
    listed = F.array(*[F.lit(name) for name in names]).cast("array<string>")
    expected = bars.sparkSession.range(0, 1, 1, 1).select(F.explode(listed).alias("symbol"))
    present = bars.filter(F.col("symbol").isin(names)).select("symbol").distinct()
    return expected.join(present, "symbol", "left_anti")


def duplicate_keys(bars: DataFrame) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return bars.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def dedupe(bars: DataFrame, latest_by: str = "run_date") -> DataFrame:
    """The latest row of each key.

    Equal ``latest_by`` values fall back to the other columns, so the choice
    does not depend on the partitioning. ``row_number = 1`` is applied on both
    sides of the shuffle, which keeps one row per key and map task.
    """
    rest = [c for c in bars.columns if c not in {*KEYS, latest_by}]
    newest = Window.partitionBy(*KEYS).orderBy(F.desc(latest_by), *[F.desc(c) for c in rest])
    return bars.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def require_rows(bars: DataFrame, what: str = "any symbol") -> DataFrame:
    """``bars`` itself, or ValueError when nothing was read."""
    if bars.isEmpty():
        raise ValueError(f"no data for {what}")
    return bars
