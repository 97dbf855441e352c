"""Counts, summaries and previews."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.columns import rounded


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("total_rows"))


def symbol_counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("row_count"))


def symbol_summary(table: DataFrame) -> DataFrame:
    """Highest, lowest and mean close of each symbol, by symbol."""
    return (
        table.groupBy("symbol")
        .agg(
            rounded(F.max("close")).alias("max_close"),
            rounded(F.min("close")).alias("min_close"),
            rounded(F.avg("close")).alias("avg_close"),
        )
        .orderBy("symbol")
    )


def symbol_parts(rows: DataFrame, *by: str) -> DataFrame:
    """Partial aggregates per symbol (and ``by``) that can be merged: see ``merged_parts``.

    n rows, n_close of them with a close, its sum, smallest and largest, and the first and last date.
    """
    return rows.groupBy(*by, "symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("close").alias("n_close"),
        F.sum("close").alias("sum_close"),
        F.min("close").alias("min_close"),
        F.max("close").alias("max_close"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """One row per symbol from several partial aggregates of it."""
    return parts.groupBy("symbol").agg(
        *[F.sum(name).alias(name) for name in ("n", "n_close", "sum_close")],
        *[F.min(name).alias(name) for name in ("min_close", "first")],
        *[F.max(name).alias(name) for name in ("max_close", "last")],
    )


def summary_of_parts(parts: DataFrame) -> DataFrame:
    """``symbol_summary`` from partial aggregates."""
    mean = F.try_divide("sum_close", "n_close")
    return (
        merged_parts(parts)
        .select("symbol", *[rounded(F.col(name)).alias(name) for name in ("max_close", "min_close")], rounded(mean).alias("avg_close"))
        .orderBy("symbol")
    )


def run_summary_of_parts(parts: DataFrame, universe: Iterable[str], run_date: dt.date) -> DataFrame:
    """``run_summary`` from partial aggregates."""
    return _run_summary(merged_parts(parts), universe, run_date)


def counts_of_parts(parts: DataFrame) -> DataFrame:
    """``symbol_counts`` from partial aggregates."""
    return parts.groupBy("symbol").agg(F.sum("n").alias("row_count"))


def distinct_symbols(bars: DataFrame) -> DataFrame:
    return bars.select("symbol").distinct()


def run_summary(bars: DataFrame, universe: Iterable[str], run_date: dt.date) -> DataFrame:
    """One row about a run: rows, symbols, dates, and which of the universe took part.

    Symbols are counted in full; only those of ``universe`` are listed, so the
    row stays small whatever the number of symbols.
    """
    per_symbol = bars.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    return _run_summary(per_symbol, universe, run_date)


def _run_summary(per_symbol: DataFrame, universe: Iterable[str], run_date: dt.date) -> DataFrame:
    expected = F.when(F.col("symbol").isin(list(universe)), F.col("symbol"))
    return per_symbol.agg(
        F.lit(run_date).alias("run_date"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("symbol").alias("symbol_count"),
        F.array_join(F.array_sort(F.collect_set(expected)), ",").alias("symbols"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
    )


def preview(bars: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows by symbol, date and then all other columns: a top-k, without sorting the whole input."""
    rest = [c for c in bars.columns if c not in ("symbol", "date")]
    return bars.orderBy("symbol", "date", *rest).limit(rows)
