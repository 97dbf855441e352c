"""One day's run: extract, transform, load, report.

The run date is an argument of every step, so a run that crosses midnight
still finds its own files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from candlewick.operators.features import (
    add_features,
    batch_span,
    features,
    features_in_context,
    history_context,
    lookback,
    rows_after,
    rows_before,
)
from candlewick.operators.quality import (
    clean,
    missing_symbols,
    removal_metrics,
    require_rows,
    validate,
)
from candlewick.operators.report import run_summary, summary_of_parts
from candlewick.schema import AVERAGE_ROWS, BAR_COLUMNS, LOOKBACK_SESSIONS, UNIVERSE
from candlewick.sinks.files import write_processed, write_raw
from candlewick.sinks.warehouse import Warehouse
from candlewick.sources.bars import read_vendor, rejected_files
from candlewick.sources.files import read_processed, read_raw

# Stored rows this far back usually fill the frame of every symbol.
RECENT = dt.timedelta(days=60)
# So many symbols at most are named in the filter of a read of the table.
FEW_SYMBOLS = 200


@dataclass
class DayReport:
    """Counts measured while writing, and lazy reports on the results."""

    extracted: dict[str, int]
    transformed: dict[str, int]
    missing: DataFrame
    rejected: DataFrame
    run: DataFrame
    summary: DataFrame


def run_day(
    warehouse: Warehouse,
    vendor_uri: str,
    lake_uri: str,
    run_date: dt.date,
    symbols: Sequence[str] = UNIVERSE,
    sessions: int = LOOKBACK_SESSIONS,
    mode: str = "upsert_by_key",
    use_history: bool = False,
    exchange_tz: str | None = None,
    **options,
) -> DayReport:
    """Run all steps for ``run_date``.

    ``use_history`` computes the features together with the stored rows, so the
    average can fill its frame; otherwise the batch stands alone. An upsert then
    also brings the stored rows that follow late or corrected ones up to date.
    """
    spark = warehouse.spark
    raw_uri, processed_uri = f"{lake_uri}/raw-data", f"{lake_uri}/processed-data"

    # A file that can't be read adds nothing and is listed in the report.
    landed = require_rows(read_vendor(spark, vendor_uri, symbols, exchange_tz=exchange_tz))
    # Rows that belong to no session up to run_date pass on, to be removed and counted.
    in_time = F.coalesce(F.col("date") <= F.lit(run_date), F.lit(False))
    fetched = lookback(landed.filter(in_time), sessions).unionByName(landed.filter(~in_time))
    extracted = extract(fetched, raw_uri, run_date)

    raw = read_raw(spark, raw_uri, run_date)
    transformed = Observation()
    if use_history:
        context_uri = f"{lake_uri}/history/run_date={run_date:%Y-%m-%d}"
        refresh = mode == "upsert_by_key"
        rows = with_stored_history(clean(raw), warehouse, context_uri, refresh=refresh, **options)
    else:
        rows = features(raw, **options)
    rows = rows.observe(transformed, F.count(F.lit(1)).alias("rows"))
    write_processed(rows, processed_uri, run_date)

    batch = read_processed(spark, processed_uri, run_date)
    warehouse.load(batch, mode, run_date)
    return DayReport(
        extracted=extracted,
        transformed=dict(transformed.get),
        missing=missing_symbols(batch, symbols),
        rejected=rejected_files(spark, vendor_uri, symbols),
        run=run_summary(batch, symbols, run_date),
        summary=summary_of_parts(warehouse.parts()),
    )


def with_stored_history(
    batch: DataFrame,
    warehouse: Warehouse,
    context_uri: str,
    recent: dt.timedelta = RECENT,
    rows: int = AVERAGE_ROWS,
    refresh: bool = False,
    **options,
) -> DataFrame:
    """Features of ``batch`` together with the stored rows before and between its rows.

    ``refresh`` adds the stored rows whose features the batch changes, for an upsert.
    The table is read from ``recent`` before the batch to its last date (for
    ``refresh``, ``recent`` after that), and further away only for symbols with
    too few rows there. The few rows found are written to ``context_uri``, so
    that no later step reads the table.
    """
    if not warehouse.exists():
        return add_features(batch, rows=rows, **options)
    span, symbols = _counted(batch_span(batch), f"{context_uri}/span")
    first, last = span.agg(F.min("_first"), F.max("_last")).first()
    if first is None:
        return add_features(batch, rows=rows, **options)
    reach = max(rows - 1, 1)
    since, until = first - recent, last + recent if refresh else last
    stored = Stored(warehouse, span, symbols)
    near = history_context(batch, stored.read(since, until), rows, refresh)
    context = written(near, f"{context_uri}/near")
    further = [_further_rows(stored, context, since, recent, reach, False, f"{context_uri}/before")]
    if refresh:
        further.append(_further_rows(stored, context, until, recent, reach, True, f"{context_uri}/after"))
    for found in further:
        context = context.unionByName(found) if found is not None else context
    return features_in_context(batch, context, rows, refresh, **options)


@dataclass(frozen=True)
class Stored:
    """The table's rows of the symbols in ``span``: named in the filter if they are few, so that only their pages are read."""

    warehouse: Warehouse
    span: DataFrame
    symbols: int

    def read(self, first: dt.date, last: dt.date) -> DataFrame:
        rows = self.warehouse.read(first, last)
        if self.symbols > FEW_SYMBOLS:
            return rows
        names = [row[0] for row in self.span.select("_of").collect()]
        wanted = F.col("symbol").isin([name for name in names if name is not None])
        return rows.filter(wanted | F.col("symbol").isNull() if None in names else wanted)


def _further_rows(
    stored: Stored,
    context: DataFrame,
    edge: dt.date,
    width: dt.timedelta,
    reach: int,
    after: bool,
    folder: str,
) -> DataFrame | None:
    """Rows beyond ``edge`` for symbols with fewer than ``reach`` rows on that side of the batch.

    The symbols are written first: if there are none, nothing is read. Otherwise
    the table is read in stretches, each four times as long as the one before, until
    every symbol has enough rows or the table ends.
    """
    ends, span = stored.warehouse.ends(), stored.span
    take = rows_after if after else rows_before
    of_symbol = F.col("symbol").eqNullSafe(F.col("_of"))
    day = dt.timedelta(days=1)
    found, step, width = None, 0, max(width, day)
    while ends is not None and (edge < ends[1] if after else edge > ends[0]):
        known = context if found is None else context.unionByName(found)
        enough = take(known.join(span, of_symbol), reach).groupBy(F.col("symbol").alias("_found"))
        enough = enough.agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= reach)
        short = span.join(enough, F.col("_of").eqNullSafe(F.col("_found")), "left_anti")
        short, count = _counted(short, f"{folder}/short{step}")
        if not count:
            break
        if after:
            stretch, edge = (edge + day, min(edge + width, ends[1])), min(edge + width, ends[1])
        else:
            stretch, edge = (max(edge - width, ends[0]), edge - day), max(edge - width, ends[0])
        rows = Stored(stored.warehouse, short, count).read(*stretch).select(BAR_COLUMNS).join(short, of_symbol)
        rows = written(take(rows, reach), f"{folder}/rows{step}")
        found = rows if found is None else found.unionByName(rows)
        width, step = min(4 * width, dt.timedelta(days=36_525)), step + 1
    return found


def written(rows: DataFrame, uri: str) -> DataFrame:
    """The same rows, written down and read again."""
    rows.write.mode("overwrite").parquet(uri)
    return rows.sparkSession.read.schema(rows.schema).parquet(uri)


def _counted(rows: DataFrame, uri: str) -> tuple[DataFrame, int]:
    """``written`` and the number of rows, from the same job."""
    seen = Observation()
    return written(rows.observe(seen, F.count(F.lit(1)).alias("rows")), uri), seen.get["rows"]


def extract(fetched: DataFrame, raw_uri: str, run_date: dt.date) -> dict[str, int]:
    """Land the valid bars; the counts come from the same job."""
    seen = Observation()
    counted = fetched.observe(seen, *removal_metrics(fetched, run_date))
    write_raw(validate(counted, run_date), raw_uri, run_date)
    return dict(seen.get)
