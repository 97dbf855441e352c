"""Every operator as a query over the benchmark tables, with its SQL counterpart.

There is no price table, so bars are built from ``orders`` (one symbol per
order priority) and ``events`` (one per event type). Dates leave as ISO text,
which compares equal whatever type a client gives to dates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.columns import iso_date
from candlewick.operators import features as feat
from candlewick.operators import quality, replace, report
from candlewick.plans.daily import run_day, with_stored_history
from candlewick.schema import BAR_COLUMNS, FEATURE_COLUMNS
from candlewick.sinks.files import write_processed, write_raw
from candlewick.sinks.periods import PeriodTable
from candlewick.sinks.warehouse import Warehouse, warehouse_rows
from candlewick.sources.bars import (
    bar_state,
    daily_bars,
    land_ticks,
    normalize_vendor,
    read_vendor,
    rejected_files,
    union_frames,
)
from candlewick.sources.files import read_processed, read_raw, rejected_rows
from candlewick.storage import scratch_folder
from candlewick.streaming.incremental import load_new_files

Query = Callable[[SparkSession, str], DataFrame]

AUDIT_DATE = dt.date(2000, 1, 1)
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "9-NONE"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# Low enough for the splitting of hot symbols to take part on small tables; a block is a task.
SPLIT_ABOVE = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(name: str):
    """Whole cents, so that sums are exact in any order."""
    return F.round(F.col(name) * 100).cast("long")


def orders_bars(spark: SparkSession, sf_dir: str, first_order: str | None = None) -> DataFrame:
    bars = daily_bars(
        table(spark, sf_dir, "orders"),
        symbol="o_orderpriority",
        at="o_orderdate",
        price="o_totalprice",
        volume=cents("o_totalprice"),
        order="o_orderkey",
        first_order=first_order,
    )
    return bars.select(*BAR_COLUMNS, *([first_order] if first_order else []))


def events_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(
        table(spark, sf_dir, "events"),
        symbol="event_type",
        at="ts",
        price="value",
        volume=cents("value"),
        order="event_id",
    ).select(BAR_COLUMNS)


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with missing, zero and negative values, placed by each bar's first order key."""
    k, close, volume = F.col("k"), F.col("close"), F.col("volume")
    return orders_bars(spark, sf_dir, first_order="k").select(
        F.when(k % 29 != 4, F.col("date")).alias("date"),
        "symbol",
        "open",
        "high",
        "low",
        F.when(k % 23 == 1, None)
        .when(k % 23 == 2, F.lit(0.0))
        .when(k % 23 == 3, -close)
        .otherwise(close)
        .alias("close"),
        F.when(k % 31 == 5, None).when(k % 31 == 6, F.lit(0)).otherwise(volume).alias("volume"),
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a row of its own, repeated for each of its line items.

    Few symbols, many rows per date and many identical copies: the input that a
    window per symbol would put into one task each.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_totalprice").alias("close"),
        cents("o_totalprice").alias("volume"),
        F.col("o_orderkey").alias("order_key"),
    )
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    return items.join(orders, "order_key").select("date", "symbol", "close", "volume", "order_key")


def vendor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of a vendor's price history, with columns to be ignored."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("Date"),
        value.alias("Open"),
        value.alias("High"),
        value.alias("Low"),
        value.alias("Close"),
        cents("value").alias("Volume"),
        F.lit(0.0).alias("Dividends"),
        F.col("event_type").alias("symbol"),
    )


def run_date_of(spark: SparkSession, sf_dir: str) -> dt.date:
    """The last order date."""
    return table(spark, sf_dir, "orders").agg(F.max(F.to_date("o_orderdate"))).first()[0] or AUDIT_DATE


def split_at_run_date(bars: DataFrame, run_date: dt.date) -> tuple[DataFrame, DataFrame]:
    """The stored bars up to the run date, and the last five sessions of each symbol among them."""
    stored = bars.filter(F.col("date") <= F.lit(run_date))
    return stored, feat.lookback(stored, unique=True)


def last_dates(stored: DataFrame, count: int = 5) -> DataFrame:
    """All bars of the last ``count`` distinct dates."""
    days = stored.select(F.col("date").alias("_day")).distinct().orderBy(F.desc("_day")).limit(count)
    return stored.join(days, F.col("date") == F.col("_day"), "left_semi")


def text_dates(rows: DataFrame) -> DataFrame:
    names = [name for name, dtype in rows.dtypes if dtype == "date"]
    return rows.withColumns({name: iso_date(F.col(name)) for name in names}) if names else rows


# --- queries -----------------------------------------------------------------


def q_daily_bars(spark, sf_dir):
    return orders_bars(spark, sf_dir)


def q_daily_bars_merged(spark, sf_dir):
    """Ticks of three landings, the last one sent twice, merged into stored bars by year."""
    orders = table(spark, sf_dir, "orders")

    def state(ticks):
        return bar_state(ticks, "o_orderpriority", "o_orderdate", "o_totalprice", cents("o_totalprice"), "o_orderkey")

    stored = PeriodTable(spark, scratch_folder(spark), state(orders).schema, "year")
    for landing in (1, 2, 3, 3):
        land_ticks(stored, state(orders.filter(F.col("o_orderkey") % 3 == landing - 1)), landing)
    return stored.read().select(BAR_COLUMNS)


def q_clean_bars(spark, sf_dir):
    return quality.clean(dirty_bars(spark, sf_dir))


def q_validate_bars(spark, sf_dir):
    return quality.validate(dirty_bars(spark, sf_dir), AUDIT_DATE)


def q_price_change(spark, sf_dir):
    return feat.add_price_change(q_clean_bars(spark, sf_dir), unique=True)


def q_moving_average(spark, sf_dir):
    return feat.add_moving_average(q_clean_bars(spark, sf_dir), unique=True)


def q_volume_category(spark, sf_dir):
    return feat.add_volume_category(q_clean_bars(spark, sf_dir))


def q_transform_full(spark, sf_dir):
    return feat.features(dirty_bars(spark, sf_dir), unique=True)


def q_transform_copies(spark, sf_dir):
    rows = order_rows(spark, sf_dir)
    return feat.features(rows, tie=["order_key"], hot_rows=SPLIT_ABOVE)


def q_price_change_copies(spark, sf_dir):
    rows = order_rows(spark, sf_dir)
    return feat.add_price_change(rows, tie=["order_key"], hot_rows=SPLIT_ABOVE)


def q_moving_average_copies(spark, sf_dir):
    rows = order_rows(spark, sf_dir)
    return feat.add_moving_average(rows, tie=["order_key"], hot_rows=SPLIT_ABOVE)


def q_symbol_summary(spark, sf_dir):
    return report.symbol_summary(q_transform_full(spark, sf_dir))


def q_row_counts(spark, sf_dir):
    return quality.removal_counts(dirty_bars(spark, sf_dir), AUDIT_DATE)


def q_table_count(spark, sf_dir):
    return report.row_count(q_transform_full(spark, sf_dir))


def q_symbol_counts(spark, sf_dir):
    return report.symbol_counts(q_clean_bars(spark, sf_dir))


def q_distinct_symbols(spark, sf_dir):
    return report.distinct_symbols(orders_bars(spark, sf_dir))


def q_missing_symbols(spark, sf_dir):
    return quality.missing_symbols(orders_bars(spark, sf_dir), PRIORITIES)


def q_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(q_replace_run_date(spark, sf_dir))


def q_dedupe_latest(spark, sf_dir):
    """Each order as a delivery of its day's bar; the largest order key is the latest."""
    return quality.dedupe(order_rows(spark, sf_dir), latest_by="order_key")


def q_run_summary(spark, sf_dir):
    return report.run_summary(orders_bars(spark, sf_dir), PRIORITIES, run_date_of(spark, sf_dir))


def q_lookback_sessions(spark, sf_dir):
    return feat.lookback(orders_bars(spark, sf_dir), unique=True)


def q_lookback_copies(spark, sf_dir):
    return feat.lookback(order_rows(spark, sf_dir))


def q_vendor_normalize(spark, sf_dir):
    return normalize_vendor(vendor_events(spark, sf_dir))


def q_union_symbols(spark, sf_dir):
    return union_frames([orders_bars(spark, sf_dir), events_bars(spark, sf_dir)])


def _land_vendor_events(spark, sf_dir):
    """Vendor files, one folder per symbol: two column orders, and symbols whose files lack a column or a header."""
    folder = scratch_folder(spark)
    events = vendor_events(spark, sf_dir)
    views, clicks = events.filter("symbol = 'view'"), events.filter("symbol = 'click'")
    landings = [
        events.filter("symbol <> 'view'"),
        views.select(*reversed(views.columns)),
        clicks.withColumnRenamed("Close", "Last").withColumn("symbol", F.lit("no-close")),
        clicks.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(events.columns[:-1])}).withColumn("symbol", F.lit("no-header")),
    ]
    for landed in landings:
        landed.write.mode("append").partitionBy("symbol").option("header", True).csv(folder)
    return folder


def q_vendor_files(spark, sf_dir):
    """Vendor files read back in one scan; one asked symbol has none, and two have only broken ones."""
    folder = _land_vendor_events(spark, sf_dir)
    return read_vendor(spark, folder, [*EVENT_TYPES, "no-close", "no-header", "no-such-symbol"])


def q_rejected_files(spark, sf_dir):
    """Symbols with files that can't be read, why, and how many rows are in them."""
    rejected = rejected_files(spark, _land_vendor_events(spark, sf_dir))
    return rejected.groupBy("symbol", "reason").agg(F.sum(F.col("lines") - 1).alias("rows"))


def q_exchange_dates(spark, sf_dir):
    """Vendor instants with an offset, as calendar dates of an exchange five hours behind."""
    zoned = F.concat(F.date_format("Date", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))
    return normalize_vendor(vendor_events(spark, sf_dir).withColumn("Date", zoned), exchange_tz="-05:00")


def q_rejected_rows(spark, sf_dir):
    """Raw lines with text in place of a number or a date, found by the reader."""
    folder = scratch_folder(spark)
    k = F.col("k")
    bars = orders_bars(spark, sf_dir, first_order="k").select(
        F.when(k % 17 == 1, "someday").otherwise(iso_date(F.col("date"))).alias("date"),
        "symbol",
        "open",
        F.when(k % 19 == 2, "high").otherwise(F.col("high").cast("string")).alias("high"),
        *["low", "close", "volume"],
    )
    bars.write.option("header", True).csv(f"{folder}/run_date={AUDIT_DATE}")
    return rejected_rows(spark, folder).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rejected"), F.count_if(F.col("_corrupt_record").contains("someday")).alias("bad_dates")
    )


def q_warehouse_rows(spark, sf_dir):
    """Every missing change comes in as NaN."""
    change = F.coalesce("price_change_pct", F.lit(float("nan")))
    return warehouse_rows(q_transform_full(spark, sf_dir).withColumn("price_change_pct", change))


def q_preview_rows(spark, sf_dir):
    return report.preview(orders_bars(spark, sf_dir))


def q_preview_ten(spark, sf_dir):
    return report.preview(events_bars(spark, sf_dir), rows=10)


def q_sorted_bars(spark, sf_dir):
    return orders_bars(spark, sf_dir).orderBy("symbol", "date")


def q_replace_run_date(spark, sf_dir):
    run_date = run_date_of(spark, sf_dir)
    stored, batch = split_at_run_date(orders_bars(spark, sf_dir), run_date)
    return replace.replace_run_date(stored, batch, run_date)


def q_replace_batch_dates(spark, sf_dir):
    """The batch corrects the closes of its dates, so that what was replaced shows."""
    stored, _ = split_at_run_date(orders_bars(spark, sf_dir), run_date_of(spark, sf_dir))
    return replace.replace_batch_dates(stored, last_dates(stored).withColumn("close", F.col("close") + 1))


def q_upsert_by_key(spark, sf_dir):
    """The batch corrects the closes it delivers, so the winner of each key shows."""
    stored, batch = split_at_run_date(orders_bars(spark, sf_dir), run_date_of(spark, sf_dir))
    return replace.upsert_by_key(stored, batch.withColumn("close", F.col("close") + 1))


def q_lost_keys(spark, sf_dir):
    stored, batch = split_at_run_date(orders_bars(spark, sf_dir), run_date_of(spark, sf_dir))
    return replace.lost_keys(stored, batch)


def q_history_features(spark, sf_dir):
    bars = q_clean_bars(spark, sf_dir)
    return feat.history_features(feat.lookback(bars, unique=True), bars, unique=True)


def q_history_recent(spark, sf_dir):
    """As ``history_features``, against a written table whose old rows are read only if needed."""
    folder = scratch_folder(spark)
    warehouse = Warehouse(spark, f"{folder}/table", period="year")
    warehouse.load(q_transform_full(spark, sf_dir), "upsert_by_key")
    batch = feat.lookback(q_clean_bars(spark, sf_dir), unique=True)
    days = dt.timedelta(days=3)
    return with_stored_history(batch, warehouse, f"{folder}/context", recent=days, unique=True)


def q_csv_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark)
    run_date = run_date_of(spark, sf_dir)
    write_raw(q_clean_bars(spark, sf_dir), folder, run_date)
    return read_raw(spark, folder, run_date)


def q_csv_inferred(spark, sf_dir):
    folder = scratch_folder(spark)
    write_raw(q_clean_bars(spark, sf_dir), folder, run_date_of(spark, sf_dir))
    return read_raw(spark, folder, infer=True)


def q_parquet_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark)
    rows, run_date = q_transform_full(spark, sf_dir), run_date_of(spark, sf_dir)
    for _ in range(2):  # a second run replaces the first
        write_processed(rows, folder, run_date)
    return read_processed(spark, folder, run_date)


def _loaded(spark, sf_dir, mode):
    return _loaded_table(spark, sf_dir, mode).read()


def _loaded_table(spark, sf_dir, mode):
    """Two loads of the same batch into a written table of features."""
    folder = scratch_folder(spark)
    warehouse = Warehouse(spark, f"{folder}/table", period="year")
    run_date = run_date_of(spark, sf_dir)
    stored, _ = split_at_run_date(q_transform_full(spark, sf_dir), run_date)
    warehouse.load(stored, mode, run_date)
    batch = last_dates(warehouse.read()).withColumn("close", F.col("close") + 1)
    batch.write.parquet(f"{folder}/batch")
    for _ in range(2):
        warehouse.load(read_processed(spark, f"{folder}/batch"), mode, run_date)
    return warehouse


def q_load_replace_run_date(spark, sf_dir):
    return _loaded(spark, sf_dir, "replace_run_date")


def q_load_replace_batch_dates(spark, sf_dir):
    return _loaded(spark, sf_dir, "replace_batch_dates")


def q_load_upsert(spark, sf_dir):
    return _loaded(spark, sf_dir, "upsert_by_key")


def _land_vendor_bars(spark, sf_dir, folder):
    bars = dirty_bars(spark, sf_dir)
    names = {c: c.capitalize() for c in BAR_COLUMNS if c != "symbol"}
    vendor = bars.withColumnsRenamed(names).select("Date", "Open", "High", "Low", "Close", "Volume", "symbol")
    vendor.write.partitionBy("symbol").option("header", True).csv(folder)


def _summary_after(spark, sf_dir, mode):
    """The symbol summary after two loads, from the partial aggregates alone."""
    return report.summary_of_parts(_loaded_table(spark, sf_dir, mode).parts())


def q_summary_replace_run_date(spark, sf_dir):
    return _summary_after(spark, sf_dir, "replace_run_date")


def q_summary_replace_batch_dates(spark, sf_dir):
    return _summary_after(spark, sf_dir, "replace_batch_dates")


def q_summary_upsert(spark, sf_dir):
    return _summary_after(spark, sf_dir, "upsert_by_key")


def q_run_summary_parts(spark, sf_dir):
    """The run summary and counts of a stored table, from the partial aggregates alone."""
    parts = _loaded_table(spark, sf_dir, "upsert_by_key").parts()
    return report.run_summary_of_parts(parts, PRIORITIES, run_date_of(spark, sf_dir))


def q_daily_run(spark, sf_dir):
    """Two runs on neighbouring dates, the later one twice: the table after them."""
    folder = scratch_folder(spark)
    _land_vendor_bars(spark, sf_dir, f"{folder}/vendor")
    warehouse = Warehouse(spark, f"{folder}/table", period="year")
    last = run_date_of(spark, sf_dir)
    for run_date in (last - dt.timedelta(days=1), last, last):
        run_day(warehouse, f"{folder}/vendor", f"{folder}/lake", run_date, symbols=PRIORITIES)
    return warehouse.read()


def q_daily_run_history(spark, sf_dir):
    """Runs a week apart, each with the stored rows in its series: features over all rows that were loaded."""
    folder = scratch_folder(spark)
    _land_vendor_bars(spark, sf_dir, f"{folder}/vendor")
    warehouse = Warehouse(spark, f"{folder}/table", period="year")
    last = run_date_of(spark, sf_dir)
    for run_date in (last - dt.timedelta(days=7), last):
        run_day(warehouse, f"{folder}/vendor", f"{folder}/lake", run_date, symbols=PRIORITIES, use_history=True)
    return warehouse.read()


def q_incremental_run(spark, sf_dir):
    """Raw files of two landings, the second overlapping the first, loaded as they arrive."""
    folder = scratch_folder(spark)
    bars = orders_bars(spark, sf_dir)
    cut = dt.date(1998, 1, 1)
    landings = [
        (cut, bars.filter(F.col("date") <= F.lit(cut))),
        (run_date_of(spark, sf_dir), bars.filter(F.col("date") >= F.lit(cut))),
    ]
    warehouse = Warehouse(spark, f"{folder}/table", period="year")
    for run_date, landed in landings:
        write_raw(landed, f"{folder}/raw", run_date)
        load_new_files(warehouse, f"{folder}/raw", f"{folder}/state").awaitTermination()
    return warehouse.read()


def q_late_bars(spark, sf_dir):
    """The middle days of every month land after all others, in several files of one landing."""
    folder = scratch_folder(spark)
    bars = orders_bars(spark, sf_dir)
    late = F.dayofmonth("date").between(11, 13)
    warehouse = Warehouse(spark, f"{folder}/table", period="year")
    last = run_date_of(spark, sf_dir)
    for run_date, landed in ((last, bars.filter(~late)), (last + dt.timedelta(days=1), bars.filter(late))):
        write_raw(landed, f"{folder}/raw", run_date)
        load_new_files(warehouse, f"{folder}/raw", f"{folder}/state").awaitTermination()
    return warehouse.read()


def queries() -> dict[str, Query]:
    found = {name[2:]: query for name, query in globals().items() if name.startswith("q_")}
    return {name: _with_text_dates(query) for name, query in found.items()}


def _with_text_dates(query: Query) -> Query:
    return lambda spark, sf_dir: text_dates(query(spark, sf_dir))


# --- the same in SQL ---------------------------------------------------------

BARS_SQL = """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol,
       arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS volume,
       min(o_orderkey) AS k
FROM orders GROUP BY 1, 2
"""

EVENT_BARS_SQL = """
SELECT CAST(ts AS DATE) AS date, event_type AS symbol,
       arg_min(value, event_id) AS open, max(value) AS high,
       min(value) AS low, arg_max(value, event_id) AS close,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS volume
FROM events GROUP BY 1, 2
"""

DIRTY_SQL = """
SELECT CASE WHEN k % 29 = 4 THEN NULL ELSE date END AS date, symbol, open, high, low,
       CASE WHEN k % 23 = 1 THEN NULL WHEN k % 23 = 2 THEN 0.0
            WHEN k % 23 = 3 THEN -close ELSE close END AS close,
       CASE WHEN k % 31 = 5 THEN NULL WHEN k % 31 = 6 THEN 0 ELSE volume END AS volume
FROM bars
"""

CLEAN_SQL = """
SELECT * FROM dirty
WHERE date IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL AND close > 0 AND volume > 0
"""

ROWS_SQL = """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol, o_totalprice AS close,
       CAST(round(o_totalprice * 100) AS BIGINT) AS volume, o_orderkey AS order_key
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def _round(value: str) -> str:
    """Two places, half up on the decimal text, as the library rounds.

    DuckDB's own ``round`` works on the binary value and takes some ties down.
    """
    return f"CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 2)) AS DOUBLE)"


def _change(order: str = "date") -> str:
    previous = f"lag(close) OVER (PARTITION BY symbol ORDER BY {order})"
    return f"{_round(f'(close - {previous}) / {previous} * 100')} AS price_change_pct"


def _average(order: str = "date") -> str:
    mean = f"avg(close) OVER (PARTITION BY symbol ORDER BY {order} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    return f"{_round(mean)} AS moving_avg_7d"


CATEGORY = (
    "CASE WHEN volume > 50000000 THEN 'HIGH' WHEN volume > 20000000 THEN 'MEDIUM'"
    " ELSE 'LOW' END AS volume_category"
)
BAR_LIST = "CAST(date AS VARCHAR) AS date, symbol, open, high, low, close, volume"
FEATURE_LIST = f"{BAR_LIST}, price_change_pct, moving_avg_7d, volume_category"
ROW_LIST = "CAST(date AS VARCHAR) AS date, symbol, close, volume, order_key"
RANKED = "row_number() OVER (PARTITION BY symbol ORDER BY date DESC)"


def _features(source: str, order: str = "date") -> str:
    return f"SELECT *, {_change(order)}, {_average(order)}, {CATEGORY} FROM {source}"


def _with(select: str, **steps: str) -> str:
    """``select`` under the named steps it uses, on top of the shared ones."""
    shared = {"bars": BARS_SQL, "dirty": DIRTY_SQL, "clean": CLEAN_SQL, "featured": _features("clean")}
    parts = ", ".join(f"{name} AS ({text})" for name, text in {**shared, **steps}.items())
    return f"WITH {parts} {select}"


def oracle_sql() -> dict[str, str]:
    run, audit = "(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)", f"DATE '{AUDIT_DATE}'"
    universe = ", ".join(f"('{name}')" for name in PRIORITIES)
    stored = {
        "stored": f"SELECT * FROM bars WHERE date <= {run}",
        "batch": f"SELECT * FROM stored QUALIFY {RANKED} <= 5",
    }
    replaced = (
        f"SELECT {BAR_LIST} FROM stored WHERE date <> {run} UNION ALL SELECT {BAR_LIST} FROM batch"
    )
    history = (
        f"SELECT {FEATURE_LIST} FROM featured"
        f" WHERE (symbol, date) IN (SELECT (symbol, date) FROM clean QUALIFY {RANKED} <= 5)"
    )
    table_now = {
        "stored": f"SELECT * FROM featured WHERE date <= {run}",
        "batch": "SELECT * REPLACE (close + 1 AS close) FROM stored WHERE date IN"
        " (SELECT DISTINCT date FROM stored ORDER BY date DESC LIMIT 5)",
    }
    corrected = (
        f"SELECT {FEATURE_LIST} FROM stored WHERE date NOT IN (SELECT date FROM batch)"
        f" UNION ALL SELECT {FEATURE_LIST} FROM batch"
    )

    now = "SELECT * FROM stored WHERE date NOT IN (SELECT date FROM batch) UNION ALL SELECT * FROM batch"

    def fetched(day: str) -> str:
        return (
            f"SELECT * FROM dirty WHERE date <= {day} AND (symbol, date) IN"
            f" (SELECT (symbol, date) FROM dirty WHERE date <= {day} QUALIFY {RANKED} <= 5)"
            " AND close > 0 AND volume > 0"
        )

    runs = {
        "one": _features(f"({fetched(f'{run} - INTERVAL 1 DAY')})"),
        "two": _features(f"({fetched(run)})"),
    }
    return {
        "daily_bars": _with(f"SELECT {BAR_LIST} FROM bars"),
        "daily_bars_merged": _with(f"SELECT {BAR_LIST} FROM bars"),
        "clean_bars": _with(f"SELECT {BAR_LIST} FROM clean"),
        "validate_bars": _with(f"SELECT {BAR_LIST} FROM clean WHERE date <= {audit}"),
        "price_change": _with(f"SELECT {BAR_LIST}, {_change()} FROM clean"),
        "moving_average": _with(f"SELECT {BAR_LIST}, {_average()} FROM clean"),
        "volume_category": _with(f"SELECT {BAR_LIST}, {CATEGORY} FROM clean"),
        "transform_full": _with(f"SELECT {FEATURE_LIST} FROM featured"),
        "transform_copies": _with(
            f"SELECT {ROW_LIST}, {_change('date, order_key')}, {_average('date, order_key')},"
            f" {CATEGORY} FROM order_rows WHERE close > 0 AND volume > 0",
            order_rows=ROWS_SQL,
        ),
        "price_change_copies": _with(
            f"SELECT {ROW_LIST}, {_change('date, order_key')} FROM order_rows", order_rows=ROWS_SQL
        ),
        "moving_average_copies": _with(
            f"SELECT {ROW_LIST}, {_average('date, order_key')} FROM order_rows", order_rows=ROWS_SQL
        ),
        "symbol_summary": _with(_summary("featured")),
        "row_counts": _with(
            f"""SELECT count(*) AS total_rows,
                count(*) FILTER (WHERE date IS NULL) AS null_date,
                count(*) FILTER (WHERE close IS NULL) AS null_close,
                count(*) FILTER (WHERE volume IS NULL) AS null_volume,
                count(*) FILTER (WHERE close <= 0) AS bad_close,
                count(*) FILTER (WHERE volume <= 0) AS bad_volume,
                count(*) FILTER (WHERE date > {audit}) AS future_date,
                count(*) - count(*) FILTER (WHERE close > 0 AND volume > 0 AND date <= {audit}) AS removed_rows,
                count(*) FILTER (WHERE close > 0 AND volume > 0 AND date <= {audit}) AS kept_rows
            FROM dirty"""
        ),
        "table_count": _with("SELECT count(*) AS total_rows FROM featured"),
        "symbol_counts": _with("SELECT symbol, count(*) AS row_count FROM clean GROUP BY symbol"),
        "distinct_symbols": _with("SELECT DISTINCT symbol FROM bars"),
        "missing_symbols": _with(
            f"SELECT symbol FROM (VALUES {universe}) AS u(symbol)"
            " WHERE NOT EXISTS (SELECT 1 FROM bars WHERE bars.symbol = u.symbol)"
        ),
        "duplicate_keys": _with(
            "SELECT symbol, date, count(*) AS copies FROM replaced GROUP BY symbol, date HAVING count(*) > 1",
            **stored,
            replaced=replaced,
        ),
        "dedupe_latest": _with(
            f"SELECT {ROW_LIST} FROM order_rows QUALIFY row_number()"
            " OVER (PARTITION BY symbol, date ORDER BY order_key DESC) = 1",
            order_rows=ROWS_SQL,
        ),
        "run_summary": _with(
            f"""SELECT CAST({run} AS VARCHAR) AS run_date, count(*) AS total_rows,
                count(DISTINCT symbol) AS symbol_count,
                string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols,
                CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date
            FROM bars"""
        ),
        "lookback_sessions": _with(f"SELECT {BAR_LIST} FROM bars QUALIFY {RANKED} <= 5"),
        "lookback_copies": _with(
            f"SELECT {ROW_LIST} FROM order_rows QUALIFY dense_rank()"
            " OVER (PARTITION BY symbol ORDER BY date DESC) <= 5",
            order_rows=ROWS_SQL,
        ),
        "vendor_normalize": _vendor(),
        "vendor_files": _vendor(),
        "rejected_files": """SELECT symbol, reason, count(*) AS rows
            FROM events, (VALUES ('no-close', 'no column Close'), ('no-header', 'no column Date')) AS v(symbol, reason)
            WHERE event_type = 'click' GROUP BY ALL""",
        "union_symbols": _with(
            f"SELECT {BAR_LIST} FROM bars UNION ALL SELECT {BAR_LIST} FROM event_bars",
            event_bars=EVENT_BARS_SQL,
        ),
        "warehouse_rows": _with(f"SELECT {FEATURE_LIST} FROM featured"),
        "preview_rows": _with(
            f"SELECT {BAR_LIST} FROM (SELECT * FROM bars ORDER BY symbol, date LIMIT 20)"
        ),
        "preview_ten": _with(
            f"SELECT {BAR_LIST} FROM (SELECT * FROM event_bars ORDER BY symbol, date LIMIT 10)",
            event_bars=EVENT_BARS_SQL,
        ),
        "sorted_bars": _with(f"SELECT {BAR_LIST} FROM bars ORDER BY symbol, date"),
        "replace_run_date": _with(replaced, **stored),
        "replace_batch_dates": _with(
            f"""SELECT CAST(date AS VARCHAR) AS date, symbol, open, high, low,
                CASE WHEN date IN (SELECT DISTINCT date FROM stored ORDER BY date DESC LIMIT 5)
                THEN close + 1 ELSE close END AS close, volume FROM stored""",
            **stored,
        ),
        "upsert_by_key": _with(
            f"""SELECT {BAR_LIST} FROM stored s WHERE NOT EXISTS
                (SELECT 1 FROM batch b WHERE b.symbol = s.symbol AND b.date = s.date)
            UNION ALL
            SELECT CAST(date AS VARCHAR), symbol, open, high, low, close + 1, volume FROM batch""",
            **stored,
        ),
        "lost_keys": _with(
            """SELECT symbol, CAST(date AS VARCHAR) AS date FROM stored s
            WHERE date IN (SELECT date FROM batch) AND NOT EXISTS
                (SELECT 1 FROM batch b WHERE b.symbol = s.symbol AND b.date = s.date)""",
            **stored,
        ),
        "history_features": _with(history),
        "history_recent": _with(history),
        "csv_roundtrip": _with(f"SELECT {BAR_LIST} FROM clean"),
        "csv_inferred": _with(f"SELECT {BAR_LIST} FROM clean"),
        "parquet_roundtrip": _with(f"SELECT {FEATURE_LIST} FROM featured"),
        "load_replace_run_date": _with(
            # The run date is replaced by each load, the other batch dates gain a copy each time.
            f"""SELECT {FEATURE_LIST} FROM stored WHERE date <> {run}
            UNION ALL SELECT {FEATURE_LIST} FROM batch
            UNION ALL SELECT {FEATURE_LIST} FROM batch WHERE date <> {run}""",
            **table_now,
        ),
        "load_replace_batch_dates": _with(corrected, **table_now),
        "load_upsert": _with(corrected, **table_now),
        "summary_replace_run_date": _with(
            _summary("now"),
            **table_now,
            now=f"""SELECT * FROM stored WHERE date <> {run} UNION ALL SELECT * FROM batch
            UNION ALL SELECT * FROM batch WHERE date <> {run}""",
        ),
        "summary_replace_batch_dates": _with(_summary("now"), **table_now, now=now),
        "summary_upsert": _with(_summary("now"), **table_now, now=now),
        "run_summary_parts": _with(
            f"""SELECT CAST({run} AS VARCHAR) AS run_date, count(*) AS total_rows,
                count(DISTINCT symbol) AS symbol_count,
                string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols,
                CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date
            FROM stored""",
            **table_now,
        ),
        "daily_run": _with(
            f"""SELECT {FEATURE_LIST} FROM one WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM two)
            UNION ALL SELECT {FEATURE_LIST} FROM two""",
            **runs,
        ),
        "daily_run_history": _with(
            f"SELECT {FEATURE_LIST} FROM everything",
            everything=_features(f"({fetched(f'{run} - INTERVAL 7 DAY')} UNION {fetched(run)})"),
        ),
        "exchange_dates": _vendor("ts - INTERVAL 5 HOUR"),
        "rejected_rows": _with(
            "SELECT symbol, count(*) AS rejected, count(*) FILTER (WHERE k % 17 = 1) AS bad_dates"
            " FROM bars WHERE k % 17 = 1 OR k % 19 = 2 GROUP BY symbol"
        ),
        "incremental_run": _with(f"SELECT {FEATURE_LIST} FROM everything", everything=_features("bars")),
        "late_bars": _with(f"SELECT {FEATURE_LIST} FROM everything", everything=_features("bars")),
    }


def _summary(source: str) -> str:
    return (
        f"SELECT symbol, {_round('max(close)')} AS max_close, {_round('min(close)')} AS min_close,"
        f" {_round('avg(close)')} AS avg_close FROM {source} GROUP BY symbol ORDER BY symbol"
    )


def _vendor(instant: str = "ts") -> str:
    return f"""
    SELECT CAST(CAST({instant} AS DATE) AS VARCHAR) AS date, event_type AS symbol, value AS open,
           value AS high, value AS low, value AS close,
           CAST(round(value * 100) AS BIGINT) AS volume
    FROM events"""
