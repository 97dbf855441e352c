"""Daily price-bar analytics as composable Spark DataFrame transformations."""

from candlewick.functions.columns import percent_change, rounded, volume_category
from candlewick.operators.features import (
    add_moving_average,
    add_price_change,
    add_volume_category,
    features,
    history_features,
    lookback,
)
from candlewick.operators.quality import (
    clean,
    dedupe,
    duplicate_keys,
    missing_symbols,
    removal_counts,
    require_rows,
    validate,
)
from candlewick.operators.replace import (
    lost_keys,
    replace_batch_dates,
    replace_run_date,
    upsert_by_key,
)
from candlewick.operators.report import (
    distinct_symbols,
    preview,
    row_count,
    run_summary,
    symbol_counts,
    symbol_summary,
)
from candlewick.plans.daily import run_day, with_stored_history
from candlewick.sinks.files import write_processed, write_raw
from candlewick.sinks.warehouse import Warehouse, warehouse_rows
from candlewick.sources.bars import (
    daily_bars,
    normalize_vendor,
    read_vendor,
    rejected_files,
    union_frames,
    vendor_files,
)
from candlewick.sources.files import read_processed, read_raw, rejected_rows

__all__ = [
    "Warehouse",
    "add_moving_average",
    "add_price_change",
    "add_volume_category",
    "clean",
    "daily_bars",
    "dedupe",
    "distinct_symbols",
    "duplicate_keys",
    "features",
    "history_features",
    "lookback",
    "lost_keys",
    "missing_symbols",
    "normalize_vendor",
    "percent_change",
    "preview",
    "read_processed",
    "read_raw",
    "read_vendor",
    "rejected_files",
    "rejected_rows",
    "removal_counts",
    "replace_batch_dates",
    "replace_run_date",
    "require_rows",
    "rounded",
    "row_count",
    "run_day",
    "run_summary",
    "symbol_counts",
    "symbol_summary",
    "union_frames",
    "upsert_by_key",
    "validate",
    "vendor_files",
    "volume_category",
    "warehouse_rows",
    "with_stored_history",
    "write_processed",
    "write_raw",
]
