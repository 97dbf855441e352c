"""Writers for the raw (CSV) and processed (Parquet) zones.

Each run date has its own folder, which a re-run replaces as a whole. The URI
is written to directly; nothing is staged on a local disk.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from candlewick.schema import BAR_COLUMNS


def write_raw(bars: DataFrame, uri: str, run_date: dt.date) -> str:
    folder = f"{uri}/run_date={run_date:%Y-%m-%d}"
    bars.select(BAR_COLUMNS).write.mode("overwrite").option("header", True).csv(folder)
    return folder


def write_processed(rows: DataFrame, uri: str, run_date: dt.date) -> str:
    folder = f"{uri}/run_date={run_date:%Y-%m-%d}"
    rows.write.mode("overwrite").parquet(folder)
    return folder
