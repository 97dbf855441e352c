"""Result sets of the three replace modes: the target after loading a batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.schema import KEYS


def replace_run_date(target: DataFrame, batch: DataFrame, run_date: dt.date) -> DataFrame:
    """Delete the rows of ``run_date``, then append the whole batch.

    Not idempotent for a batch of several dates: its other dates are appended
    again by every run. Rows without a date stay, as under SQL's DELETE.
    """
    deleted = F.to_date("date").eqNullSafe(F.lit(run_date))
    return target.filter(~deleted).unionByName(batch)


def replace_batch_dates(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Delete every date the batch holds, then append it.

    Idempotent; right only if the batch carries all symbols of its dates
    (``lost_keys`` tells).
    """
    return target.join(_distinct_keys(batch, ["date"]), _same(["date"]), "left_anti").unionByName(batch)


def upsert_by_key(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Delete every (symbol, date) the batch holds, then append it; safe for partial batches."""
    return target.join(_distinct_keys(batch, KEYS), _same(KEYS), "left_anti").unionByName(batch)


def lost_keys(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Keys that ``replace_batch_dates`` would delete without a new row."""
    touched = target.join(_distinct_keys(batch, ["date"]), _same(["date"]), "left_semi")
    return touched.select(*KEYS).distinct().join(_distinct_keys(batch, KEYS), _same(KEYS), "left_anti")


def _distinct_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch keys once each under other names: copies are combined before the join."""
    return batch.select(*[F.col(k).alias(f"_batch_{k}") for k in keys]).distinct()


def _same(keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_batch_{key}"))
    return condition
