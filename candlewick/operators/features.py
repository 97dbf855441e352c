"""Per-symbol features of daily bars.

``tie``, ``unique``, ``hot_rows`` and ``split`` are those of ``over_series``: say
``unique=True`` when each symbol has one row per date (``daily_bars`` and
``dedupe`` give that); leave it out and hot symbols are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.columns import percent_change, rounded, volume_category
from candlewick.operators.quality import clean
from candlewick.operators.series import Expressions, over_series
from candlewick.schema import (
    AVERAGE_ROWS,
    BAR_COLUMNS,
    HIGH_VOLUME,
    KEYS,
    LOOKBACK_SESSIONS,
    MEDIUM_VOLUME,
)


def _previous_close(window):
    return F.lag("close", 1).over(window)


def _mean_close(rows: int):
    return lambda window: F.avg("close").over(window.rowsBetween(1 - rows, 0))


def _change_column():
    return percent_change(F.col("close"), F.col("_prev_close"))


def add_price_change(bars: DataFrame, **series) -> DataFrame:
    """Percent change of the close against the symbol's previous row; null on the first."""
    with_previous = over_series(bars, {"_prev_close": _previous_close}, reach=1, **series)
    return with_previous.withColumn("price_change_pct", _change_column()).drop("_prev_close")


def add_moving_average(bars: DataFrame, rows: int = AVERAGE_ROWS, **series) -> DataFrame:
    """Mean close of the row and up to ``rows - 1`` rows before it (rows, not days)."""
    with_mean = over_series(bars, {"_mean": _mean_close(rows)}, reach=max(rows - 1, 1), **series)
    return with_mean.withColumn("moving_avg_7d", rounded(F.col("_mean"))).drop("_mean")


def add_volume_category(
    bars: DataFrame, high: int = HIGH_VOLUME, medium: int = MEDIUM_VOLUME
) -> DataFrame:
    return bars.withColumn("volume_category", volume_category(F.col("volume"), high, medium))


def add_features(
    bars: DataFrame,
    rows: int = AVERAGE_ROWS,
    high: int = HIGH_VOLUME,
    medium: int = MEDIUM_VOLUME,
    more: Expressions | None = None,
    **series,
) -> DataFrame:
    """The three features, and ``more`` window expressions, from one pass over the series."""
    windows = {"_prev_close": _previous_close, "_mean": _mean_close(rows), **(more or {})}
    return (
        over_series(bars, windows, reach=max(rows - 1, 1), **series)
        .withColumns({"price_change_pct": _change_column(), "moving_avg_7d": rounded(F.col("_mean"))})
        .drop("_prev_close", "_mean")
        .transform(add_volume_category, high, medium)
    )


def features(bars: DataFrame, **options) -> DataFrame:
    """``clean`` and the three features: the whole transform step."""
    return add_features(clean(bars), **options)


def lookback(bars: DataFrame, sessions: int = LOOKBACK_SESSIONS, unique: bool = False) -> DataFrame:
    """Rows of the latest ``sessions`` dates present for each symbol.

    The rank limit is applied before the shuffle, so a symbol shuffles at most
    ``sessions`` rows per map task. Without ``unique`` only distinct dates are
    ranked; the rows then meet one cut-off date per symbol in an equi-join,
    which adaptive execution can split when a symbol is hot.
    """
    latest = Window.partitionBy("symbol").orderBy(F.desc("date"))
    dated = bars.filter(F.col("date").isNotNull())
    if unique:
        ranked = dated.withColumn("_rank", F.row_number().over(latest))
        return ranked.filter(F.col("_rank") <= sessions).drop("_rank")
    days = dated.select("symbol", "date").distinct()
    since = (
        days.withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") <= sessions)
        .groupBy(F.col("symbol").alias("_of"))
        .agg(F.min("date").alias("_since"))
    )
    return dated.join(
        since, F.col("symbol").eqNullSafe(F.col("_of")) & (F.col("date") >= F.col("_since"))
    ).drop("_of", "_since")


def history_features(
    batch: DataFrame,
    stored: DataFrame,
    rows: int = AVERAGE_ROWS,
    refresh: bool = False,
    **options,
) -> DataFrame:
    """Features of a clean ``batch`` as if computed over the stored rows and the batch together.

    ``refresh`` adds the stored rows that the batch changes: those up to
    ``rows - 1`` rows after a row of the batch, with all copies of their keys.
    """
    context = history_context(batch, stored, rows, refresh)
    return features_in_context(batch, context, rows, refresh, **options)


def features_in_context(
    batch: DataFrame, context: DataFrame, rows: int = AVERAGE_ROWS, refresh: bool = False, **options
) -> DataFrame:
    """Features of the batch's rows, with ``context`` rows in their series; ``refresh`` as above."""
    merged = batch.withColumn("_new", F.lit(True)).unionByName(
        context.withColumn("_new", F.lit(False)), allowMissingColumns=True
    )
    if not refresh:
        return add_features(merged, rows, **options).filter("_new").drop("_new")
    reach = max(rows - 1, 1)
    seen = {"_seen": lambda window: F.max("_new").over(window.rowsBetween(-reach, 0))}
    featured = add_features(merged, rows, more=seen, **options)
    # An upsert replaces whole keys, so a key goes with all its copies.
    keys = featured.filter("_seen").select(F.col("symbol").alias("_symbol"), F.col("date").alias("_date")).distinct()
    same_key = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("date") == F.col("_date"))
    return featured.drop("_new", "_seen").join(keys, same_key, "left_semi")


def batch_span(batch: DataFrame) -> DataFrame:
    """The first and last date of each symbol: _of, _first and _last."""
    return batch.groupBy(F.col("symbol").alias("_of")).agg(
        F.min("date").alias("_first"), F.max("date").alias("_last")
    )


def history_context(
    batch: DataFrame, stored: DataFrame, rows: int = AVERAGE_ROWS, refresh: bool = False
) -> DataFrame:
    """The stored rows that bear on the batch's features.

    These are its symbols' rows between its first and last date, without the
    keys it replaces, and the last ``rows - 1`` before; for ``refresh`` also
    the next ``rows - 1`` after, with all rows of the last date among them.
    """
    reach = max(rows - 1, 1)
    span = batch_span(batch)
    known = stored.select(BAR_COLUMNS).join(span, F.col("symbol").eqNullSafe(F.col("_of")))
    replaced = batch.select(*[F.col(k).alias(f"_batch_{k}") for k in KEYS]).distinct()
    same_key = F.col("symbol").eqNullSafe(F.col("_batch_symbol")) & (
        F.col("date") == F.col("_batch_date")
    )
    inside = known.filter(F.col("date").between(F.col("_first"), F.col("_last")))
    context = inside.join(replaced, same_key, "left_anti").select(BAR_COLUMNS)
    context = context.unionByName(rows_before(known, reach))
    return context.unionByName(rows_after(known, reach)) if refresh else context


def rows_before(known: DataFrame, count: int) -> DataFrame:
    """The last ``count`` rows of each symbol before ``_first``."""
    return _last_rows(known.filter(F.col("date") < F.col("_first")), count)


def rows_after(known: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows of each symbol after ``_last``, and others of the same dates."""
    earliest = Window.partitionBy("symbol").orderBy("date")
    ranked = known.filter(F.col("date") > F.col("_last")).withColumn("_rank", F.rank().over(earliest))
    return ranked.filter(F.col("_rank") <= count).select(BAR_COLUMNS)


def _last_rows(bars: DataFrame, count: int) -> DataFrame:
    """The last rows of each symbol; the rank limit is applied before the shuffle."""
    rest = [F.desc(c) for c in BAR_COLUMNS if c not in KEYS]
    latest = Window.partitionBy("symbol").orderBy(F.desc("date"), *rest)
    ranked = bars.withColumn("_rank", F.row_number().over(latest))
    return ranked.filter(F.col("_rank") <= count).select(BAR_COLUMNS)
