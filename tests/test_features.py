import datetime as dt
import random

import pytest
from helpers import bars, day, rows, series
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.columns import rounded, session_date
from candlewick.operators import series as series_module
from candlewick.operators.features import (
    add_features,
    add_moving_average,
    add_price_change,
    add_volume_category,
    features,
    history_features,
    lookback,
)
from candlewick.plans.daily import with_stored_history
from candlewick.schema import FEATURE_COLUMNS
from candlewick.sinks.warehouse import Warehouse

CHANGES = [None, 100.0, 50.0, 33.33, 25.0, 20.0, 16.67, 14.29]
AVERAGES = [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0]


def by_date(frame, column):
    return [r[0] for r in frame.orderBy("symbol", "date").select(column).collect()]


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("gap", [1, 3, 40])
def test_golden_rows_count_rows_not_days(spark, gap, unique):
    out = features(series(spark, range(1, 9), gap=gap), unique=unique)
    assert out.columns == FEATURE_COLUMNS
    assert by_date(out, "price_change_pct") == CHANGES
    assert by_date(out, "moving_avg_7d") == AVERAGES


@pytest.mark.parametrize("count", [1, 6, 7, 8])
def test_partial_and_full_frames(spark, count):
    out = add_moving_average(series(spark, range(1, count + 1)), unique=True)
    assert by_date(out, "moving_avg_7d") == AVERAGES[:count]


def test_frame_length_is_a_parameter(spark):
    out = add_moving_average(series(spark, [1, 2, 4]), rows=1, unique=True)
    assert by_date(out, "moving_avg_7d") == [1.0, 2.0, 4.0]


def test_symbols_do_not_mix(spark):
    both = series(spark, range(1, 9)).unionByName(series(spark, [10] * 8, symbol="B"))
    out = add_price_change(both.repartition(5), unique=True)
    assert by_date(out, "price_change_pct") == CHANGES + [None] + [0.0] * 7


def test_null_symbol_is_a_series_of_its_own(spark):
    frame = bars(spark, [(day(i), None, float(i + 1), 1) for i in range(3)])
    for unique in (True, False):
        assert by_date(features(frame, unique=unique), "moving_avg_7d") == [1.0, 1.5, 2.0]


def test_change_from_zero_is_null(spark):
    out = add_price_change(series(spark, [0, 5]), unique=True)
    assert by_date(out, "price_change_pct") == [None, None]


@pytest.mark.parametrize(
    "volume, category",
    [
        (50_000_001, "HIGH"),
        (50_000_000, "MEDIUM"),
        (20_000_001, "MEDIUM"),
        (20_000_000, "LOW"),
        (1, "LOW"),
        (None, "LOW"),
    ],
)
def test_volume_category(spark, volume, category):
    out = add_volume_category(bars(spark, [(day(0), "A", 1.0, volume)]))
    assert by_date(out, "volume_category") == [category]


def test_ties_round_half_up(spark):
    cases = {1.005: 1.01, 2.675: 2.68, 0.125: 0.13, -0.125: -0.13, 1.015: 1.02}
    frame = spark.createDataFrame([(v,) for v in cases], "v double")
    assert [r[0] for r in frame.select(rounded(F.col("v"))).collect()] == list(cases.values())


def test_session_date_uses_exchange_time(spark):
    late = spark.createDataFrame([("2026-03-26 01:00:00+00:00",)], "Date string")
    assert late.select(session_date(F.col("Date"), "string")).first()[0] == dt.date(2026, 3, 26)
    new_york = session_date(F.col("Date"), "string", "America/New_York")
    assert late.select(new_york).first()[0] == dt.date(2026, 3, 25)
    instant = late.select(F.col("Date").cast("timestamp").alias("Date"))
    new_york = session_date(F.col("Date"), "timestamp", "America/New_York")
    assert instant.select(new_york).first()[0] == dt.date(2026, 3, 25)


def brute_force(data, key):
    """Change and average by walking each symbol's sorted rows."""
    out = []
    for symbol in {r[1] for r in data}:
        ordered = sorted((r for r in data if r[1] == symbol), key=key)
        for i, row in enumerate(ordered):
            frame = [r[2] for r in ordered[max(0, i - 6) : i + 1]]
            previous = ordered[i - 1][2] if i else None
            out.append((*row, previous, sum(frame) / len(frame)))
    return out


TICKS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)
NEIGHBOURS = {
    "prev": lambda w: F.lag("close").over(w),
    "mean": lambda w: F.avg("close").over(w.rowsBetween(-6, 0)),
}


@pytest.mark.parametrize("seed, copies_share", [(0, 1), (1, 6)])
def test_hot_symbols_equal_brute_force(spark, monkeypatch, seed, copies_share):
    """Few dates, many copies, one hot symbol and date; blocks down to a single row."""
    monkeypatch.setattr(series_module, "COPIES_SHARE", copies_share)
    monkeypatch.setattr(series_module, "COPIES_PER_TASK", 3)
    rng = random.Random(seed)
    data = [(day(rng.randrange(4)), "HOT", float(rng.randrange(1, 9)), rng.randrange(3)) for _ in range(120)]
    data += [(day(1), "HOT", 7.0, 1)] * 40 + [(day(2), None, 2.0, 1)] * 25
    data += [(day(i), "COLD", float(i + 1), 1) for i in range(5)]
    frame = spark.createDataFrame(data, TICKS)
    hot = {r[0] for r in series_module.hot_symbols(frame, 6).collect()}
    assert hot == {"HOT", None}

    def nearly(found):
        return [(*r[:5], round(r[5], 9)) for r in found]

    expected = brute_force(data, key=lambda r: (r[0], r[2], r[3]))
    expected = sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    ours = series_module.over_series(frame, NEIGHBOURS, reach=6, hot_rows=6)
    assert nearly(rows(ours)) == nearly(expected)
    plain = series_module.over_series(frame, NEIGHBOURS, reach=6, split=False)
    assert rows(plain) == rows(ours)
    moved = series_module.over_series(frame.repartition(7), NEIGHBOURS, reach=6, hot_rows=6)
    assert rows(moved) == rows(ours)

    expected = brute_force(data, key=lambda r: (r[0], r[3], r[2]))
    expected = sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    ours = series_module.over_series(frame, NEIGHBOURS, reach=6, tie=["volume"], hot_rows=6)
    assert nearly(rows(ours)) == nearly(expected)


def test_blocks_are_cut_and_bounded(spark, tmp_path):
    """One symbol and date with distinct rows is cut into blocks of about the wanted size."""
    frame = spark.range(20_000).select(
        F.lit(day(0)).alias("date"),
        F.lit("HOT").alias("symbol"),
        F.col("id").cast("double").alias("close"),
        F.lit(1).cast("long").alias("volume"),
    )
    packed = series_module._collapse_copies(frame, 1_000, f"{tmp_path}/many")
    blocks = series_module._put_in_order(packed, ["date", "close", "volume"], 20, 1_000, f"{tmp_path}/rows")
    sizes = [r[0] for r in blocks.groupBy("_block").count().select("count").collect()]
    assert sum(sizes) == 20_000
    assert len(sizes) >= 10 and max(sizes) < 5_000
    assert [r.close for r in blocks.orderBy("_at").collect()] == list(range(20_000))


def test_plain_and_split_agree_on_unique_keys(spark):
    rng = random.Random(7)
    data = [(day(i), s, float(rng.randrange(100, 999)) / 10, i) for s in "ABC" for i in range(60)]
    frame = bars(spark, data)
    assert rows(add_features(frame, unique=True)) == rows(add_features(frame, hot_rows=5))


def test_features_do_not_depend_on_partitioning(spark):
    frame = series(spark, range(1, 40)).unionByName(series(spark, range(5, 50), symbol="B"))
    assert rows(features(frame.repartition(1))) == rows(features(frame.repartition(9).orderBy(F.rand(3))))


@pytest.mark.parametrize("unique", [True, False])
def test_lookback_takes_dates_of_each_symbol(spark, unique):
    frame = series(spark, range(1, 9)).unionByName(series(spark, range(1, 4), symbol="B", gap=9))
    out = lookback(frame, 5, unique=unique)
    assert rows(out.select("symbol", "date")) == rows(
        spark.createDataFrame(
            [("A", day(i)) for i in range(3, 8)] + [("B", day(i * 9)) for i in range(3)],
            "symbol string, date date",
        )
    )


def test_lookback_keeps_copies_and_null_symbols(spark):
    frame = bars(spark, [(day(i // 3), None, 1.0, i) for i in range(30)])
    assert lookback(frame, 2).count() == 6


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("split", [None, 0, 6])
def test_history_features_equal_one_shot(spark, tmp_path, seed, split):
    """Any batch of rows, also a backfill between stored dates, with any boundary before it."""
    rng = random.Random(seed)
    data = [
        (day(i), s, float(rng.randrange(100, 999)) / 10, 1)
        for s in "ABCD"
        for i in range(40)
        if rng.random() < 0.7
    ]
    frame = bars(spark, data).cache()
    in_batch = F.when(F.col("symbol") == "A", F.col("date").between(F.lit(day(10)), F.lit(day(14)))).otherwise(
        F.col("date") >= F.lit(day(35))
    ) & (F.col("symbol") != "D")
    batch = frame.filter(in_batch)
    # The stored copies of the batch's keys are out of date and must not be used.
    stored = frame.withColumn("close", F.when(in_batch, F.lit(9999.0)).otherwise(F.col("close")))
    expected = rows(add_features(frame, unique=True).filter(in_batch))
    if split is None:
        out = history_features(batch, stored, unique=True)
    else:
        table = Warehouse(spark, f"{tmp_path}/table")
        table.load(add_features(stored, unique=True), "upsert_by_key")
        recent = dt.timedelta(days=split)
        out = with_stored_history(batch, table, f"{tmp_path}/context", recent, unique=True)
    assert out.columns == FEATURE_COLUMNS
    assert rows(out) == expected


def test_history_fills_the_frame(spark):
    frame = series(spark, range(1, 9))
    batch = frame.filter(F.col("date") == F.lit(day(7)))
    alone = features(batch, unique=True).first()
    together = history_features(batch, frame, unique=True).first()
    assert (alone.price_change_pct, alone.moving_avg_7d) == (None, 8.0)
    assert (together.price_change_pct, together.moving_avg_7d) == (14.29, 5.0)


@pytest.mark.parametrize("recent", [1, 60])
@pytest.mark.parametrize("copies", [1, 3])
def test_late_rows_refresh_what_follows(spark, tmp_path, recent, copies):
    """The table after an upsert of late and corrected rows equals one shot, repeated stored keys included."""
    rng = random.Random(recent + copies)
    data = [(day(i), s, float(rng.randrange(100, 999)) / 10, 1) for s in "ABC" for i in range(0, 90, 3)]
    late = [(day(i), s, 5.0, 1) for i, s in ((10, "A"), (12, "A"), (80, "A"), (0, "B"), (100, "C"))]
    keys = {row[:2] for row in late}
    stored = bars(spark, [row for row in data for _ in range(copies)])
    table = Warehouse(spark, f"{tmp_path}/table")
    table.load(add_features(stored), "upsert_by_key")
    batch = bars(spark, late)
    out = with_stored_history(batch, table, f"{tmp_path}/context", dt.timedelta(days=recent), refresh=True)
    out.write.parquet(f"{tmp_path}/batch")
    table.load(spark.read.parquet(f"{tmp_path}/batch"), "upsert_by_key")
    now = bars(spark, late + [row for row in data if row[:2] not in keys for _ in range(copies)])
    assert rows(table.read()) == rows(add_features(now).select(FEATURE_COLUMNS))


def test_no_short_symbol_reads_nothing_more(spark, tmp_path):
    table = Warehouse(spark, f"{tmp_path}/table")
    table.load(add_features(series(spark, range(1, 41)), unique=True), "upsert_by_key")
    batch = series(spark, range(1, 42)).filter(F.col("date") == F.lit(day(40)))
    with_stored_history(batch, table, f"{tmp_path}/context", dt.timedelta(days=10), unique=True)
    assert not (tmp_path / "context/before/rows0").exists()
    with_stored_history(batch, table, f"{tmp_path}/other", dt.timedelta(days=3), unique=True)
    assert (tmp_path / "other/before/rows0").exists()
