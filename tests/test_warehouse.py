import datetime as dt

import pytest
from helpers import bars, day, rows, series
from pyspark.sql import functions as F

from candlewick.operators.features import features
from candlewick.operators.quality import duplicate_keys
from candlewick.operators.replace import (
    lost_keys,
    replace_batch_dates,
    replace_run_date,
    upsert_by_key,
)
from candlewick.schema import FEATURE_COLUMNS, FEATURE_SCHEMA
from candlewick.sinks.warehouse import PERIODS, Warehouse, warehouse_rows

LAST = day(5)


@pytest.fixture
def stored(spark):
    both = series(spark, range(1, 7)).unionByName(series(spark, range(11, 17), symbol="B"))
    return features(both, unique=True)


@pytest.fixture
def batch(stored):
    return stored.filter(F.col("date") >= F.lit(day(1)))


def keys(frame):
    return [r[:2] for r in rows(frame.select("date", "symbol"))]


def test_run_date_mode_repeats_the_other_dates(stored, batch):
    once = replace_run_date(stored, batch, LAST)
    counts = {r["date"]: r["count"] for r in once.groupBy("date").count().collect()}
    assert counts == {day(0): 2, **{day(i): 4 for i in range(1, 5)}, LAST: 2}
    assert replace_run_date(once, batch, LAST).count() == once.count() + 8


def test_run_date_mode_keeps_rows_without_date(spark):
    target = bars(spark, [(None, "A", 1.0, 1), (LAST, "A", 2.0, 1)])
    assert rows(replace_run_date(target, target.limit(0), LAST)) == rows(target.filter("date is null"))


@pytest.mark.parametrize("mode", [replace_batch_dates, upsert_by_key])
def test_other_modes_are_idempotent(stored, batch, mode):
    once = mode(stored, batch)
    assert duplicate_keys(once).isEmpty()
    assert rows(mode(once, batch)) == rows(once) == rows(stored)


def test_partial_batch(stored, batch):
    partial = batch.filter("symbol = 'A'")
    assert rows(upsert_by_key(stored, partial)) == rows(stored)
    assert replace_batch_dates(stored, partial).filter("symbol = 'B'").count() == 1
    assert keys(lost_keys(stored, partial)) == [(day(i), "B") for i in range(1, 6)]
    assert lost_keys(stored, batch).isEmpty()


def test_null_symbol_is_a_key(spark):
    target = bars(spark, [(LAST, None, 1.0, 1), (LAST, "A", 1.0, 1)])
    fixed = bars(spark, [(LAST, None, 2.0, 1)])
    once = upsert_by_key(target, fixed)
    assert rows(upsert_by_key(once, fixed)) == rows(once)
    assert once.count() == 2


@pytest.mark.parametrize("period", PERIODS)
@pytest.mark.parametrize("mode", ["replace_run_date", "replace_batch_dates", "upsert_by_key"])
def test_stored_table_equals_result_set(spark, tmp_path, stored, batch, mode, period):
    table = Warehouse(spark, str(tmp_path / "table"), period)
    table.load(stored, mode, LAST)
    assert rows(table.read()) == rows(stored)
    changed = batch.withColumn("close", F.col("close") + 100)
    expected = {
        "replace_run_date": lambda t: replace_run_date(t, changed, LAST),
        "replace_batch_dates": lambda t: replace_batch_dates(t, changed),
        "upsert_by_key": lambda t: upsert_by_key(t, changed),
    }[mode]
    table.load(changed, mode, LAST)
    once = expected(stored)
    assert rows(table.read()) == rows(once)
    table.load(changed, mode, LAST)
    assert rows(table.read()) == rows(expected(once))


@pytest.mark.parametrize("period", PERIODS)
def test_run_date_without_new_rows_is_emptied(spark, tmp_path, stored, period):
    table = Warehouse(spark, str(tmp_path / "table"), period)
    only_last = stored.filter(F.col("date") == F.lit(LAST))
    table.load(only_last, "replace_run_date", LAST)
    table.load(only_last.limit(0), "replace_run_date", LAST)
    assert table.read().count() == 0


@pytest.mark.parametrize("period", PERIODS)
def test_sparse_batch_leaves_other_periods_alone(spark, tmp_path, period):
    whole = features(series(spark, range(1, 60), gap=30), unique=True)
    table = Warehouse(spark, str(tmp_path / "table"), period)
    table.load(whole, "upsert_by_key")
    ends = whole.filter(F.col("date").isin([day(0), day(58 * 30)])).withColumn("close", F.lit(7.0))
    table.load(ends, "upsert_by_key")
    assert rows(table.read()) == rows(upsert_by_key(whole, ends))
    some = table.read(first=day(300), last=day(600))
    assert rows(some) == rows(whole.filter(F.col("date").between(F.lit(day(300)), F.lit(day(600)))))


def test_partial_batch_is_refused(spark, tmp_path, stored, batch):
    table = Warehouse(spark, str(tmp_path / "table"))
    table.load(stored, "replace_batch_dates")
    partial = batch.filter("symbol = 'A'")
    with pytest.raises(ValueError, match="lacks symbols"):
        table.load(partial, "replace_batch_dates")
    assert rows(table.read()) == rows(stored)
    table.load(partial, "replace_batch_dates", allow_partial=True)
    assert table.read().filter("symbol = 'B'").count() == 1


def test_reading_a_range_prunes_folders(spark, tmp_path, stored):
    table = Warehouse(spark, str(tmp_path / "table"), "day")
    table.load(stored, "upsert_by_key")
    plan = table.read(first=LAST)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_arguments(spark, tmp_path, stored):
    with pytest.raises(ValueError):
        Warehouse(spark, str(tmp_path), "week")
    table = Warehouse(spark, str(tmp_path / "table"))
    with pytest.raises(ValueError):
        table.load(stored, "append")
    with pytest.raises(ValueError):
        table.load(stored, "replace_run_date")


def test_warehouse_types(stored):
    out = warehouse_rows(stored.withColumn("price_change_pct", F.lit(float("nan"))))
    assert out.columns == FEATURE_COLUMNS
    assert [t for _, t in out.dtypes] == ["string", "string", *["double"] * 4, "bigint", "double", "double", "string"]
    assert out.filter("price_change_pct is not null").isEmpty()
    assert out.agg(F.max("date")).first()[0] == LAST.isoformat()


@pytest.mark.parametrize("mode", ["replace_run_date", "replace_batch_dates", "upsert_by_key"])
def test_rows_without_date_or_symbol_and_untouched_folders(spark, tmp_path, mode):
    """Whatever is null, the table holds what the operator returns; other folders aren't read."""
    from candlewick.operators import replace

    def featured(rows):
        frame = spark.createDataFrame(rows, "date date, symbol string, close double")
        others = [(f.name, f.dataType) for f in FEATURE_SCHEMA.fields if f.name not in frame.columns]
        frame = frame.select("*", *[F.lit(None).cast(t).alias(n) for n, t in others])
        return frame.select([f.name for f in FEATURE_SCHEMA.fields])

    days = [dt.date(2023, month, 5) for month in range(1, 13)]
    stored = featured([(None, "A", 1.0), (None, None, 2.0), *[(d, s, 3.0) for d in days for s in ("A", None)]])
    batch = featured([(None, "B", 4.0), (days[0], None, 5.0), (days[0], "A", 5.0), (days[11], "A", 6.0)])
    warehouse = Warehouse(spark, f"{tmp_path}/table")
    warehouse.load(stored, "upsert_by_key")
    touched = warehouse._touched(batch, None)
    assert touched.select(F.input_file_name().alias("file")).distinct().count() == 3
    run_date = days[0]
    operator = getattr(replace, mode)
    expected = operator(stored, batch, run_date) if mode == "replace_run_date" else operator(stored, batch)
    warehouse.load(batch, mode, run_date, allow_partial=True)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, warehouse.read().collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)
