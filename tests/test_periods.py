"""Tables whose loads become visible at one commit."""

import pytest
from helpers import bars, day, rows, series
from pyspark.sql import functions as F

from candlewick import storage
from candlewick.operators.features import add_features
from candlewick.operators.report import counts_of_parts, run_summary, run_summary_of_parts, summary_of_parts, symbol_counts, symbol_summary
from candlewick.schema import BAR_SCHEMA
from candlewick.sinks.periods import PERIODS, PeriodTable
from candlewick.sinks.warehouse import MODES, Warehouse
from candlewick.sources.bars import bar_state, daily_bars, land_ticks
from candlewick.streaming.incremental import DELIVERED_SCHEMA, load_new_files
from candlewick.sinks.files import write_raw


class Lost(Exception):
    pass


def lose(*_):
    raise Lost


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("step", ["write", "derive", "commit", "rename"])
def test_a_load_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch, mode, step):
    """Whatever step the driver dies in, readers see the old rows, and the load can be run again."""
    stored = add_features(series(spark, range(1, 90)), unique=True)
    batch = stored.filter(F.col("date") >= F.lit(day(60))).withColumn("close", F.lit(7.0))
    table = Warehouse(spark, str(tmp_path / "table"))
    table.load(stored, "upsert_by_key")
    before, summary = rows(table.read()), rows(summary_of_parts(table.parts()))
    with monkeypatch.context() as patch:
        if step == "write":
            written = PeriodTable._write
            patch.setattr(PeriodTable, "_write", lambda self, rows, folder: (written(self, rows, folder), lose()))
        elif step == "derive":
            patch.setattr("candlewick.sinks.warehouse.symbol_parts", lambda rows, *by: lose())
        elif step == "commit":
            patch.setattr(PeriodTable, "_commit", lose)
        else:
            patch.setattr(storage, "write_once", lose)
        with pytest.raises(Lost):
            table.load(batch, mode, day(88))
    assert rows(table.read()) == before and rows(summary_of_parts(table.parts())) == summary
    table.load(batch, mode, day(88))
    fresh = Warehouse(spark, str(tmp_path / "fresh"))
    fresh.load(stored, "upsert_by_key")
    fresh.load(batch, mode, day(88))
    assert rows(table.read()) == rows(fresh.read()) != before


def test_two_writers(spark, tmp_path, monkeypatch):
    table = PeriodTable(spark, str(tmp_path), BAR_SCHEMA)
    table.replace(series(spark, [1, 2]))
    monkeypatch.setattr(PeriodTable, "_last", lambda self: 0)  # as if the other had not committed yet
    with pytest.raises(FileExistsError):
        table.replace(series(spark, [3]))
    monkeypatch.undo()
    assert rows(table.read().drop("month")) == rows(series(spark, [1, 2]))


@pytest.mark.parametrize("period", PERIODS)
def test_periods_are_replaced_and_old_ones_go(spark, tmp_path, period):
    table = PeriodTable(spark, str(tmp_path), BAR_SCHEMA, period)
    assert not table.exists() and table.read().count() == 0 and table.landing() == 0
    whole = series(spark, range(1, 41), gap=20).unionByName(bars(spark, [(None, "A", 1.0, 1)]))
    table.replace(whole)
    assert rows(table.read().drop(period)) == rows(whole)
    first = table.first_day(day(0))
    reader = table.read([first])
    for close in (5.0, 6.0, 7.0):
        now = table.read([first]).drop(period).withColumn("close", F.lit(close))
        table.replace(now, [first])
        if close < 6:
            assert reader.count() == table.read([first]).count()  # who has begun may go on
    assert {r.close for r in table.read([first]).collect()} == {7.0}
    files = [str(f.relative_to(tmp_path)) for f in tmp_path.rglob(f"{period}={first}/*.parquet")]
    assert len({f.split("/")[0] for f in files}) == 2
    assert len(list((tmp_path / "_manifest").glob("0*.json"))) == 2
    table.replace(table.read([None]).drop(period).limit(0), [None, first])
    assert rows(table.read().drop(period)) == rows(whole.filter(F.col("date") > F.lit(table.last_day(day(0)))))


@pytest.mark.parametrize("mode", MODES)
def test_parts_follow_every_load(spark, tmp_path, mode):
    rng = [(day(7 * i), s, float(i % 13 + 1), 5) for i in range(30) for s in ("A", "B", None)]
    stored = add_features(bars(spark, [*rng, (None, "A", 3.0, 1), (None, "Z", None, 1)]))
    table = Warehouse(spark, str(tmp_path / "table"))
    table.load(stored, mode, day(203))
    batch = stored.filter(F.col("date") >= F.lit(day(150))).withColumn("close", F.lit(2.0))
    for _ in range(2):
        table.load(batch, mode, day(203), allow_partial=True)
        parts, now = table.parts(), table.read()
        assert rows(summary_of_parts(parts)) == rows(symbol_summary(now))
        assert rows(counts_of_parts(parts)) == rows(symbol_counts(now))
        assert rows(run_summary_of_parts(parts, ["A", "C"], day(1))) == rows(run_summary(now, ["A", "C"], day(1)))


def scanned(frame):
    """Rows that the only scan of a plan gives out."""
    plan = frame._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_few_symbols_read_few_pages(spark, tmp_path):
    many = spark.range(10_000 * 20).select(
        F.date_add(F.lit(day(0)), (F.col("id") % 20).cast("int")).alias("date"),
        F.concat(F.lit("S"), F.lpad((F.col("id") / 20).cast("int").cast("string"), 5, "0")).alias("symbol"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1).cast("long").alias("volume"),
    )
    table = Warehouse(spark, str(tmp_path / "table"))
    table.load(add_features(many, unique=True), "upsert_by_key")
    wanted = table.read().filter(F.col("symbol").isin(["S00007", "S05000", "S09999"])).select("symbol", "close")
    assert wanted.count() == 60
    assert 60 <= scanned(wanted) < 0.05 * 200_000


def test_a_batch_reads_the_deliveries_of_its_own_periods(spark, tmp_path):
    """Notes of other periods are neither read nor rewritten, and each period is one load's."""
    table = Warehouse(spark, f"{tmp_path}/table")
    state = PeriodTable(spark, f"{tmp_path}/state/delivered", DELIVERED_SCHEMA, "month")
    for month in range(4):
        write_raw(series(spark, [month + 1.0] * 20).withColumn("date", F.date_add("date", 31 * month)), f"{tmp_path}/raw", day(400 + month))
        load_new_files(table, f"{tmp_path}/raw", f"{tmp_path}/state").awaitTermination()
        assert len(state.periods()) == month + 1 and len(set(state.periods().values())) == month + 1
    held = state.periods()
    read = state.read([min(held)])
    assert len(read.inputFiles()) == 1 and read.count() == 20
    # An older delivery of a key that has come already changes nothing; a newer one does.
    for run, close in ((day(300), 99.0), (day(500), 50.0)):
        write_raw(bars(spark, [(day(3), "A", close, 30_000_000)]), f"{tmp_path}/raw", run)
        load_new_files(table, f"{tmp_path}/raw", f"{tmp_path}/state").awaitTermination()
        kept = table.read().filter(F.col("date") == F.lit(day(3))).first().close
        assert kept == (1.0 if close == 99.0 else 50.0)
    assert {p: load for p, load in state.periods().items() if p != min(held)} == {p: load for p, load in held.items() if p != min(held)}


def test_ticks_of_many_landings(spark, tmp_path):
    ticks = spark.range(500).select(
        F.concat(F.lit("S"), (F.col("id") % 3).cast("string")).alias("s"),
        F.date_add(F.lit(day(0)), (F.col("id") % 40).cast("int")).cast("timestamp_ntz").alias("at"),
        (F.hash("id") % 100).cast("double").alias("price"),
        (F.col("id") % 7).alias("n"),
        F.hash("id").alias("order"),
    )
    args = ("s", "at", "price", F.col("n"), "order")
    stored = PeriodTable(spark, str(tmp_path), bar_state(ticks, *args).schema)
    part = F.pmod(F.hash("order"), F.lit(4))
    for landing in (1, 2, 3, 4):
        new = bar_state(ticks.filter(part == landing - 1), *args)
        assert land_ticks(stored, new, landing)
        assert not land_ticks(stored, new, landing)
    found = stored.read().select("date", "symbol", "open", "high", "low", "close", "volume")
    assert rows(found) == rows(daily_bars(ticks, *args).select(found.columns))
