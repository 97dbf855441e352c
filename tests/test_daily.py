import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from candlewick.operators.features import features
from candlewick.operators.quality import duplicate_keys
from candlewick.plans.daily import run_day
from candlewick.sinks.files import write_raw
from candlewick.sinks.warehouse import Warehouse
from candlewick.sources.bars import read_vendor
from candlewick.streaming.incremental import load_new_files

HEADER = "Date,Open,High,Low,Close,Volume\n"


@pytest.fixture
def landed(tmp_path):
    for offset, symbol in enumerate(["AAPL", "MSFT"]):
        folder = tmp_path / "vendor" / f"symbol={symbol}"
        folder.mkdir(parents=True)
        lines = [f"{day(i)},{i + 1},{i + 1},{i + 1},{i + 1 + offset * 10},30000000\n" for i in range(12)]
        (folder / "bars.csv").write_text(HEADER + "".join(lines) + f"{day(3)},1,1,1,-1,5\n,1,1,1,1,5\n")
    return tmp_path


def test_one_day(spark, landed):
    table = Warehouse(spark, str(landed / "table"))
    report = run_day(table, str(landed / "vendor"), str(landed / "lake"), day(5))
    assert report.extracted["null_date"] == 2
    assert report.extracted["future_date"] == 12
    assert report.extracted["bad_close"] == 2
    assert report.extracted["kept_rows"] == 10 == report.transformed["rows"]
    assert rows(report.missing) == [("AMZN",), ("GOOGL",)]
    assert tuple(report.run.first()) == (day(5), 10, 2, "AAPL,MSFT", day(1), day(5))
    assert rows(report.summary.select("symbol", "max_close")) == [("AAPL", 6.0), ("MSFT", 16.0)]


def test_running_again_changes_nothing(spark, landed):
    table = Warehouse(spark, str(landed / "table"))
    for number in (5, 6, 6, 5):
        run_day(table, str(landed / "vendor"), str(landed / "lake"), day(number))
    assert duplicate_keys(table.read()).isEmpty()
    assert table.read().count() == 12


def test_a_bad_file_does_not_end_the_run(spark, landed):
    folder = landed / "vendor" / "symbol=AMZN"
    folder.mkdir()
    (folder / "bars.csv").write_text("Date,Price\n2024-01-01,1\n")
    table = Warehouse(spark, str(landed / "table"))
    report = run_day(table, str(landed / "vendor"), str(landed / "lake"), day(5))
    assert table.read().count() == 10 and rows(report.missing) == [("AMZN",), ("GOOGL",)]
    assert [(r.symbol, r.lines, r.reason) for r in report.rejected.collect()] == [("AMZN", 2, "no column Open")]


def test_literal_mode_repeats_rows(spark, landed):
    table = Warehouse(spark, str(landed / "table"))
    for _ in range(2):
        run_day(table, str(landed / "vendor"), str(landed / "lake"), day(5), mode="replace_run_date")
    assert table.read().count() == 18
    assert table.read().filter(F.col("date") == F.lit(day(5))).count() == 2


def test_with_history_the_frame_fills(spark, landed):
    table = Warehouse(spark, str(landed / "table"))
    for number in range(6, 12):
        run_day(table, str(landed / "vendor"), str(landed / "lake"), day(number), sessions=1, use_history=True)
    vendor = read_vendor(spark, str(landed / "vendor"), ["AAPL", "MSFT"])
    since = F.col("date") >= F.lit(day(6))
    assert rows(table.read()) == rows(features(vendor.filter(since), unique=True))


def test_hot_symbols_are_split(spark, landed):
    plain = Warehouse(spark, str(landed / "plain"))
    run_day(plain, str(landed / "vendor"), str(landed / "lake"), day(9), sessions=9)
    split = Warehouse(spark, str(landed / "split"))
    run_day(split, str(landed / "vendor"), str(landed / "lake"), day(9), sessions=9, hot_rows=4)
    assert rows(plain.read()) == rows(split.read())


def test_no_rows_at_all(spark, landed):
    table = Warehouse(spark, str(landed / "table"))
    with pytest.raises(ValueError, match="no data"):
        run_day(table, str(landed / "vendor"), str(landed / "lake"), day(5), symbols=["NONE"])
    assert not table.exists()


def test_new_files_are_loaded_once(spark, landed):
    raw, state = str(landed / "lake"), str(landed / "state")
    table = Warehouse(spark, str(landed / "table"))
    bars = read_vendor(spark, str(landed / "vendor")).filter("close > 0 and date is not null")
    write_raw(bars.filter(F.col("date") <= F.lit(day(6))), raw, day(6))
    load_new_files(table, raw, state).awaitTermination()
    assert table.read().count() == 14
    write_raw(bars.filter(F.col("date") >= F.lit(day(5))), raw, day(11))
    for _ in range(2):
        load_new_files(table, raw, state).awaitTermination()
    assert rows(table.read()) == rows(features(bars, unique=True))
