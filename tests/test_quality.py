import datetime as dt

import pytest
from helpers import bars, day, rows, series

from candlewick.operators import report
from candlewick.operators.quality import (
    clean,
    dedupe,
    duplicate_keys,
    missing_symbols,
    removal_counts,
    require_rows,
    validate,
)
from candlewick.schema import BAR_SCHEMA

NAN = float("nan")
RUN = day(5)
CASES = {
    "valid": (day(1), "A", 5.0, 9),
    "run date": (RUN, "A", 5.0, 9),
    "tomorrow": (day(6), "A", 5.0, 9),
    "null symbol": (day(1), None, 5.0, 9),
    "null close": (day(1), "A", None, 9),
    "nan close": (day(1), "A", NAN, 9),
    "zero close": (day(1), "A", 0.0, 9),
    "negative close": (day(1), "A", -1.0, 9),
    "null volume": (day(1), "A", 5.0, None),
    "zero volume": (day(1), "A", 5.0, 0),
    "negative volume": (day(1), "A", 5.0, -1),
    "null date": (None, "A", 5.0, 9),
}


@pytest.mark.parametrize("case", CASES)
def test_cleaning_rules(spark, case):
    frame = bars(spark, [CASES[case]])
    cleaned, validated = clean(frame).count(), validate(frame, RUN).count()
    assert cleaned == (case in {"valid", "run date", "tomorrow", "null symbol"})
    assert validated == (case in {"valid", "run date", "null symbol"})


def test_open_high_low_may_be_missing(spark):
    frame = spark.createDataFrame([(day(1), "A", None, None, NAN, 5.0, 9)], BAR_SCHEMA)
    assert validate(frame, RUN).count() == 1


def test_clean_twice_is_clean_once(spark):
    frame = bars(spark, list(CASES.values()))
    assert rows(clean(clean(frame))) == rows(clean(frame))


def test_removal_counts(spark):
    counts = removal_counts(bars(spark, list(CASES.values())), RUN).first().asDict()
    assert counts == {
        "total_rows": 12,
        "null_date": 1,
        "null_close": 2,
        "null_volume": 1,
        "bad_close": 2,
        "bad_volume": 2,
        "future_date": 1,
        "removed_rows": 9,
        "kept_rows": 3,
    }
    assert counts["kept_rows"] == validate(bars(spark, list(CASES.values())), RUN).count()


def test_missing_symbols(spark):
    out = missing_symbols(series(spark, [1], symbol="AAPL"), ["AAPL", "MSFT"])
    assert rows(out) == [("MSFT",)]
    assert missing_symbols(series(spark, [1]).limit(0), ["AAPL", "MSFT"]).count() == 2


def test_duplicates_and_dedupe(spark):
    frame = bars(spark, [(day(0), "A", 1.0, 1), (day(0), "A", 2.0, 2), (day(1), "A", 3.0, 3)])
    assert rows(duplicate_keys(frame)) == [("A", day(0), 2)]
    kept = dedupe(frame, latest_by="volume")
    assert rows(kept.select("date", "close")) == [(day(0), 2.0), (day(1), 3.0)]
    assert duplicate_keys(kept).isEmpty()


def test_dedupe_of_equal_deliveries_is_the_same_for_any_partitioning(spark):
    frame = bars(spark, [(day(0), "A", float(i), 1) for i in range(50)])
    assert rows(dedupe(frame, "volume")) == rows(dedupe(frame.repartition(11), "volume"))


def test_nothing_read_is_an_error(spark):
    frame = series(spark, [1])
    assert require_rows(frame) is frame
    with pytest.raises(ValueError, match="no data"):
        require_rows(frame.limit(0))


def test_reports(spark):
    frame = series(spark, [1, 2, 4]).unionByName(series(spark, [3], symbol="B"))
    assert rows(report.row_count(frame)) == [(4,)]
    assert rows(report.symbol_counts(frame)) == [("A", 3), ("B", 1)]
    assert [tuple(r) for r in report.symbol_summary(frame).collect()] == [
        ("A", 4.0, 1.0, 2.33),
        ("B", 3.0, 3.0, 3.0),
    ]
    assert rows(report.distinct_symbols(frame)) == [("A",), ("B",)]
    assert [r.close for r in report.preview(frame, 2).collect()] == [1.0, 2.0]
    assert (frame.count(), len(frame.columns)) == (4, 7)


def test_run_summary_lists_only_the_universe(spark):
    frame = series(spark, [1, 2, 4]).unionByName(series(spark, [3], symbol="B"))
    out = report.run_summary(frame, ["B", "C"], RUN).first()
    assert tuple(out) == (RUN, 4, 2, "B", day(0), day(2))
    empty = report.run_summary(frame.limit(0), ["B"], dt.date(2024, 1, 1)).first()
    assert (empty.total_rows, empty.symbol_count, empty.symbols) == (0, 0, "")
