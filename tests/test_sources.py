import pytest
from helpers import day, rows, series
from pyspark.sql import functions as F

from candlewick.schema import BAR_COLUMNS, BAR_SCHEMA
from candlewick.sinks.files import write_processed, write_raw
from candlewick.sources.bars import daily_bars, normalize_vendor, read_vendor, rejected_files, union_frames, vendor_files
from candlewick.sources.files import read_processed, read_raw, rejected_rows
from candlewick.storage import scratch_folder

HEADER = "Date,Open,High,Low,Close,Volume,Dividends\n"


def vendor(tmp_path, **files):
    for symbol, text in files.items():
        folder = tmp_path / f"symbol={symbol}"
        folder.mkdir()
        (folder / "bars.csv").write_text(text)
    return str(tmp_path)


def test_vendor_files(spark, tmp_path):
    uri = vendor(
        tmp_path,
        AAPL=HEADER + "2024-01-01 00:00:00-05:00,1,2,0.5,1.5,30000000.0,0\n",
        MSFT=HEADER + "2024-01-02 00:00:00-05:00,1,2,0.5,1.5,7,0\n",
        AMZN=HEADER,
    )
    frame = read_vendor(spark, uri, ["AAPL", "MSFT", "AMZN", "GOOGL"])
    assert frame.schema.simpleString() == BAR_SCHEMA.simpleString()
    assert rows(frame) == [
        (day(0), "AAPL", 1.0, 2.0, 0.5, 1.5, 30_000_000),
        (day(1), "MSFT", 1.0, 2.0, 0.5, 1.5, 7),
    ]
    assert rows(read_vendor(spark, uri, ["MSFT"])) == rows(frame)[1:]
    assert read_vendor(spark, uri).count() == 2


def test_vendor_columns_are_found_by_name(spark, tmp_path):
    uri = vendor(tmp_path, A="Volume,Close,Date,Low,High,Open\n9,5,2024-01-01,4,6,3\n")
    assert rows(read_vendor(spark, uri)) == [(day(0), "A", 3.0, 6.0, 4.0, 5.0, 9)]


def test_every_file_by_its_own_header(spark, tmp_path):
    """Column orders, quotes, a byte-order mark, broken files: the rest is read, the broken ones are named."""
    uri = vendor(
        tmp_path,
        A=HEADER + "2024-01-01,1,2,0.5,1.5,7,0\n" + HEADER + "2024-01-02,1,2,0.5,1.5,8,0\n",
        B="\ufeffVolume, close,DATE,Low,High,Open\r\n9,5,2024-01-01,4,6,3\r\n",
        C='"Note, Close","Date","Open","High","Low","Close","Volume"\n"a, b",2024-01-01,1,2,0.5,1.5,7\nshort,2024-01-02\n',
        D="Date,Open,High,Low,Last,Volume\n2024-01-01,1,2,0.5,1.5,7\n2024-01-02,1,2,0.5,1.5,7\n",
        E="Date,Open,High,Low,Close,Close,Volume\n2024-01-01,1,2,0.5,1.5,7,8\n",
        F="\x00\x01\x02 no table at all",
        G="",
        H="Date,Open,High,Low,Close,Volume",
    )
    (tmp_path / "symbol=I").mkdir()
    (tmp_path / "symbol=I" / "bars.csv.gz").write_bytes(b"\x1f\x8b\x08\x00broken")
    assert rows(read_vendor(spark, uri)) == [
        (day(0), "A", 1.0, 2.0, 0.5, 1.5, 7),
        (day(0), "B", 3.0, 6.0, 4.0, 5.0, 9),
        (day(0), "C", 1.0, 2.0, 0.5, 1.5, 7),
        (day(1), "A", 1.0, 2.0, 0.5, 1.5, 8),
        (day(1), "C", None, None, None, None, None),
    ]
    rejected = {(r.symbol, r.reason, r.lines) for r in rejected_files(spark, uri).collect()}
    assert rejected == {
        ("D", "no column Close", 3),
        ("E", "several columns Close", 2),
        ("F", "no column Date", 1),
        ("I", "no line could be read", 0),
    }
    assert [r.path.rsplit("/", 2)[1] for r in rejected_files(spark, uri, ["A", "D"]).collect()] == ["symbol=D"]
    assert read_vendor(spark, uri, ["D", "F", "none"]).collect() == []


def test_headers_of_files_in_many_splits(spark, tmp_path):
    """A file cut into splits keeps one header; equal files need no join."""
    text = "".join(f"{day(i)},{i + 1},{i + 1},{i + 1},{i + 1},7\n" for i in range(2000))
    uri = vendor(tmp_path, A="Date,Open,High,Low,Close,Volume\n" + text, B="Date,Open,High,Low,Close,Volume\n" + text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert {(r.symbol, r.lines, r.reason) for r in vendor_files(spark, uri).collect()} == {("A", 2001, None), ("B", 2001, None)}
        frame = read_vendor(spark, uri)
        assert frame.rdd.getNumPartitions() > 10
        assert frame.groupBy("symbol").agg(F.sum("close").alias("n")).collect() == [("A", 2001000.0), ("B", 2001000.0)]
        frame.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_malformed_vendor_fields_become_null(spark, tmp_path):
    text = HEADER + "garbage,1,2,0.5,1.5,7,0\n2024-01-01,x,nan,0.5,oops,12,0\n2024-01-02,1,2,0.5,1.5,7,0\n"
    found = rows(read_vendor(spark, vendor(tmp_path, A=text)))
    assert (day(1), "A", 1.0, 2.0, 0.5, 1.5, 7) in found
    assert (day(0), "A", None, None, 0.5, None, 12) in found
    assert (None, "A", 1.0, 2.0, 0.5, 1.5, 7) in found


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_other_vendor_formats(spark, tmp_path, fmt):
    frame = spark.createDataFrame(
        [("2024-01-01", 1.0, 2.0, 0.5, 1.5, 7, "A")],
        "Date string, Open double, High double, Low double, Close double, Volume long, symbol string",
    )
    frame.write.format(fmt).partitionBy("symbol").save(str(tmp_path / fmt))
    assert rows(read_vendor(spark, str(tmp_path / fmt), fmt=fmt)) == [
        (day(0), "A", 1.0, 2.0, 0.5, 1.5, 7)
    ]


def test_constant_symbol(spark):
    frame = spark.createDataFrame(
        [("2024-01-01", 1.0, 2.0, 0.5, 1.5, 7)],
        "Date string, Open double, High double, Low double, Close double, Volume long",
    )
    assert normalize_vendor(frame, symbol="A").first().symbol == "A"


def test_daily_bars(spark):
    ticks = spark.createDataFrame(
        [("A", "2024-01-01 10:00:00", 5.0, 2, 1), ("A", "2024-01-01 09:00:00", 9.0, 1, 3), ("A", "2024-01-02 09:00:00", 1.0, 4, 1)],
        "s string, at string, price double, n long, id long",
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    out = daily_bars(ticks, "s", "at", "price", F.col("n"), "id", first_order="k")
    assert rows(out) == [(day(0), "A", 5.0, 9.0, 5.0, 9.0, 3, 1), (day(1), "A", 1.0, 1.0, 1.0, 1.0, 4, 1)]


def test_union_by_name(spark):
    frame = series(spark, [1, 2])
    shuffled = series(spark, [3], symbol="B").select(*reversed(BAR_COLUMNS))
    empty = frame.limit(0)
    expected = rows(frame) + rows(shuffled.select(BAR_COLUMNS))
    assert rows(union_frames([frame, shuffled, empty])) == sorted(expected, key=str)


def test_raw_zone(spark, tmp_path):
    uri = str(tmp_path)
    write_raw(series(spark, [1, 2]), uri, day(1))
    write_raw(series(spark, [3, 4]), uri, day(2))
    write_raw(series(spark, [5]), uri, day(2))  # a re-run replaces its own day
    assert read_raw(spark, uri).count() == 3
    one_day = read_raw(spark, uri, day(2))
    assert rows(one_day) == rows(series(spark, [5]))
    assert "PartitionFilters: [isnotnull(run_date" in one_day._jdf.queryExecution().toString()
    assert rows(read_raw(spark, uri, infer=True)) == rows(read_raw(spark, uri))


def test_raw_text_rules(spark, tmp_path):
    folder = tmp_path / "run_date=2024-01-01"
    folder.mkdir()
    (folder / "part.csv").write_text(
        "date,symbol,open,high,low,close,volume\n"
        "2024-01-01,A,1,1,1,1,30000000.0\n"
        "2024-01-02,A,,1,1,nan,\n"
        "2024-01-03,A,1,1,1,one,5\n"
    )
    found = {r.date: r for r in read_raw(spark, str(tmp_path)).collect()}
    assert found[day(0)].volume == 30_000_000
    assert (found[day(1)].open, found[day(1)].volume) == (None, None)
    assert found[day(2)].close is None
    rejected = rejected_rows(spark, str(tmp_path))
    assert "one" in [r._corrupt_record for r in rejected.collect() if r.date == day(2)][0]
    assert rejected.count() == len(rejected.collect())


def test_only_parquet_names_are_read(spark, tmp_path):
    folder = write_processed(series(spark, [1, 2]), str(tmp_path), day(1))
    (tmp_path / "run_date=2024-01-02" / "notes.txt").write_text("not parquet")
    assert folder.endswith("run_date=2024-01-02")
    write_processed(series(spark, [1, 2]), str(tmp_path), day(3))
    assert rows(read_processed(spark, str(tmp_path), day(3))) == rows(series(spark, [1, 2]))
    assert read_processed(spark, str(tmp_path)).count() == 4


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark).startswith(shared)
    assert scratch_folder(spark) != scratch_folder(spark)
