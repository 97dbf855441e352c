"""Daily bars from landed vendor files or from ticks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.columns import number_or_null, session_date
from candlewick.schema import BAR_COLUMNS, VENDOR_COLUMNS, VENDOR_TEXT_SCHEMA
from candlewick.sinks.periods import PeriodTable
from candlewick.storage import scratch_folder


def read_vendor(
    spark: SparkSession,
    uri: str,
    symbols: Sequence[str] | None = None,
    fmt: str = "csv",
    exchange_tz: str | None = None,
) -> DataFrame:
    """Bars of every ``<uri>/symbol=<symbol>/`` folder, in one scan.

    Asking for ``symbols`` prunes the folders; a symbol without a folder or
    without rows adds nothing (see ``missing_symbols`` for the report).
    Malformed fields become null and fall to ``validate``. Each CSV file's own
    header tells where its columns are; a file without the needed ones adds
    nothing (see ``rejected_files``) and the others are read all the same.
    """
    if fmt == "csv":
        return normalize_vendor(_vendor_rows(spark, uri, symbols), exchange_tz=exchange_tz)
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        # Columns are found by name; the folder's name is text, whatever it looks like.
        folder = T.StructField("symbol", T.StringType())
        names = [f for f in reader.load(uri).schema.fields if f.name != "symbol"]
        reader = reader.schema(T.StructType([*names, folder]))
    elif fmt == "json":
        reader = reader.schema(VENDOR_TEXT_SCHEMA)
    frame = _asked(reader.load(uri), symbols)
    return normalize_vendor(frame, exchange_tz=exchange_tz)


def vendor_files(spark: SparkSession, uri: str, symbols: Sequence[str] | None = None) -> DataFrame:
    """One row per CSV file: path, symbol, header, lines (the header's included) and reason.

    ``reason`` is null for files that can be read: every needed column stands
    once in the header, in any order and case. Otherwise it names the first
    column that does not, or says that no line could be read. Empty files have
    no row. One pass over the text; a row per file and task is shuffled.
    """
    first = F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id())
    lines = _lines(spark, uri, symbols).select("value", "symbol", F.col("_metadata.file_path").alias("path"), first.alias("_at"))
    files = lines.groupBy("path", "symbol").agg(F.min_by(F.left("value", F.lit(HEADER_CHARS)), "_at").alias("header"), F.count(F.lit(1)).alias("lines"))
    names = _names(F.col("header"))
    reason = F.lit(None).cast("string")
    for name in reversed(VENDOR_COLUMNS):
        times = F.size(names) - F.size(F.array_remove(names, name.lower()))
        reason = F.when(times == 0, f"no column {name}").when(times > 1, f"several columns {name}").otherwise(reason)
    files = files.withColumn("reason", reason)
    listed = _asked(spark.read.format("binaryFile").schema(_FILE_SCHEMA).load(uri), symbols)
    # The listing writes file:/ and hdfs:/ paths with one slash or three; the part after the scheme is the same.
    tail = lambda path: F.regexp_replace(path, "^[a-z0-9+.-]+:/+", "")
    silent = listed.filter("length > 0").join(files.select(tail(F.col("path")).alias("_seen")), tail(F.col("path")) == F.col("_seen"), "left_anti")
    return files.unionByName(
        silent.select("path", "symbol", F.lit(None).cast("string").alias("header"), F.lit(0).cast("long").alias("lines"), F.lit("no line could be read").alias("reason"))
    )


def rejected_files(spark: SparkSession, uri: str, symbols: Sequence[str] | None = None) -> DataFrame:
    """The CSV files that ``read_vendor`` leaves out, with the reason and the number of their lines."""
    return vendor_files(spark, uri, symbols).filter(F.col("reason").isNotNull())


#: Longer first lines are no headers.
HEADER_CHARS = 65_536
QUOTED_COMMA = ',(?=[^"]*"(?:[^"]*"[^"]*")*[^"]*$)'
_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("symbol", T.StringType()),
    ]
)


def _asked(frame: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    return frame if symbols is None else frame.filter(F.col("symbol").isin(list(symbols)))


def _lines(spark: SparkSession, uri: str, symbols: Sequence[str] | None) -> DataFrame:
    """Lines of all files; unreadable and vanished files end early instead of failing the read."""
    reader = spark.read.schema("value string, symbol string").options(ignoreCorruptFiles=True, ignoreMissingFiles=True)
    return _asked(reader.text(uri), symbols)


def _names(header: Column) -> Column:
    """Column names in lower case, without byte-order mark, quotes and outer spaces."""
    whole = F.regexp_replace(header, QUOTED_COMMA, " ")
    plain = F.lower(F.regexp_replace(whole, "[\ufeff\"\r]", ""))
    return F.transform(F.split(plain, ","), lambda name: F.trim(name))


def _vendor_rows(spark: SparkSession, uri: str, symbols: Sequence[str] | None) -> DataFrame:
    """The needed fields of all lines as text, by each file's own header.

    The most common header is a constant of the plan. Only files with another
    one, or without the needed columns, are joined by their path, so that the
    join is small where files are alike and empty where they are the same;
    adaptive execution broadcasts it if it is small and splits large files if not.
    """
    files = vendor_files(spark, uri, symbols)
    names = _names(F.col("header"))
    places = F.array(*[F.array_position(names, name.lower()).cast("int") - 1 for name in VENDOR_COLUMNS])
    files = files.withColumns({"_width": F.size(names), "_places": places})
    folder = scratch_folder(spark)
    files.write.parquet(folder)  # a row per file; the text is not read for it again
    files = spark.read.schema(files.schema).parquet(folder)
    good = files.filter(F.col("reason").isNull())
    usual = good.groupBy("header", "_places").count().orderBy(F.desc("count"), "header").first()
    if usual is None:
        return spark.createDataFrame([], VENDOR_TEXT_SCHEMA)
    width = good.agg(F.max("_width")).first()[0]
    others = files.filter(~F.col("header").eqNullSafe(F.lit(usual.header))).select(
        F.col("path").alias("_path"), F.col("header").alias("_header"), "_places", "reason"
    )
    lines = _lines(spark, uri, symbols).select("*", F.col("_metadata.file_path").alias("path"))
    lines = lines.join(others, F.col("path") == F.col("_path"), "left").filter(F.col("reason").isNull())
    # A line like the header, the header itself among them, is no bar.
    lines = lines.filter(F.col("value") != F.coalesce("_header", F.lit(usual.header)))
    fields = F.from_csv("value", F.lit(", ".join(f"c{i} string" for i in range(width))))
    parsed = lines.select("symbol", "_places", F.array(*[fields[f"c{i}"] for i in range(width)]).alias("_fields"))
    place = lambda i: F.coalesce(F.get("_places", F.lit(i)), F.lit(usual._places[i]))
    return parsed.select(*[F.get("_fields", place(i)).alias(name) for i, name in enumerate(VENDOR_COLUMNS)], "symbol")


def normalize_vendor(
    frame: DataFrame, symbol: str | None = None, exchange_tz: str | None = None
) -> DataFrame:
    """Vendor columns (``Date, Open, …``) to ``BAR_COLUMNS``; other columns are dropped.

    ``symbol`` sets the constant for a frame of one symbol; without it the
    frame must carry a ``symbol`` column.
    """
    dates = dict(frame.dtypes)["Date"]
    prices = [number_or_null(F.col(name)).alias(name.lower()) for name in ("Open", "High", "Low", "Close")]
    return frame.select(
        session_date(F.col("Date"), dates, exchange_tz).alias("date"),
        F.lit(symbol).alias("symbol") if symbol is not None else F.col("symbol"),
        *prices,
        whole_volume(F.col("Volume")).alias("volume"),
    )


def whole_volume(volume: Column) -> Column:
    return number_or_null(volume).try_cast("long")


def daily_bars(
    ticks: DataFrame,
    symbol: str,
    at: str,
    price: str,
    volume: Column,
    order: str,
    first_order: str | None = None,
) -> DataFrame:
    """One bar per symbol and calendar day.

    Open and close are the prices at the smallest and largest ``order`` of the
    day, which must not repeat within a bar. Every aggregate is combined map-side, so a hot symbol or day shuffles
    one row per map task and key. ``first_order`` names an extra column holding
    the smallest ``order`` of the bar.
    """
    extra = [F.min(order).alias(first_order)] if first_order else []
    return (
        ticks.groupBy(F.to_date(at).alias("date"), F.col(symbol).alias("symbol"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum(volume).alias("volume"),
            *extra,
        )
    )


def bar_state(ticks: DataFrame, symbol: str, at: str, price: str, volume: Column, order: str) -> DataFrame:
    """``daily_bars`` with the orders of open and close, so that bars of different ticks can be merged."""
    return ticks.groupBy(F.to_date(at).alias("date"), F.col(symbol).alias("symbol")).agg(
        F.min_by(price, order).alias("open"),
        F.min(order).alias("open_order"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.max(order).alias("close_order"),
        F.sum(volume).alias("volume"),
    )


def merge_bars(states: DataFrame) -> DataFrame:
    """One state per symbol and day, from any number of them over different ticks, in any order."""
    return states.groupBy("date", "symbol").agg(
        F.min_by("open", "open_order").alias("open"),
        F.min("open_order").alias("open_order"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "close_order").alias("close"),
        F.max("close_order").alias("close_order"),
        F.sum("volume").alias("volume"),
    )


def land_ticks(stored: PeriodTable, states: DataFrame, landing: int) -> bool:
    """Merge the bars of new ticks into the stored ones; False if this landing is in them already.

    ``stored`` has the columns of ``bar_state``. Landings are numbered from 1 in
    their order; one that was committed is not added again, so a repeat after a
    failure changes nothing. Only the periods of the new ticks are read and
    rewritten, a row per symbol and day, however many ticks they were made of.
    """
    if landing <= stored.landing():
        return False
    states = states.select(stored.schema.names)
    touched = stored.of(states)
    known = stored.read(touched).select(stored.schema.names)
    stored.replace(merge_bars(known.unionByName(states)), touched, landing)
    return True


def union_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, [frame.select(BAR_COLUMNS) for frame in frames])
