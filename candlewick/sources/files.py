"""Readers for the raw (CSV) and processed (Parquet) zones.

Any Hadoop URI works (``s3a://…``, ``hdfs://…``, a local path); credentials
belong in the session's Hadoop configuration, not in code.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.columns import number_or_null
from candlewick.schema import RAW_CSV_SCHEMA
from candlewick.sources.bars import whole_volume

CORRUPT = "_corrupt_record"


def read_raw(
    spark: SparkSession, uri: str, run_date: dt.date | None = None, infer: bool = False
) -> DataFrame:
    """Bars of the raw zone; ``run_date`` prunes to one landing folder.

    The schema is declared. ``infer=True`` costs an extra pass over the text
    and its types depend on the data, so the result is cast all the same.
    """
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if infer else reader.schema(RAW_CSV_SCHEMA)
    frame = reader.csv(uri)
    if run_date is not None:
        frame = frame.filter(F.col("run_date") == F.lit(run_date))
    return normalize_raw(frame)


def normalize_raw(frame: DataFrame, *more: str) -> DataFrame:
    """Landed columns with their types, and ``more`` as they are; what has no value of its type is null, NaN too."""
    return frame.select(
        F.col("date").try_cast("date").alias("date"),
        F.col("symbol").cast("string").alias("symbol"),
        *[number_or_null(F.col(name)).alias(name) for name in ("open", "high", "low", "close")],
        whole_volume(F.col("volume")).alias("volume"),
        *more,
    )


def rejected_rows(spark: SparkSession, uri: str) -> DataFrame:
    """Raw lines that do not fit the declared schema."""
    schema = T.StructType([*RAW_CSV_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    options = dict(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    # Always true. The CSV reader parses only the columns a query uses; this uses
    # all of them, so that a bad value in any column counts, also under count().
    every_column = F.length(F.concat_ws("", *RAW_CSV_SCHEMA.names)) >= 0
    frame = spark.read.schema(schema).options(**options).csv(uri)
    return frame.filter(F.col(CORRUPT).isNotNull() & every_column)


def read_processed(spark: SparkSession, uri: str, run_date: dt.date | None = None) -> DataFrame:
    """Parquet rows under ``uri``; files with another suffix are skipped."""
    frame = spark.read.option("pathGlobFilter", "*.parquet").parquet(uri)
    if run_date is not None:
        frame = frame.filter(F.col("run_date") == F.lit(run_date))
    return frame.drop("run_date")
