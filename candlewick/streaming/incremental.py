"""The transform and load steps over raw files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.quality import clean, dedupe
from candlewick.plans.daily import with_stored_history, written
from candlewick.schema import RAW_CSV_SCHEMA
from candlewick.sinks.periods import PeriodTable
from candlewick.sinks.warehouse import Warehouse
from candlewick.sources.files import normalize_raw

LANDED_SCHEMA = T.StructType([*RAW_CSV_SCHEMA.fields, T.StructField("run_date", T.DateType())])


#: The newest run date with which each key has come.
DELIVERED_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()), T.StructField("run_date", T.DateType())]
)


def load_new_files(warehouse: Warehouse, raw_uri: str, state_uri: str) -> StreamingQuery:
    """Load every raw file not seen yet, then stop.

    Of deliveries of a key the one with the newest run date stays, in whatever
    order they land. A micro-batch may be delivered twice after a failure; its upsert gives the
    same table each time. Row frames are not allowed on a stream, so features
    are computed per micro-batch, together with the stored rows; stored rows
    that follow late or corrected ones are brought up to date.
    """
    spark = warehouse.spark
    landed = spark.readStream.schema(LANDED_SCHEMA).option("header", True).csv(raw_uri)
    bars = clean(normalize_raw(landed, "run_date"))
    delivered = PeriodTable(spark, f"{state_uri}/delivered", DELIVERED_SCHEMA, warehouse.period)

    def apply(batch: DataFrame, batch_id: int) -> None:
        folder = f"{state_uri}/batches/{batch_id}"
        arrived = written(dedupe(batch, "run_date"), f"{folder}/arrived")
        periods = delivered.of(arrived)
        if not periods:
            return
        known = delivered.read(periods).select(DELIVERED_SCHEMA.names)
        late = not periods.isdisjoint(delivered.periods())
        latest = written(not_older(arrived, known), f"{folder}/latest") if late else arrived
        # Stored rows may hold a key many times, so keys aren't promised to be unique.
        rows = with_stored_history(latest.drop("run_date"), warehouse, f"{state_uri}/history/{batch_id}", refresh=True)
        # Written once, because the load reads the batch several times.
        warehouse.load(written(rows, f"{folder}/rows"), "upsert_by_key")
        # A repeat of this batch finds its own deliveries, which are not newer than themselves.
        keys = arrived.select(DELIVERED_SCHEMA.names)
        newest = known.unionByName(keys).groupBy("symbol", "date").agg(F.max("run_date").alias("run_date"))
        delivered.replace(newest, periods)

    return (
        bars.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{state_uri}/offsets")
        .trigger(availableNow=True)
        .start()
    )


def not_older(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``batch`` but those whose key is known with a newer run date; a key is known once at most."""
    newest = known.select(F.col("symbol").alias("_symbol"), F.col("date").alias("_date"), F.col("run_date").alias("_newest"))
    newer = (
        F.col("symbol").eqNullSafe(F.col("_symbol"))
        & F.col("date").eqNullSafe(F.col("_date"))
        & (F.col("_newest") > F.col("run_date"))
    )
    return batch.join(newest, newer, "left_anti")
