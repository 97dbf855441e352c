"""Column lists and declared schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# The default symbol universe, the category thresholds, the
# length of the moving-average frame and the look-back in sessions.
UNIVERSE = ("AAPL", "GOOGL", "AMZN", "MSFT")
HIGH_VOLUME = 50_000_000
MEDIUM_VOLUME = 20_000_000
AVERAGE_ROWS = 7
LOOKBACK_SESSIONS = 5

KEYS = ["symbol", "date"]
BAR_COLUMNS = ["date", "symbol", "open", "high", "low", "close", "volume"]
FEATURE_COLUMNS = [*BAR_COLUMNS, "price_change_pct", "moving_avg_7d", "volume_category"]

BAR_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

# Text files may hold a volume as "30000000.0", which a long column would
# reject, so it is read as a double and cast afterwards.
RAW_CSV_SCHEMA = T.StructType(
    [*BAR_SCHEMA.fields[:6], T.StructField("volume", T.DoubleType())]
)

# Vendor fields as text; they are cast by name, malformed ones to null.
VENDOR_COLUMNS = ["Date", "Open", "High", "Low", "Close", "Volume"]
VENDOR_TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in (*VENDOR_COLUMNS, "symbol")])

FEATURE_SCHEMA = T.StructType(
    [
        *BAR_SCHEMA.fields,
        T.StructField("price_change_pct", T.DoubleType()),
        T.StructField("moving_avg_7d", T.DoubleType()),
        T.StructField("volume_category", T.StringType()),
    ]
)
