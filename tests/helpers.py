import datetime as dt

from candlewick.schema import BAR_SCHEMA

START = dt.date(2024, 1, 1)


def day(number):
    return START + dt.timedelta(days=number)


def bars(spark, rows):
    """Rows of (date, symbol, close, volume); open, high and low repeat the close."""
    return spark.createDataFrame([(d, s, c, c, c, c, v) for d, s, c, v in rows], BAR_SCHEMA)


def series(spark, closes, symbol="A", gap=1):
    return bars(spark, [(day(i * gap), symbol, float(c), 30_000_000) for i, c in enumerate(closes)])


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
