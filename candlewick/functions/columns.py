"""Column expressions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.schema import HIGH_VOLUME, MEDIUM_VOLUME


def rounded(value: Column, scale: int = 2) -> Column:
    """Round half up on the decimal text of the value."""
    return F.round(value, scale)


def percent_change(value: Column, previous: Column) -> Column:
    """Change from ``previous`` in percent; null on a null or zero base."""
    return rounded(F.try_divide(value - previous, previous) * 100)


def volume_category(
    volume: Column, high: int = HIGH_VOLUME, medium: int = MEDIUM_VOLUME
) -> Column:
    """HIGH above ``high``, MEDIUM above ``medium``, LOW otherwise (also for null)."""
    whole = volume.cast("long")
    return F.when(whole > high, "HIGH").when(whole > medium, "MEDIUM").otherwise("LOW")


def number_or_null(value: Column) -> Column:
    """NaN becomes null: ``NaN > 0`` holds in Spark, so NaN must not reach a filter."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def is_missing(name: str, dtype: str) -> Column:
    column = F.col(name)
    if dtype in ("double", "float"):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def session_date(instant: Column, dtype: str, exchange_tz: str | None = None) -> Column:
    """Exchange-local calendar date; null for malformed text.

    Without ``exchange_tz`` the date is taken as written (vendor text gives
    exchange time, with or without an offset). With it, zoned instants are moved
    to that zone; dates and local timestamps already are in exchange time.
    """
    if exchange_tz and dtype in ("timestamp", "string"):
        zoned = instant.try_cast("timestamp")
        return F.to_date(F.convert_timezone(None, F.lit(exchange_tz), zoned))
    if dtype == "string":
        return F.substring(instant, 1, 10).try_cast("date")
    return F.to_date(instant)


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")
