"""Timestamps, calendar parts and cyclic encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text formats of observation times, an offset with or without a colon.
# Texts in neither are read as ISO times: with T or a space, fractional seconds, and in the
# session's zone when they have no offset.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ssXX")

CALENDAR_PARTS = ("hour", "minute", "day", "month", "weekday", "day_of_year")
CYCLIC_PARTS = (
    "hour_sin",
    "hour_cos",
    "day_of_year_sin",
    "day_of_year_cos",
    "month_sin",
    "month_cos",
)


def parse_time(text: Column, formats: tuple[str, ...] = TIME_FORMATS, strict: bool = True) -> Column:
    """Timestamp from text; unparsable text is an error (strict) or null."""
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats], F.try_to_timestamp(text))
    if not strict:
        return parsed
    bad = text.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a timestamp: "), text))).otherwise(parsed)


def ensure_timestamp(
    df: DataFrame, time: str, formats: tuple[str, ...] | None = None, strict: bool = False
) -> DataFrame:
    """Leave temporal columns alone; parse text ones (lenient unless strict)."""
    if isinstance(df.schema[time].dataType, T.DatetimeType):
        return df
    text = F.col(time)
    if formats is None and not strict:
        return df.withColumn(time, F.try_to_timestamp(text))
    return df.withColumn(time, parse_time(text, formats or TIME_FORMATS, strict))


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * F.lit(2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def add_time_features(df: DataFrame, time: str, tz: str | None = None) -> DataFrame:
    """Six calendar parts and six cyclic columns.

    ``tz`` converts zoned timestamps to local wall time first; by default the
    session time zone applies. Monday is weekday 1, Sunday 7.
    """
    df = ensure_timestamp(df, time)
    at = F.col(time)
    if tz is not None and isinstance(df.schema[time].dataType, T.TimestampType):
        at = F.convert_timezone(F.current_timezone(), F.lit(tz), at)
    df = df.withColumns(
        {
            "hour": F.hour(at),
            "minute": F.minute(at),
            "day": F.dayofmonth(at),
            "month": F.month(at),
            "weekday": F.weekday(at) + 1,
            "day_of_year": F.dayofyear(at),
        }
    )
    hour = cyclic(F.col("hour"), 24)
    day = cyclic(F.col("day_of_year"), 365)
    month = cyclic(F.col("month") - 1, 12)
    return df.withColumns(dict(zip(CYCLIC_PARTS, (*hour, *day, *month))))
