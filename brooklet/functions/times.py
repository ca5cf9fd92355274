"""Time expressions. The session time zone decides the day; sessions here use UTC."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def micros(time: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without time zone."""
    return F.unix_micros(time.cast("timestamp"))


def span_micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def span(length: timedelta) -> Column:
    """A day-time interval literal, also negative."""
    return F.lit(length)


def day(time: Column) -> Column:
    return F.to_date(time)


def text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def from_text(value: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as a timestamp, null when malformed."""
    return F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm:ss"))


def from_millis(value: Column) -> Column:
    return F.timestamp_millis(value)


def order_time_columns(create_time: Column) -> dict[str, Column]:
    """``create_date``, ``create_hour`` and ``create_ts`` (epoch ms) of a creation time."""
    return {
        "create_date": F.date_format(create_time, "yyyy-MM-dd"),
        "create_hour": F.date_format(create_time, "HH"),
        "create_ts": F.unix_millis(create_time.cast("timestamp")),
    }


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365 days between two dates."""
    return F.floor(F.datediff(as_of, birthday) / F.lit(365)).cast("int")
