"""Epoch milliseconds, timestamps and calendar parts, all in the session zone (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest epoch milliseconds a timestamp's microseconds can hold.
MAX_MILLIS = 9223372036854775


def as_timestamp(column: Column) -> Column:
    """A zoned timestamp, which watermarks and epoch functions need, from any timestamp type."""
    return column.cast("timestamp")


def to_millis(column: Column) -> Column:
    """Epoch milliseconds, rounded down."""
    return F.unix_millis(as_timestamp(column))


def from_millis(ms: Column) -> Column:
    """Null for a number too large to be a time, which log files may hold."""
    return F.when(ms.between(-MAX_MILLIS, MAX_MILLIS), F.timestamp_millis(ms))


def day_of_millis(ms: Column) -> Column:
    return F.to_date(from_millis(ms))


def epoch_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` by way of whole epoch seconds."""
    return F.from_unixtime(as_timestamp(moment).cast("long"))


def calendar_parts(moment: Column) -> list[Column]:
    """The year, month and day columns bronze is partitioned by."""
    return [F.year(moment).alias("year"), F.month(moment).alias("month"), F.day(moment).alias("day")]
