"""Distinct devices that roll up: a sketch per day, merged to any longer time.

An exact distinct count over a month needs the month's rows. A HyperLogLog sketch has a fixed size (some
kilobytes), whatever it has seen, and sketches of days merge to the sketch of their month without reading
a log row again. The relative standard error is about 1.04 / sqrt(2 ^ LOG_SIZE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streambed.functions import moments

LOG_SIZE = 12
STANDARD_ERROR = 1.04 / 2 ** (LOG_SIZE / 2)


def daily_devices(logs: DataFrame) -> DataFrame:
    """Events by day and type, and the sketch of their devices; logs without a device count as events only."""
    return logs.groupBy(moments.day_of_millis(F.col("timestamp")).alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.hll_sketch_agg("device_id", LOG_SIZE).alias("devices_sketch")
    )


def rolled_up(daily: DataFrame, unit: str = "month") -> DataFrame:
    """Stored days merged to weeks, months, quarters or years."""
    return (
        daily.groupBy(F.trunc("event_date", unit).alias(unit), "event_type")
        .agg(F.sum("events").alias("events"), F.hll_union_agg("devices_sketch").alias("devices_sketch"))
        .withColumn("devices", F.hll_sketch_estimate("devices_sketch"))
    )


def exact(logs: DataFrame, unit: str = "month") -> DataFrame:
    """The exact count beside it, from the logs."""
    return logs.groupBy(F.trunc(moments.day_of_millis(F.col("timestamp")), unit).alias(unit), "event_type").agg(
        F.count_distinct("device_id").alias("exact_devices")
    )
