"""Change topics to bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from streambed.operators import changelog

PARTITIONS = ("year", "month", "day")
EVERY_TEN_MINUTES = {"processingTime": "10 minutes"}
ALL_AVAILABLE = {"availableNow": True}


def start_bronze(
    raw: DataFrame,
    decode: changelog.Decoder,
    path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append decoded changes below year/month/day of the record time, each exactly once.

    The map is stateless: a late record goes to the folder of its own day.
    """
    writer = (
        changelog.to_bronze(raw, decode)
        .writeStream.format(fmt)
        .outputMode("append")
        .partitionBy(*PARTITIONS)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TEN_MINUTES))
    )
    return (writer.queryName(name) if name else writer).start(path)


def start_quarantine(
    raw: DataFrame,
    decode: changelog.Decoder,
    path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the bytes and the time of the messages that do not decode aside, for repair and replay.

    A stream of its own, so that both outputs are exactly once; the topic is read twice.
    """
    writer = (
        changelog.quarantine(raw, decode)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TEN_MINUTES))
    )
    return (writer.queryName(name) if name else writer).start(path)
