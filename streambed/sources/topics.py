"""Change topics as streaming DataFrames with ``value`` and ``timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

def kafka_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    """Read from the earliest offset and go on when the broker has dropped data."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """Subscribe to one topic; needs the Kafka package on the session."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_offsets))
    return reader.load().select("value", "timestamp")


def as_glob(path: str) -> str:
    """A pattern that matches the path alone. The file stream lists a pattern's matches, so the
    table may be one file or a folder of files."""
    return f"{path[:-1]}[{path[-1]}]"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A Parquet table as a stream: its files in the order they arrived."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
