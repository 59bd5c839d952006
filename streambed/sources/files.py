"""Scans of the log and payment folders, with declared schemas.

A record that does not fit its schema is kept as text in ``CORRUPT``; ``accepted`` and ``rejected``
tell the two kinds apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed import schemas

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CORRUPT = "_corrupt"


def _marked(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def scan_device_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Newline JSON below ``year=/month=`` folders; the folder names become columns."""
    return spark.read.schema(_marked(schemas.DEVICE_LOGS)).option("columnNameOfCorruptRecord", CORRUPT).json(folder)


def scan_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Headed CSV files."""
    return (
        spark.read.schema(_marked(schemas.PAYMENTS))
        .options(header=True, timestampFormat=TIME_FORMAT, columnNameOfCorruptRecord=CORRUPT)
        .csv(folder)
    )


def accepted(scanned: DataFrame) -> DataFrame:
    """The records that fit their schema."""
    return scanned.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(scanned: DataFrame) -> DataFrame:
    """The records that do not, with what could be read of them and their text."""
    return scanned.where(F.col(CORRUPT).isNotNull())
