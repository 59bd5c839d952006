"""Lake tables: Parquet by default, Delta where its package is on the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class MissingTable(RuntimeError):
    """A table the job cannot do without is not there."""


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whatever store it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = hadoop_path(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    target, fs = hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path holds anything but hidden files."""
    return any(not name.startswith(("_", ".")) for name in child_names(spark, path))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def read_required(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if not table_exists(spark, path):
        raise MissingTable(path)
    return read_table(spark, path, fmt)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table, or no rows with its declared columns where it does not exist yet."""
    if table_exists(spark, path):
        return read_table(spark, path, fmt)
    return spark.createDataFrame([], schema)


def read_since(bronze: DataFrame, year: int, month: int, day: int) -> DataFrame:
    """Bronze rows of the date partitions from the given day on; older folders are not opened."""
    from pyspark.sql import functions as F

    return bronze.where(
        (F.col("year") > year)
        | ((F.col("year") == year) & (F.col("month") > month))
        | ((F.col("year") == year) & (F.col("month") == month) & (F.col("day") >= day))
    )


def inspect(df: DataFrame, columns: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of the named columns, in a repeatable order."""
    return df.select(*columns).orderBy(*order).limit(n)
