"""The file path as a running job: log and payment files to fact tables as they arrive.

Files are read once each, in the order they arrive, and moved to an archive where one is named. Every
micro-batch gives accepted and rejected records. Accepted ones are appended below their date if the
fact table does not have their key yet, so a file that comes twice, a batch that is run again and a
record that is in two files add nothing; a late file goes to its own dates. Rejected records go to a
folder per batch, which a repeated batch writes over.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streambed import schemas
from streambed.plans import facts
from streambed.sources import files, lake
from streambed.streaming.bronze import EVERY_TEN_MINUTES


@dataclass(frozen=True)
class FilePath:
    """A kind of source file, the fact rows it becomes, their key and the date they lie under."""

    name: str
    fmt: str
    schema: T.StructType
    to_fact: Callable[[DataFrame], DataFrame]
    key: str
    date: str
    options: tuple[tuple[str, str], ...] = ()


LOGS = FilePath(
    "device_logs",
    "json",
    T.StructType(schemas.DEVICE_LOGS.fields + schemas.columns("year INT, month INT").fields),
    lambda logs: facts.device_logs_fact(logs.drop("year", "month")),
    "event_id",
    "event_date",
)
PAYMENTS = FilePath(
    "payments",
    "csv",
    schemas.PAYMENTS,
    facts.payment_fact,
    "partner_trans_id",
    "trans_date",
    (("header", "true"), ("timestampFormat", files.TIME_FORMAT)),
)


def arriving(
    spark: SparkSession, path: FilePath, folder: str, archive: str | None = None, max_files: int | None = None
) -> DataFrame:
    """The files of a folder as a stream of records, broken ones marked, with the file they are from."""
    reader = (
        spark.readStream.schema(T.StructType([*path.schema.fields, T.StructField(files.CORRUPT, T.StringType())]))
        .option("columnNameOfCorruptRecord", files.CORRUPT)
        .options(**dict(path.options))
    )
    if archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(path.fmt).load(folder).withColumn("_file", F.col("_metadata.file_path"))


def new_facts(batch: DataFrame, stored: DataFrame | None, path: FilePath) -> DataFrame:
    """The batch's fact rows whose key neither the stored facts nor an earlier row of the batch has.

    Only the dates of the batch are looked at in the stored facts: a record's key has one date.
    Rows without a key have nothing to be known by and all stay.
    """
    rows = path.to_fact(batch)
    keyed = rows.where(F.col(path.key).isNotNull())
    others = [c for c in rows.columns if c != path.key]
    first = F.min_by(F.struct(*others), F.struct(path.date, F.xxhash64(*others))).alias("_row")
    once = keyed.groupBy(path.key).agg(first).select(path.key, "_row.*").select(*rows.columns)
    if stored is not None:
        dates = once.select(path.date).distinct()
        known = stored.join(dates, path.date, "left_semi").select(path.key)
        once = once.join(known, path.key, "left_anti").select(*rows.columns)
    return once.unionByName(rows.where(F.col(path.key).isNull()))


def start_files(
    stream: DataFrame,
    path: FilePath,
    facts_path: str,
    rejected_path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append what arrives to the fact table below its dates, and what does not fit to ``rejected_path``."""

    def take_in(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist()
        try:
            stored = read_facts(spark, path, facts_path) if lake.table_exists(spark, facts_path) else None
            fresh = new_facts(files.accepted(kept).drop("_file"), stored, path)
            fresh.hint("rebalance", path.date).write.mode("append").partitionBy(path.date).parquet(facts_path)
            # A CSV record of other width is rejected whole; its columns hold nothing to be trusted.
            aside = files.rejected(kept).select("_file", F.col(files.CORRUPT).alias("record"))
            aside.write.mode("overwrite").parquet(f"{rejected_path}/batch={number}")
        finally:
            kept.unpersist()

    writer = stream.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or EVERY_TEN_MINUTES))
    return (writer.queryName(name) if name else writer).start()


def fact_schema(spark: SparkSession, path: FilePath) -> T.StructType:
    return path.to_fact(spark.createDataFrame([], path.schema)).schema


def read_facts(spark: SparkSession, path: FilePath, facts_path: str) -> DataFrame:
    """The stored facts; a filter on the date opens its folders only."""
    return spark.read.schema(fact_schema(spark, path)).parquet(facts_path)
