"""File writers. Rows are gathered per folder, and a large folder's rows are split over several tasks,
so neither one hot month or day nor many tiny files per folder result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from streambed.functions import moments
from streambed.sources.files import TIME_FORMAT


def overwrite_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_device_logs(logs: DataFrame, folder: str) -> None:
    """JSON lines below year=/month= folders of the event time."""
    event_time = moments.from_millis(F.col("timestamp"))
    dated = logs.withColumns(
        {"year": F.year(event_time), "month": F.lpad(F.month(event_time).cast("string"), 2, "0")}
    )
    dated.hint("rebalance", "year", "month").write.mode("append").partitionBy("year", "month").json(folder)


def write_payments(payments: DataFrame, folder: str, pattern: str = "yyyyMMdd") -> None:
    """Headed CSV, one folder per day (or per the period the date pattern names).

    Days are many and small, so rows are dealt by ranges of day and transaction: every task writes
    neighbouring days, and a day with very many rows is split over tasks.
    """
    tasks = int(payments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dated = payments.withColumn("period", F.date_format("trans_time", pattern))
    (
        dated.repartitionByRange(tasks, "period", "partner_trans_id")
        .write.mode("append")
        .partitionBy("period")
        .options(header=True, timestampFormat=TIME_FORMAT)
        .csv(folder)
    )


def export_mart(df: DataFrame, path: str, fmt: str = "json", mode: str = "append", **options: str) -> int:
    """Write a mart straight from the executors and return its row count.

    An empty result is not written: it neither replaces what is there nor adds an empty file. The mart
    is kept while it is looked at and written, so that it is computed once.
    """
    mart = df.persist()
    try:
        if mart.isEmpty():
            return 0
        rows = Observation("export")
        counted = mart.observe(rows, F.count(F.lit(1)).alias("rows"))
        counted.write.format(fmt).mode(mode).options(**options).save(path)
        return rows.get["rows"]
    finally:
        mart.unpersist()
