"""Silver tables on Parquet, as numbered snapshots below ``snapshots/``.

A merge reads the newest finished snapshot and writes the merged rows once, as the next one. Spark's
own ``_SUCCESS`` file finishes a snapshot, so readers see a whole merge or none of it, and what a
stopped job left behind is never read. The snapshot before the newest is kept for readers that have
begun on it; older ones are removed.

Nothing remembers which batches were merged: a change carries its position, and one that is not newer
than the stored row changes nothing. Batches may so be replayed, repeated or come from a stream that
was started anew.

Every merge writes the whole table: right where a batch touches most of it. ``change_table`` has the
tables whose merges cost what changed; the functions here take either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from streambed.operators import silver
from streambed.sinks import change_table
from streambed.sinks.change_table import ChangeTable
from streambed.sources import lake


@dataclass(frozen=True)
class SilverTable:
    path: str
    row_schema: T.StructType
    pk: str = "id"

    @property
    def schema(self) -> T.StructType:
        return silver.silver_schema(self.row_schema)

    def snapshot(self, number: int) -> str:
        return f"{self.path}/snapshots/{number:012d}"


def _numbers(spark: SparkSession, table: SilverTable) -> list[int]:
    return [int(name) for name in lake.child_names(spark, f"{table.path}/snapshots") if name.isdigit()]


def finished(spark: SparkSession, table: SilverTable) -> list[int]:
    """The numbers of the whole snapshots, two or three at most."""
    return [n for n in _numbers(spark, table) if lake.path_exists(spark, f"{table.snapshot(n)}/_SUCCESS")]


def exists(spark: SparkSession, table: SilverTable | ChangeTable) -> bool:
    if isinstance(table, ChangeTable):
        return change_table.exists(spark, table)
    return bool(finished(spark, table))


def read_rows(spark: SparkSession, table: SilverTable | ChangeTable) -> DataFrame:
    """All stored rows, the hidden columns included."""
    if isinstance(table, ChangeTable):
        return change_table.read_rows(spark, table)
    whole = finished(spark, table)
    if not whole:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(table.snapshot(whole[-1]))


def read_current(spark: SparkSession, table: SilverTable | ChangeTable) -> DataFrame:
    return silver.current_rows(read_rows(spark, table))


def apply_changes(spark: SparkSession, table: SilverTable | ChangeTable, changes: DataFrame) -> None:
    """Merge a change batch (bronze rows) into the table: one write of the table, or of the changes. The batch
    is kept nowhere."""
    if isinstance(table, ChangeTable):
        return change_table.append_changes(spark, table, changes)
    if changes.isEmpty():
        return
    merged = silver.merge_changes(read_rows(spark, table), changes, table.row_schema, table.pk)
    # Of two writers at once the second finds its folder taken and fails; its stream tries again.
    merged.write.mode("errorifexists").parquet(table.snapshot(max(_numbers(spark, table), default=0) + 1))
    whole = finished(spark, table)
    for number in _numbers(spark, table):
        if number < whole[-1] and number not in whole[-2:]:
            folder, fs = lake.hadoop_path(spark, table.snapshot(number))
            fs.delete(folder, True)
