"""Tables whose rows are numbered from a stored counter.

A batch draws its range of keys before its rows are written: a stopped write may leave a gap, as a
sequence does, and never gives a key twice. Emptying a set of tables empties the stored rows themselves and
may restart their counters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from streambed import schemas
from streambed.operators import edits
from streambed.sources import lake

COUNTER = schemas.columns("high_water BIGINT")


@dataclass(frozen=True)
class NumberedTable:
    """``schema`` is that of the rows, the key included."""

    path: str
    schema: T.StructType
    pk: str = "id"


def high_water(spark: SparkSession, table: NumberedTable) -> int:
    """The last key drawn. Counters are folders named by it, finished by Spark's ``_SUCCESS``; the greatest counts."""
    drawn = [int(name) for name in lake.child_names(spark, f"{table.path}/counter") if name.isdigit()]
    whole = [n for n in drawn if lake.path_exists(spark, f"{table.path}/counter/{n:020d}/_SUCCESS")]
    return max(whole, default=0)


def _store(spark: SparkSession, table: NumberedTable, value: int) -> None:
    row = spark.createDataFrame([(value,)], COUNTER)
    folder = f"{table.path}/counter/{value:020d}"
    # Of two batches that draw the same range, the second finds it finished and fails; what a stopped draw
    # left is written over.
    taken = lake.path_exists(spark, f"{folder}/_SUCCESS")
    row.coalesce(1).write.mode("errorifexists" if taken else "overwrite").parquet(folder)


def append_rows(spark: SparkSession, table: NumberedTable, new: DataFrame) -> int:
    """Append rows under the next keys, without gaps; how many there were."""
    start = high_water(spark, table)
    numbered = edits.assign_ids(new, start, table.pk).select(*table.schema.names)
    rows = numbered.count()
    if rows:
        _store(spark, table, start + rows)
        numbered.write.mode("append").parquet(f"{table.path}/rows")
    return rows


def read_rows(spark: SparkSession, table: NumberedTable) -> DataFrame:
    return lake.read_or_empty(spark, f"{table.path}/rows", table.schema).select(*table.schema.names)


def truncate(spark: SparkSession, tables: list[NumberedTable], restart: bool = True) -> None:
    """Empty the tables in place; with ``restart`` their next key is 1 again, else the counters go on."""
    for table in tables:
        spark.createDataFrame([], table.schema).write.mode("overwrite").parquet(f"{table.path}/rows")
        if restart:
            folder, fs = lake.hadoop_path(spark, f"{table.path}/counter")
            fs.delete(folder, True)
