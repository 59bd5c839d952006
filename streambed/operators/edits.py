"""Row edits and key management of the source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streambed.session import run_folder

# monotonically_increasing_id keeps the row's place in its partition in the lower 33 bits.
PLACE_BITS = 33


def update_where(df: DataFrame, predicate: Column, **assignments: Column) -> DataFrame:
    """SQL UPDATE: rows where the predicate is true get the new values, others stay as they are."""
    return df.withColumns(
        {name: F.when(predicate, value).otherwise(F.col(name)) for name, value in assignments.items()}
    )


def pick_one(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The key of the first row in the given order: a top-1, not a full sort."""
    return df.orderBy(*order, key).limit(1).select(key)


def seeded_order(key: str, seed: int) -> Column:
    """A shuffled but repeatable order."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def row_with_key(df: DataFrame, key: str, picked: DataFrame) -> DataFrame:
    """Rows whose key equals the one picked value."""
    return df.where(F.col(key) == picked.scalar())


def id_high_water(tables: dict[str, DataFrame], pk: str = "id") -> DataFrame:
    """Greatest key of every table, one row each."""
    rows = [
        df.agg(F.max(pk).cast("long").alias("max_id")).select(F.lit(name).alias("table_name"), "max_id")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def assign_ids(new: DataFrame, high_water: int, pk: str = "id") -> DataFrame:
    """New rows numbered high_water + 1, + 2, … without gaps and without a single-task sort.

    The rows are first written to the shared folder, so that counting and numbering see the same
    partitions even when an executor is lost. Partition offsets are one row per partition.
    """
    folder = f"{run_folder(new.sparkSession, 'assign_ids')}/rows"
    new.write.parquet(folder)
    place = F.monotonically_increasing_id()
    numbered = (
        new.sparkSession.read.schema(new.schema)
        .parquet(folder)
        .withColumn("_mid", place)
        .withColumn("_part", F.shiftrightunsigned("_mid", PLACE_BITS))
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_part").alias("_later"), F.sum("_rows").over(before).alias("_offset"))
    within = F.col("_mid").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        numbered.join(offsets, F.col("_part") == F.col("_later"), "left")
        .withColumn(pk, F.coalesce("_offset", F.lit(0)) + within + F.lit(high_water + 1))
        .drop("_mid", "_part", "_later", "_offset")
    )


def emptied(df: DataFrame) -> DataFrame:
    """No rows, same columns: what a truncated table holds."""
    return df.limit(0)
