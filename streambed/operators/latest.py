"""Newest row per key.

Both forms cut every map task's rows to one per key before the shuffle, so a key that holds
a third of the log costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEWEST = ("ts_ms", "seq")


def latest_per_key(df: DataFrame, pk: str | list[str], order: tuple[str, ...] = NEWEST) -> DataFrame:
    """Window form; the `= 1` filter becomes a group limit below the shuffle."""
    newest_first = Window.partitionBy(pk).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def latest_per_key_agg(df: DataFrame, pk: str | list[str], order: tuple[str, ...] = NEWEST) -> DataFrame:
    """Aggregate form, same rows: partial `max_by`, then one shuffle of the survivors."""
    keys = [pk] if isinstance(pk, str) else list(pk)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def keep_latest(df: DataFrame, sort_key: list[str], version: str, *ties: str) -> DataFrame:
    """One row per sort key: the greatest version, ties broken by the named columns."""
    return latest_per_key(df, sort_key, (version, *ties))
