"""A snapshot read in chunks while the log runs on, handed over without a gap.

Each chunk is read between two log positions, low and high, which the reader notes before and after. A
row read there is as old as low at least: it holds every change up to low, and perhaps some of those up
to high. So a row whose key has a change inside the window is left to the log, and every other row
enters the log as an `r` change at low. Whatever order the chunks were read in, and however long they
took, merging the result gives the table: no change is lost, and no row undoes a change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streambed.operators import changelog
from streambed.operators.latest import NEWEST

WINDOWS = "chunk INT, low_ts_ms BIGINT, low_seq BIGINT, high_ts_ms BIGINT, high_seq BIGINT"


def key_chunks(table: DataFrame, pk: str, chunks: int) -> DataFrame:
    """The table with ``chunk``, its place among about equal ranges of the key; null keys are in chunk 0.

    The bounds, one per chunk, come from one approximate quantile.
    """
    bounds = sorted(set(table.approxQuantile(pk, [k / chunks for k in range(1, chunks)], 0.5 / chunks))) if chunks > 1 else []
    above = F.lit(0)
    if bounds:
        above = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: F.coalesce(F.col(pk) > bound, F.lit(False))))
    return table.withColumn("chunk", above)


def snapshot_rows(chunks: DataFrame, windows: DataFrame, pk: str) -> DataFrame:
    """Chunk rows as changes: ``id``, images, op `r` and the position low, and their window's ``high``.

    ``windows`` has one row per chunk read; a chunk read again has its rows and its window again under a
    number of its own.
    """
    columns = [c for c in chunks.columns if c != "chunk"]
    read = chunks.join(windows, "chunk")
    return read.select(
        F.col(pk).cast("string").alias("id"),
        F.lit(None).cast("string").alias("before"),
        changelog.row_image(columns).alias("after"),
        F.lit("r").alias("op"),
        F.col("low_ts_ms").alias("ts_ms"),
        F.col("low_seq").alias("seq"),
        "chunk",
        F.struct(F.col("high_ts_ms").alias("ts_ms"), F.col("high_seq").alias("seq")).alias("high"),
    )


def hand_over(chunks: DataFrame, windows: DataFrame, log: DataFrame, pk: str = "id") -> DataFrame:
    """The change log that begins with the snapshot: the snapshot's rows that the log leaves, and the log.

    The log must reach from the first chunk's low on. A change inside a window is looked for in a plain inner join on
    the key, whose hot keys Spark can split, and reduced to one row per key and chunk before the anti join.
    """
    rows = snapshot_rows(chunks, windows, pk)
    after_low = F.struct(*[f"l.{c}" for c in NEWEST]) > F.struct("s.ts_ms", "s.seq")
    up_to_high = F.struct(*[f"l.{c}" for c in NEWEST]) <= F.col("s.high")
    inside = (
        log.select("id", *NEWEST)
        .alias("l")
        .join(rows.select("id", "chunk", "ts_ms", "seq", "high").alias("s"), F.col("l.id") == F.col("s.id"))
        .where(after_low & up_to_high)
        .select("s.id", "s.chunk")
        .distinct()
    )
    kept = rows.join(inside, ["id", "chunk"], "left_anti")
    return kept.select("id", "before", "after", "op", *NEWEST).unionByName(log.select("id", "before", "after", "op", *NEWEST))
