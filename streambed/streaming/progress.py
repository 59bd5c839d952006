"""What running streams did, as a table: one row per micro-batch and one per end.

``ProgressLog`` listens to the session's streams and appends their progress to a folder of JSON lines:
rows, offsets, duration, and how far the source is ahead where it says so (Kafka does).
"""

from __future__ import annotations

import json
import logging
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from streambed import schemas

log = logging.getLogger(__name__)

PROGRESS = schemas.columns(
    "kind STRING, name STRING, run_id STRING, batch_id BIGINT, at STRING, input_rows BIGINT, duration_ms BIGINT, "
    "start_offset STRING, end_offset STRING, latest_offset STRING, behind BIGINT, error STRING"
)
BEHIND = "maxOffsetsBehindLatest"


class ProgressLog(StreamingQueryListener):
    """Appends to ``folder``; a progress event without input is not written."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.names: dict[str, str | None] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            sources = p.sources
            behind = [int(s.metrics[BEHIND]) for s in sources if BEHIND in (s.metrics or {})]
            offsets = [json.dumps([getattr(s, part) for s in sources]) for part in ("startOffset", "endOffset", "latestOffset")]
            took = p.durationMs.get("triggerExecution")
            self._write(("batch", p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, took, *offsets, max(behind, default=None), None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        self._write(("end", self.names.get(run), run, *[None] * 8, event.exception))
        with self.changed:
            self.ended.add(run)
            self.changed.notify_all()

    def _write(self, row: tuple) -> None:
        try:
            self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").json(self.folder)
        except Exception as error:  # noqa: BLE001 - a lost line must not stop the listener
            log.warning("progress of %s not written: %s", row[1], error)

    def wait_for_end(self, run_ids: list[str], seconds: float = 60) -> bool:
        """Events come later than what they tell of: wait until these runs' ends have been written."""
        until = time.monotonic() + seconds
        with self.changed:
            while not self.ended.issuperset(run_ids) and time.monotonic() < until:
                self.changed.wait(until - time.monotonic())
        return self.ended.issuperset(run_ids)


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The table, each batch and end of a run once: an event may reach the listener more than once."""
    return spark.read.schema(PROGRESS).json(folder).dropDuplicates(["kind", "run_id", "batch_id"])


def summary(progress: DataFrame) -> DataFrame:
    """Per stream name its runs, batches, rows, the longest batch, the newest lag, and how many runs failed.

    A batch that was run again after a restart counts once, with the rows of its last run.
    """
    batches = (
        progress.where("kind = 'batch'")
        .groupBy("name", "batch_id")
        .agg(
            F.max_by("input_rows", "at").alias("input_rows"),
            F.max("duration_ms").alias("duration_ms"),
            F.max_by("behind", "at").alias("behind"),
        )
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("batches"),
            F.sum("input_rows").alias("input_rows"),
            F.max("duration_ms").alias("longest_ms"),
            F.max_by("behind", "batch_id").alias("behind"),
        )
    )
    ends = progress.where("kind = 'end'").groupBy(F.col("name").alias("ended")).agg(
        F.count(F.lit(1)).alias("runs"), F.count("error").alias("failed_runs")
    )
    return batches.join(ends, F.col("name").eqNullSafe(F.col("ended")), "left").drop("ended")
