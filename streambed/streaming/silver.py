"""Bronze stream to silver tables and replicas, one merge per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from streambed.operators.changelog import WRITE_OPS
from streambed.sinks.change_table import ChangeTable
from streambed.sinks.silver_table import SilverTable, apply_changes
from streambed.streaming.bronze import EVERY_TEN_MINUTES


def start_silver(
    bronze: DataFrame, table: SilverTable | ChangeTable, checkpoint: str, name: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Merge every micro-batch; one that comes again, after a restart or from a new checkpoint, changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        apply_changes(batch.sparkSession, table, batch)

    writer = (
        bronze.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TEN_MINUTES))
    )
    return (writer.queryName(name) if name else writer).start()


def start_replica(
    bronze: DataFrame, table: SilverTable | ChangeTable, checkpoint: str, name: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Like ``start_silver`` but deletes are ignored, so deleted rows stay in the replica."""
    return start_silver(bronze.where(bronze["op"].isin(*WRITE_OPS)), table, checkpoint, name, trigger)
