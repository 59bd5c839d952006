"""The newest position per key as keyed state: only changes that advance their key go on.

The state store remembers, per key, the position of the newest change seen. Late, repeated and
out-of-order changes are behind it and end here, so a sink may append what comes out, and whatever
order the batches came in, per key the last row out is the newest change.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: keyed state with several variables needs this store.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
POSITION = ["ts_ms", "seq"]
# Bytes of Arrow batches that a task reduces at once.
GATHERED_BYTES = 32 << 20


class NewestChange(StatefulProcessor):
    """Emits a key's newest change of the batch if it is newer than all before it.

    A null position counts as the smallest. Of changes at one position the first to come stays.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "ts_ms long, seq long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        known = self.seen.get()  # None where the key is new
        newest, best = _position(known) if known else None, None
        for part in rows:
            for place, position in enumerate(zip(*[_longs(part[c]) for c in POSITION])):
                if newest is None or _order(position) > _order(newest):
                    newest, best = position, part.iloc[[place]]
        if best is not None:
            self.seen.update(newest)
            yield best

    def close(self) -> None:
        pass


def _longs(values: pd.Series) -> list[int | None]:
    """Positions are sent as text, which pandas keeps whole beside nulls."""
    return [None if v is None or v != v else int(v) for v in values]


def _position(row) -> tuple[int | None, int | None]:
    return tuple(row)


def _order(position: tuple) -> tuple:
    return tuple((v is not None, v or 0) for v in position)


def newest_per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key and gathered batches, before the shuffle: a hot key costs a row per so many bytes, not
    its rows. What is left of a gathering goes into the next one while it is small."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHERED_BYTES:
            held = _newest(held)
            size = sum(b.nbytes for b in held)
            if size >= GATHERED_BYTES // 2:
                yield from held
                held, size = [], 0
    if held:
        yield from _newest(held)


def _newest(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    table = pa.Table.from_batches(batches)
    # Before equal positions the later row, so that of these the first stays last.
    keys = [(c, "ascending") for c in POSITION] + [("place", "descending")]
    table = table.append_column("place", pa.array(range(table.num_rows)))
    table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start")).drop_columns("place")
    table = table.append_column("place", pa.array(range(table.num_rows)))
    last = table.group_by("id", use_threads=False).aggregate([("place", "max")])["place_max"]
    return table.take(last).drop_columns("place").combine_chunks().to_batches()


def advancing(changes: DataFrame) -> DataFrame:
    """The changes of a bronze stream that advance their key, as a stream; changes without a key end here.

    The state has one position per key ever seen. Its number of partitions is
    ``spark.sql.shuffle.partitions`` at the first start.
    """
    changes.sparkSession.conf.set(STATE_STORE, ROCKS)
    reduced = changes.where(F.col("id").isNotNull()).mapInArrow(newest_per_batch, changes.schema)
    as_text = reduced.withColumns({c: F.col(c).cast("string") for c in POSITION})
    kept = as_text.groupBy("id").transformWithStateInPandas(
        statefulProcessor=NewestChange(), outputStructType=as_text.schema, outputMode="Append", timeMode="None"
    )
    return kept.withColumns({c: F.col(c).cast("long") for c in POSITION})
