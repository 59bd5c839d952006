"""Silver tables whose merges cost what changed: a snapshot and the changes since.

A merge writes the newest change per key of its batch to ``changes/<n>`` and touches nothing else.
Readers lay the changes over the newest snapshot; a key's row is the one of the greatest position,
whatever order the batches came in. ``fold`` writes that as the next snapshot, ``snapshots/<n>`` for
the changes up to n, and is run when the changes have grown to a share of the snapshot, so that each
changed byte is written a bounded number of times.

The folders' numbers say all: a snapshot holds the changes up to its number. Spark's own ``_SUCCESS``
file finishes a folder; an unfinished one is never read and is written anew. A replayed or repeated batch
only adds changes that are not newer. What a snapshot holds is removed one snapshot later, for readers
that have begun. A table has one writer at a time, as a stream with its checkpoint has; a fold may
run beside it.

With ``evolve`` the table also takes up columns that its declared schema lacks, nested ones too, and
widens their types as values need it; older rows have nulls there. Declared columns keep their types
unless a wider one is declared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed.operators import changelog, evolve, silver
from streambed.operators.latest import latest_per_key
from streambed.sources import lake

POSITION = ("_ts_ms", "_seq")


@dataclass(frozen=True)
class ChangeTable:
    path: str
    row_schema: T.StructType
    pk: str = "id"
    evolve: bool = False
    # Fold when the changes have this share of the snapshot's bytes, or lie in so many folders.
    fold_share: float = 0.25
    most_folders: int = 200

    def folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/{number:012d}"


def finished(spark: SparkSession, table: ChangeTable, kind: str) -> list[int]:
    """The numbers of the whole snapshots or changes."""
    found = [int(name) for name in lake.child_names(spark, f"{table.path}/{kind}") if name.isdigit()]
    return [n for n in found if lake.path_exists(spark, f"{table.folder(kind, n)}/_SUCCESS")]


def folders(spark: SparkSession, table: ChangeTable) -> tuple[int, list[str], list[str]]:
    """The last number, the newest snapshot (one folder or none) and the changes since."""
    snapshots, changes = finished(spark, table, "snapshots"), finished(spark, table, "changes")
    base = max(snapshots, default=0)
    since = [n for n in changes if n > base]
    return max([base, *since]), [table.folder("snapshots", base)] if base else [], [table.folder("changes", n) for n in since]


def exists(spark: SparkSession, table: ChangeTable) -> bool:
    return folders(spark, table)[0] > 0


def stored_schema(spark: SparkSession, table: ChangeTable) -> T.StructType:
    """The row columns: the declared ones, and what evolving added to the stored files."""
    schema = table.row_schema
    if table.evolve:
        _, base, since = folders(spark, table)
        for path in base + since:
            fields = [f for f in spark.read.parquet(path).schema.fields if f.name not in silver.HIDDEN.names]
            schema = evolve.merge_schemas(schema, T.StructType(fields))
    return schema


def _read(spark: SparkSession, table: ChangeTable, paths: list[str], schema: T.StructType) -> DataFrame:
    if not table.evolve:
        return spark.read.schema(schema).parquet(*paths)
    parts = [evolve.conform(spark.read.parquet(path), schema) for path in paths]
    for part in parts[1:]:
        parts[0] = parts[0].unionByName(part)
    return parts[0]


def read_rows(spark: SparkSession, table: ChangeTable) -> DataFrame:
    """All rows, the hidden columns included.

    The changes are few against the snapshot: where Spark finds them small enough to broadcast, the
    snapshot's rows are not shuffled.
    """
    schema = silver.silver_schema(stored_schema(spark, table))
    _, base, since = folders(spark, table)
    if not base and not since:
        return spark.createDataFrame([], schema)
    if not since:
        return _read(spark, table, base, schema)
    newest = latest_per_key(_read(spark, table, since, schema), table.pk, POSITION)
    return overlaid(_read(spark, table, base, schema), newest, table.pk) if base else newest


def overlaid(rows: DataFrame, newest: DataFrame, pk: str) -> DataFrame:
    """``rows`` with the changes laid over: per key the row of the greater position, and new keys added.

    Both sides have each key once. Written with the changes on the joins' right, which may be broadcast.
    """
    columns = rows.columns
    newer = F.col(f"s.{pk}").isNotNull() & (F.struct(*[f"s.{c}" for c in POSITION]) >= F.struct(*[f"t.{c}" for c in POSITION]))
    kept = (
        rows.alias("t")
        .join(newest.alias("s"), F.col(f"t.{pk}") == F.col(f"s.{pk}"), "left")
        .select(*[F.when(newer, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in columns])
    )
    known = rows.select(pk).join(newest.select(pk), pk, "left_semi")
    return kept.unionByName(newest.join(known, pk, "left_anti").select(*columns))


def read_current(spark: SparkSession, table: ChangeTable) -> DataFrame:
    return silver.current_rows(read_rows(spark, table))


def append_changes(spark: SparkSession, table: ChangeTable, changes: DataFrame) -> None:
    """Merge a change batch (bronze rows): one write of its newest changes.

    The batch is kept nowhere: a task reads what its files or offsets hold, not their rows' whole texts from a
    cache. An evolving table reads it twice, first for its columns.
    """
    if changes.isEmpty():
        return
    schema = table.row_schema
    if table.evolve:
        schema = evolve.merge_schemas(stored_schema(spark, table), _added(evolve.observed_schema(changes), table.row_schema))
    ops = (*changelog.WRITE_OPS, changelog.DELETE_OP)
    newest = silver.newest_changes(changes, schema, table.pk, ops).select(*silver.silver_schema(schema).names)
    newest.write.mode("overwrite").parquet(table.folder("changes", folders(spark, table)[0] + 1))
    if fold_is_due(spark, table):
        fold(spark, table)


def _added(observed: T.StructType, declared: T.StructType) -> T.StructType:
    return T.StructType([f for f in observed.fields if f.name not in (*declared.names, *silver.HIDDEN.names)])


def stored_bytes(spark: SparkSession, paths: list[str]) -> int:
    total = 0
    for path in paths:
        folder, fs = lake.hadoop_path(spark, path)
        total += fs.getContentSummary(folder).getLength()
    return total


def fold_is_due(spark: SparkSession, table: ChangeTable) -> bool:
    _, base, since = folders(spark, table)
    if len(since) > table.most_folders:
        return True
    return bool(base) and stored_bytes(spark, since) > table.fold_share * stored_bytes(spark, base)


def fold(spark: SparkSession, table: ChangeTable) -> bool:
    """Write the changes since the last snapshot into the next one; whether there was anything to fold."""
    last, _, since = folders(spark, table)
    if not since:
        return False
    # What a fold that was stopped left of the same number is unfinished and written over.
    read_rows(spark, table).write.mode("overwrite").parquet(table.folder("snapshots", last))
    whole = finished(spark, table, "snapshots")
    before = whole[-2] if len(whole) > 1 else 0
    stale = [("snapshots", n) for n in whole if n < before] + [("changes", n) for n in finished(spark, table, "changes") if n <= before]
    for kind, number in stale:
        folder, fs = lake.hadoop_path(spark, table.folder(kind, number))
        fs.delete(folder, True)
    return True
