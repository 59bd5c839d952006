"""Change log to current rows.

Two semantics, on purpose under two names:

* ``merge_changes`` is the canonical one: per key the newest change by (ts_ms, seq) wins.
* ``crud_reconstruct`` is the rebuild from inserts, latest updates and deletes. A key with any
  delete is gone, replayed inserts stay double, and an update always beats an insert.

A silver table carries three hidden columns: ``_ts_ms`` and ``_seq`` (position of the change the
row came from) and ``_deleted``. Deleted keys stay as hidden rows, so that a late change cannot
bring them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed import schemas
from streambed.operators import changelog
from streambed.operators.latest import NEWEST, latest_per_key

HIDDEN = schemas.columns("_ts_ms BIGINT, _seq BIGINT, _deleted BOOLEAN")


def silver_schema(row_schema: T.StructType) -> T.StructType:
    return T.StructType(row_schema.fields + HIDDEN.fields)


def empty_silver(spark: SparkSession, row_schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], silver_schema(row_schema))


def current_rows(silver: DataFrame) -> DataFrame:
    """What a reader sees: live rows without the hidden columns."""
    return silver.where(~F.col("_deleted")).drop(*HIDDEN.names)


def latest_update(bronze: DataFrame, pk: str = "id", order: tuple[str, ...] = NEWEST) -> DataFrame:
    return latest_per_key(changelog.updates(bronze), pk, order)


def keys_with(bronze: DataFrame, pk: str, *ops: str) -> DataFrame:
    """The keys that have a change of these ops, for an anti join.

    They are made distinct per key and op, so the join shuffles them once more by the key alone.
    That small shuffle is what lets Spark split a hot key on the join's other side: it can only
    do so where both sides come straight from a shuffle of the join's own.
    """
    return bronze.where(F.col("op").isin(*ops)).select(pk, "op").distinct().select(pk)


def inserts_without_update(bronze: DataFrame, pk: str = "id") -> DataFrame:
    """Insert rows of the keys that were never updated."""
    return changelog.inserts(bronze).join(keys_with(bronze, pk, "u"), pk, "left_anti")


def updates_and_deletes(bronze: DataFrame, pk: str, order: tuple[str, ...] = NEWEST) -> DataFrame:
    """Per key with an update or a delete: its newest update as ``row`` and whether it was ``deleted``.
    Changes without a key belong to no row.

    One pass, cut to a row per key in every map task. The rows are grouped by the key and its hash, so
    that a join on the key shuffles the keys once more by itself: only then can Spark split a hot key
    on the join's other side.
    """
    is_update = F.col("op") == "u"
    rest = [c for c in bronze.columns if c != pk]
    newest = F.max_by(F.struct(*rest), F.when(is_update, F.struct(*order)))
    return (
        bronze.where(F.col(pk).isNotNull() & (is_update | (F.col("op") == changelog.DELETE_OP)))
        .groupBy(pk, F.xxhash64(pk).alias("_hash"))
        .agg(newest.alias("row"), F.bool_or(F.col("op") == changelog.DELETE_OP).alias("deleted"))
    )


def crud_changes(bronze: DataFrame, pk: str = "id", order: tuple[str, ...] = NEWEST) -> DataFrame:
    """The change rows a rebuild keeps: inserts of the keys with neither update nor delete, and
    the latest update of the keys without delete. Replayed inserts all stay, so an insert's key
    may be hot. The log is read twice: once for updates and deletes, once for inserts."""
    changed = updates_and_deletes(bronze, pk, order)
    # The condition names every column that the updates need, so that both uses are one aggregate.
    known = changed.where(F.col("row").isNotNull() | F.col("deleted")).select(F.col(pk).alias("_key"))
    kept_inserts = changelog.inserts(bronze).join(known, F.col(pk) == F.col("_key"), "left_anti")
    kept_updates = changed.where(F.col("row").isNotNull() & ~F.col("deleted")).select(pk, "row.*")
    return changelog.union_changes(kept_inserts, kept_updates)


def crud_reconstruct(bronze: DataFrame, row_schema: T.StructType, pk: str = "id") -> DataFrame:
    needed = bronze.select(pk, "after", "op", *NEWEST)
    return changelog.expand_payload(crud_changes(needed, pk), row_schema, F.col("after"))


def newest_changes(changes: DataFrame, row_schema: T.StructType, pk: str, ops: tuple[str, ...]) -> DataFrame:
    """Per key the newest change among ``ops``, as a silver row.

    The image of a write is the row after it; a write without one is no change to a row and stays in
    bronze only. The key is typed before ranking, so the merge join reuses the ranking's shuffle, and only
    the surviving images are parsed. A change without a readable key belongs to no row; it
    stays in bronze only.
    """
    key_type = row_schema[pk].dataType
    is_delete = F.col("op") == changelog.DELETE_OP
    ranked = latest_per_key(
        changes.where(F.col("op").isin(*ops)).select(
            F.col("id").try_cast(key_type).alias("_key"),
            F.when(is_delete, changelog.after_or_before()).otherwise(F.col("after")).alias("_image"),
            "op",
            "ts_ms",
            "seq",
        ).where(F.col("_key").isNotNull() & (is_delete | F.col("_image").isNotNull())),
        "_key",
    )
    parsed = ranked.withColumn("_payload", F.from_json("_image", row_schema))
    return parsed.select(
        F.col("_key").alias(pk),
        *[F.col("_payload")[c].alias(c) for c in row_schema.names if c != pk],
        F.col("ts_ms").alias("_ts_ms"),
        F.col("seq").alias("_seq"),
        is_delete.alias("_deleted"),
    )


def overlay(target: DataFrame, source: DataFrame, pk: str, take_source: Column) -> DataFrame:
    """``target FULL OUTER source`` on a key unique in both, whole rows from one side or the other."""
    joined = target.alias("t").join(source.alias("s"), F.col(f"t.{pk}") == F.col(f"s.{pk}"), "full_outer")
    return joined.select(
        *[F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    )


def merge_changes(target: DataFrame, changes: DataFrame, row_schema: T.StructType, pk: str = "id") -> DataFrame:
    """Merge a change batch into silver rows.

    A matched delete hides the row, any other matched change replaces it, an unmatched one
    inserts it. A change older than the stored row is ignored, so batches may come twice or
    out of order. Unknown ops are left out before ranking and never hide a valid change.
    """
    source = newest_changes(changes, row_schema, pk, (*changelog.WRITE_OPS, changelog.DELETE_OP))
    newer = F.struct("s._ts_ms", "s._seq") >= F.struct("t._ts_ms", "t._seq")
    take_source = F.col(f"t.{pk}").isNull() | (F.col(f"s.{pk}").isNotNull() & newer)
    columns = silver_schema(row_schema).names
    return overlay(target.select(*columns), source.select(*columns), pk, take_source)


def as_silver(rows: DataFrame) -> DataFrame:
    """Plain rows as silver rows of no position: any change of their key is newer."""
    hidden = {"_ts_ms": F.lit(None), "_seq": F.lit(None), "_deleted": F.lit(False)}
    return rows.select("*", *[hidden[f.name].cast(f.dataType).alias(f.name) for f in HIDDEN.fields])


def replica_upsert(target: DataFrame, changes: DataFrame, row_schema: T.StructType, pk: str = "id") -> DataFrame:
    """Upsert silver rows by key from the newest after-image; deletes are ignored and their rows stay.

    The merge's own position guard holds: an older change never overwrites a newer row.
    """
    return merge_changes(target, changes.where(F.col("op").isin(*changelog.WRITE_OPS)), row_schema, pk)


def absent_rows(target: DataFrame, new: DataFrame, pk: str, order: tuple[str, ...]) -> DataFrame:
    """The new rows whose key the target lacks, one per key (the first by ``order``)."""
    first = F.min_by(F.struct(*new.columns), F.struct(*order)).alias("_row")
    firsts = new.groupBy(pk).agg(first).select("_row.*")
    return firsts.join(target.select(pk), pk, "left_anti").select(*new.columns)


def insert_if_absent(target: DataFrame, new: DataFrame, pk: str, order: tuple[str, ...]) -> DataFrame:
    """Insert, existing key wins. The target's wide rows are not shuffled."""
    fresh = absent_rows(target, new, pk, order).select(*target.columns)
    return target.unionByName(fresh)
