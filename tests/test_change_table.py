"""Change tables: the same rows as the plain merge, at the cost of the batch."""

import os
import random

from pyspark.sql import functions as F

from streambed.operators import silver
from streambed.sinks import change_table as ct
from tests.helpers import ROW, changes, names, rows


def make(tmp_path, **options):
    return ct.ChangeTable(str(tmp_path / "t"), ROW, **options)


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


def test_random_batches_in_any_order_equal_the_plain_merge(spark, tmp_path):
    draw = random.Random(8)
    log = [(draw.randrange(12), draw.choice("crudxt"), draw.randrange(30), draw.randrange(3)) for _ in range(120)]
    log = list({(k, ts, seq): (k, op, ts, seq) for k, op, ts, seq in log}.values())
    batches = [log[k::7] for k in range(7)]
    table = make(tmp_path, fold_share=0.5)
    for n, batch in enumerate(batches + [batches[2]]):
        ct.append_changes(spark, table, changes(spark, batch))
        if n in (1, 4):
            assert ct.fold(spark, table) in (True, False)
    plain = silver.merge_changes(silver.empty_silver(spark, ROW), changes(spark, log), ROW)
    assert rows(ct.read_rows(spark, table)) == rows(plain)
    before = rows(ct.read_rows(spark, table))
    ct.fold(spark, table)
    assert rows(ct.read_rows(spark, table)) == before and not ct.fold(spark, table)


def test_a_merge_of_one_percent_writes_under_five_percent(spark, tmp_path):
    table = make(tmp_path)
    ids = spark.range(100_000).select(F.col("id").cast("string").alias("id"))
    image = F.to_json(F.struct(F.col("id").cast("long").alias("id"), F.sha2("id", 256).alias("name")))
    log = ids.select("id", F.lit(None).cast("string").alias("before"), image.alias("after"), F.lit("c").alias("op"), F.lit(1).cast("long").alias("ts_ms"), F.lit(0).cast("long").alias("seq"))
    ct.append_changes(spark, table, log)
    ct.fold(spark, table)
    whole = size(table.folder("snapshots", 1))
    ct.append_changes(spark, table, log.where("id % 100 = 7").withColumn("ts_ms", F.lit(2).cast("long")))
    assert ct.finished(spark, table, "snapshots") == [1]
    assert 0 < size(table.folder("changes", 2)) < 0.05 * whole
    assert ct.read_current(spark, table).count() == 100_000


def test_small_changes_leave_the_snapshot_unshuffled(spark, tmp_path):
    table = make(tmp_path, fold_share=100.0)
    ct.append_changes(spark, table, changes(spark, [(k, "c", 1) for k in range(50)]))
    ct.fold(spark, table)
    ct.append_changes(spark, table, changes(spark, [(3, "u", 2), (99, "c", 2)]))
    found = ct.read_rows(spark, table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    assert names(silver.current_rows(found))[3] == ["u@2"] and found.count() == 51


def test_changes_are_folded_when_they_have_grown(spark, tmp_path):
    table = make(tmp_path, fold_share=100.0, most_folders=3)
    for k in range(5):
        ct.append_changes(spark, table, changes(spark, [(k, "c", 1)]))
    assert ct.finished(spark, table, "snapshots") == [4] and ct.finished(spark, table, "changes")[-1] == 5
    for k in range(5, 9):
        ct.append_changes(spark, table, changes(spark, [(k, "c", 1)]))
    snapshots = ct.finished(spark, table, "snapshots")
    assert len(snapshots) == 2 and min(ct.finished(spark, table, "changes")) > min(snapshots)
    assert sorted(names(ct.read_current(spark, table))) == list(range(9))


def test_a_share_of_the_snapshot_is_folded(spark, tmp_path):
    table = make(tmp_path, fold_share=0.5)
    ct.append_changes(spark, table, changes(spark, [(k, "c", 1) for k in range(5000)]))
    ct.fold(spark, table)
    ct.append_changes(spark, table, changes(spark, [(k, "u", 2) for k in range(100)]))
    assert ct.finished(spark, table, "snapshots") == [1]
    ct.append_changes(spark, table, changes(spark, [(k, "u", 3) for k in range(4000)]))
    assert ct.finished(spark, table, "snapshots") == [1, 3]


def test_what_was_stopped_is_never_read(spark, tmp_path):
    table = make(tmp_path)
    ct.append_changes(spark, table, changes(spark, [(1, "c", 1)]))
    for kind, number in (("changes", 2), ("snapshots", 1)):
        left = table.folder(kind, number)
        silver.merge_changes(silver.empty_silver(spark, ROW), changes(spark, [(9, "c", 1)]), ROW).write.parquet(left)
        os.remove(os.path.join(left, "_SUCCESS"))
    assert names(ct.read_current(spark, table)) == {1: ["c@1"]}
    ct.append_changes(spark, table, changes(spark, [(2, "c", 1)]))
    ct.fold(spark, table)
    assert names(ct.read_current(spark, table)) == {1: ["c@1"], 2: ["c@1"]}


def test_empty_batches_and_tables(spark, tmp_path):
    table = make(tmp_path)
    ct.append_changes(spark, table, changes(spark, []))
    assert not ct.exists(spark, table) and ct.read_current(spark, table).count() == 0 and not ct.fold(spark, table)


def test_rows_without_a_position_give_way_to_any_change(spark, tmp_path):
    table = make(tmp_path)
    start = silver.as_silver(spark.createDataFrame([(1, "old", None), (2, "kept", None)], ROW))
    start.write.parquet(table.folder("snapshots", 1))
    ct.append_changes(spark, table, changes(spark, [(1, "u", 0)]))
    assert names(ct.read_current(spark, table)) == {1: ["u@0"], 2: ["kept"]}


def test_a_batch_is_kept_nowhere(spark, tmp_path, monkeypatch):
    batch = changes(spark, [(k, "c", 1) for k in range(9)])
    monkeypatch.setattr(type(batch), "persist", lambda *_: 1 / 0)
    for n, options in enumerate(({}, {"evolve": True})):
        table = make(tmp_path / str(n), **options)
        ct.append_changes(spark, table, batch)
        assert ct.read_current(spark, table).count() == 9
