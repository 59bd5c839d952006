import os

import pytest

from streambed import schemas
from streambed.operators import silver
from streambed.sinks import silver_table as st
from tests.helpers import ROW, changes, names, rows


def make(tmp_path):
    return st.SilverTable(str(tmp_path / "t"), ROW)


def folders(table):
    return sorted(os.listdir(os.path.join(table.path, "snapshots")))


def test_missing_table_reads_as_empty(spark, tmp_path):
    table = make(tmp_path)
    assert st.read_current(spark, table).count() == 0 and not st.exists(spark, table)


def test_runs_equal_the_plain_merge_and_a_replayed_run_changes_nothing(spark, tmp_path):
    table = make(tmp_path)
    first = [(k, "c", 1) for k in range(20)]
    second = [(3, "d", 2), (4, "u", 2), (50, "c", 2)]
    for batch in (first, second, second, first):
        st.apply_changes(spark, table, changes(spark, batch))
        if batch is first:
            assert st.exists(spark, table)
    plain = silver.merge_changes(silver.empty_silver(spark, ROW), changes(spark, first + second), ROW)
    assert rows(st.read_rows(spark, table)) == rows(plain)


def test_each_merge_is_one_snapshot_and_old_ones_go(spark, tmp_path):
    table = make(tmp_path)
    for k in range(4):
        st.apply_changes(spark, table, changes(spark, [(k, "c", 1)]))
    assert st.finished(spark, table) == [3, 4] and [int(f) for f in folders(table)] == [3, 4]


def test_empty_batch_writes_nothing(spark, tmp_path):
    table = make(tmp_path)
    st.apply_changes(spark, table, changes(spark, []))
    assert not st.exists(spark, table)


def test_what_a_stopped_run_left_is_never_read(spark, tmp_path):
    table = make(tmp_path)
    st.apply_changes(spark, table, changes(spark, [(1, "c", 1), (2, "c", 1)]))
    # The next snapshot begun, some files written, not finished.
    unfinished = table.snapshot(2)
    silver.merge_changes(
        silver.empty_silver(spark, ROW), changes(spark, [(9, "c", 1)]), ROW
    ).write.parquet(unfinished)
    os.remove(os.path.join(unfinished, "_SUCCESS"))
    assert names(st.read_current(spark, table)) == {1: ["c@1"], 2: ["c@1"]}
    st.apply_changes(spark, table, changes(spark, [(2, "d", 3)]))
    assert names(st.read_current(spark, table)) == {1: ["c@1"]} and st.finished(spark, table) == [1, 3]


def test_of_two_writers_the_second_fails_whole(spark, tmp_path, monkeypatch):
    table = make(tmp_path)
    st.apply_changes(spark, table, changes(spark, [(1, "c", 1)]))
    monkeypatch.setattr(st, "_numbers", lambda *_: [])
    with pytest.raises(Exception, match="already exists"):
        st.apply_changes(spark, table, changes(spark, [(2, "c", 1)]))


def test_a_column_added_to_the_schema_is_null_in_older_rows(spark, tmp_path):
    table = make(tmp_path)
    st.apply_changes(spark, table, changes(spark, [(1, "c", 1), (2, "c", 1)]))
    wider = schemas.columns("id BIGINT, name STRING, amount MONEY, note STRING")
    evolved = st.SilverTable(table.path, wider)
    log = [("2", None, '{"id":2,"name":"n","note":"new"}', "u", 2, 0)]
    st.apply_changes(spark, evolved, changes(spark, log))
    assert {r["id"]: r["note"] for r in st.read_current(spark, evolved).collect()} == {1: None, 2: "new"}
