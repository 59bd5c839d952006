"""Snapshot chunks and the log: nothing lost, nothing undone, whenever the chunks were read."""

import random

import pytest

from streambed.operators import handover, silver
from tests.helpers import CHANGES, ROW, change, names


CHUNKED = "id bigint, name string, amount decimal(15,2), chunk int"


def history(draw, steps):
    """A table's log, one change per position, and its state after each position."""
    state, states, log = {}, [{}], []
    for position in range(1, steps + 1):
        key = draw.randrange(10)
        op = draw.choice("uud") if key in state else "c"
        if op == "d":
            state = {k: v for k, v in state.items() if k != key}
        else:
            state = {**state, key: f"{op}@{position}"}
        log.append(change(key, op, position, position))
        states.append(state)
    return log, states


@pytest.mark.parametrize("seed", range(6))
def test_the_merged_handover_is_the_table(spark, seed):
    draw = random.Random(seed)
    log, states = history(draw, 60)
    begin = draw.randrange(1, 20)
    chunks, windows, at = [], [], begin
    for chunk in range(4):
        low = at + draw.randrange(3)
        read = low + draw.randrange(8)
        high = read + draw.randrange(8)
        at = draw.choice([high, low])  # windows may overlap
        windows.append((chunk, low, low, high, high))
        chunks += [(k, name, None, chunk) for k, name in states[min(read, 60)].items() if k % 4 == chunk]
    # The log is captured from the first chunk's low on.
    captured = [row for row in log if row[4] > windows[0][1]]
    draw.shuffle(captured)
    made = handover.hand_over(
        spark.createDataFrame(chunks, CHUNKED),
        spark.createDataFrame(windows, handover.WINDOWS),
        spark.createDataFrame(captured, CHANGES),
    )
    merged = silver.current_rows(silver.merge_changes(silver.empty_silver(spark, ROW), made, ROW))
    assert names(merged) == {k: [v] for k, v in states[-1].items()}
    # Rows the log speaks for inside their window are not sent a second time.
    spoken = {(row[0], c[0]) for c in windows for row in captured if c[1] < row[4] <= c[3]}
    sent = {r["id"] for r in made.where("op = 'r'").collect()}
    assert all((str(k), chunk) not in spoken for k, _, _, chunk in chunks if str(k) in sent)


def test_key_chunks_are_ranges_of_about_equal_size(spark):
    table = spark.range(1000).selectExpr("id", "'x' AS name")
    found = handover.key_chunks(table, "id", 4).groupBy("chunk").agg({"id": "min", "*": "count"}).collect()
    sizes = {r["chunk"]: r["count(1)"] for r in found}
    assert set(sizes) == {0, 1, 2, 3} and min(sizes.values()) > 100
    assert {r["chunk"] for r in handover.key_chunks(table, "id", 1).collect()} == {0}
    assert handover.key_chunks(table.limit(0), "id", 4).count() == 0


def test_empty_log_and_empty_snapshot(spark):
    windows = spark.createDataFrame([(0, 1, 1, 9, 9)], handover.WINDOWS)
    log = spark.createDataFrame([change(1, "c", 5, 5)], CHANGES)
    rows = spark.createDataFrame([(2, "read", None, 0)], CHUNKED)
    assert [r["op"] for r in handover.hand_over(rows, windows, log.limit(0)).collect()] == ["r"]
    assert [r["op"] for r in handover.hand_over(rows.limit(0), windows, log).collect()] == ["c"]


def test_a_hot_key_of_the_log_meets_a_join_that_can_be_split(spark):
    windows = spark.createDataFrame([(0, 1, 1, 10_000, 10_000)], handover.WINDOWS)
    log = spark.createDataFrame([change(1, "u", ts, ts) for ts in range(2, 600)], CHANGES)
    rows = spark.createDataFrame([(k, "read", None, 0) for k in range(30)], CHUNKED)
    made = handover.hand_over(rows, windows, log)
    assert made.where("op = 'r'").count() == 29
