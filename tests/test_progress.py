"""Supervision with progress: bounded restarts from the checkpoint, and a table of what the streams did."""

import pytest

from streambed import schemas
from streambed.sources import topics
from streambed.streaming import progress
from streambed.streaming.bronze import ALL_AVAILABLE
from streambed.streaming.supervise import keep_running
from tests.test_streaming import endless, write_messages
from tests.test_changelog import envelope


def starter(spark, root, name, runs, fail_in=()):
    """Starts a stream over ``root/in`` whose n-th run fails in the batches that ``fail_in`` names for it."""

    def start():
        run = len(runs)

        def keep(batch, number):
            if run < len(fail_in) and number in fail_in[run]:
                raise RuntimeError(f"run {run} batch {number}")
            batch.select("value").write.mode("overwrite").parquet(f"{root}/{name}/out/batch={number}")

        stream = topics.file_stream(spark, f"{root}/in", schemas.RAW_MESSAGE, max_files=1)
        query = (
            stream.writeStream.foreachBatch(keep).queryName(name).option("checkpointLocation", f"{root}/{name}/ck")
            .trigger(**ALL_AVAILABLE).start()
        )
        runs.append(query)
        return query

    return start


@pytest.fixture
def source(spark, tmp_path):
    for n in range(3):
        write_messages(spark, str(tmp_path / "in"), [envelope(n, name=f"n{n}")])
    return str(tmp_path)


def test_a_failed_stream_goes_on_from_its_checkpoint_and_the_others_are_not_touched(spark, source):
    good, bad = [], []
    given_up = keep_running(
        spark,
        {"good": starter(spark, source, "good", good), "bad": starter(spark, source, "bad", bad, [{1}, {1, 2}, {2}])},
        poll_seconds=1,
    )
    assert given_up == {} and len(good) == 1 and len(bad) == 4
    for name in ("good", "bad"):
        assert spark.read.parquet(f"{source}/{name}/out").count() == 3


def test_a_stream_that_fails_again_and_again_is_given_up(spark, source):
    good, bad = [], []
    starters = {"bad": starter(spark, source, "bad", bad, [{0}] * 9), "good": starter(spark, source, "good", good)}
    given_up = keep_running(spark, starters, restarts=2, poll_seconds=1)
    assert list(given_up) == ["bad"] and len(bad) == 3 and spark.read.parquet(f"{source}/good/out").count() == 3


def test_a_stream_that_cannot_start_is_given_up(spark):
    def broken():
        raise ValueError("no topic")

    assert str(keep_running(spark, {"x": broken}, restarts=1)["x"]) == "no topic"


def test_an_interrupt_stops_all(spark, monkeypatch):
    from streambed.streaming import supervise

    started = []

    def interrupted(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(supervise, "_any_ended", interrupted)
    keep_running(spark, {"a": lambda: started.append(endless(spark, "a")) or started[-1]})
    assert not started[0].isActive


def test_progress_of_runs_and_restarts(spark, source, tmp_path):
    listener = progress.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        runs = []
        keep_running(spark, {"s": starter(spark, source, "s", runs, [{1}])}, poll_seconds=1)
        assert listener.wait_for_end([str(q.runId) for q in runs])
    finally:
        spark.streams.removeListener(listener)
    rows = progress.read_progress(spark, str(tmp_path / "progress"))
    batches = rows.where("kind = 'batch'").orderBy("batch_id").collect()
    assert [(r["batch_id"], r["input_rows"]) for r in batches] == [(0, 1), (1, 1), (2, 1)]
    assert all(r["end_offset"] and r["duration_ms"] >= 0 and r["behind"] is None for r in batches)
    one = progress.summary(rows).first()
    assert (one["name"], one["batches"], one["input_rows"], one["runs"], one["failed_runs"]) == ("s", 3, 3, 2, 1)
    assert "run 0 batch 1" in rows.where("error IS NOT NULL").first()["error"]


def test_an_event_that_comes_twice_counts_once(spark, tmp_path):
    listener = progress.ProgressLog(spark, str(tmp_path / "progress"))
    batch = ("batch", "k", "r", 0, "a", 4, 5, "[]", "[]", "[]", None, None)
    for row in (batch, batch, ("end", "k", "r", *[None] * 9), ("end", "k", "r", *[None] * 9)):
        listener._write(row)
    rows = progress.read_progress(spark, str(tmp_path / "progress"))
    assert rows.count() == 2 and progress.summary(rows).first()["runs"] == 1


def test_lag_and_repeated_batches_in_the_summary(spark):
    row = lambda batch, at, rows, behind: ("batch", "k", "r", batch, at, rows, 5, "[]", "[]", "[]", behind, None)
    log = spark.createDataFrame([row(0, "a", 4, 9), row(1, "b", 7, 6), row(1, "c", 8, 2)], progress.PROGRESS)
    one = progress.summary(log).first()
    assert (one["batches"], one["input_rows"], one["behind"], one["runs"]) == (2, 12, 2, None)
    assert not progress.ProgressLog(spark, "unused").wait_for_end(["never"], seconds=0.1)
