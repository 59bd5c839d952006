import pytest

from streambed import schemas
from streambed.operators import changelog
from streambed.sinks.silver_table import SilverTable, finished, read_current
from streambed.sources import topics
from streambed.streaming.bronze import ALL_AVAILABLE, start_bronze, start_quarantine
from streambed.streaming.silver import start_replica, start_silver
from streambed.streaming.supervise import for_each_table, supervise
from tests.helpers import ROW, changes, names, raw_messages, rows
from tests.test_changelog import envelope


def write_messages(spark, folder, texts, at="2024-03-05 23:59:59"):
    raw_messages(spark, texts, at).coalesce(1).write.mode("append").parquet(folder)


def run_bronze(spark, tmp_path, decode=None):
    raw = topics.file_stream(spark, str(tmp_path / "in"), schemas.RAW_MESSAGE, max_files=1)
    query = start_bronze(
        raw, decode or changelog.json_envelope(), str(tmp_path / "bronze"), str(tmp_path / "ck"),
        name="stream_test", trigger=ALL_AVAILABLE,
    )
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_a_restart_adds_only_new_rows(spark, tmp_path):
    source = str(tmp_path / "in")
    for n in range(3):
        write_messages(spark, source, [envelope(n, name=f"n{n}"), None])
    query = run_bronze(spark, tmp_path)
    assert query.name == "stream_test"
    read = lambda: spark.read.schema(schemas.BRONZE).parquet(str(tmp_path / "bronze"))
    batch = lambda: changelog.to_bronze(spark.read.parquet(source), changelog.json_envelope())
    assert read().count() == 3 and rows(read()) == rows(batch())
    run_bronze(spark, tmp_path)
    assert read().count() == 3
    write_messages(spark, source, [envelope(9, name="late")], at="2023-01-02 00:00:00")
    run_bronze(spark, tmp_path)
    assert rows(read()) == rows(batch())
    assert (tmp_path / "bronze" / "year=2023" / "month=1" / "day=2").is_dir()


def write_bronze(spark, folder, log):
    from pyspark.sql import functions as F

    dated = changes(spark, log).withColumns(
        {"source": F.lit(None).cast("string"), "year": F.lit(2024), "month": F.lit(1), "day": F.lit(1)}
    )
    dated.coalesce(1).write.mode("append").partitionBy("year", "month", "day").parquet(folder)


def run_silver(spark, tmp_path, table, start=start_silver):
    bronze = topics.file_stream(spark, str(tmp_path / "bronze"), schemas.BRONZE, max_files=1)
    start(bronze, table, str(tmp_path / "silver-ck"), trigger=ALL_AVAILABLE).awaitTermination()


def test_silver_stream_over_several_batches_and_a_restart(spark, tmp_path):
    table = SilverTable(str(tmp_path / "silver"), ROW)
    folder = str(tmp_path / "bronze")
    for log in ([(1, "c", 1), (2, "c", 1)], [(1, "u", 5)], [(2, "d", 2), (1, "u", 3)]):
        write_bronze(spark, folder, log)
    run_silver(spark, tmp_path, table)
    assert names(read_current(spark, table)) == {1: ["u@5"]}
    assert finished(spark, table)[-1] == 3
    run_silver(spark, tmp_path, table)
    assert finished(spark, table)[-1] == 3
    write_bronze(spark, folder, [(2, "c", 7)])
    run_silver(spark, tmp_path, table)
    assert names(read_current(spark, table)) == {1: ["u@5"], 2: ["c@7"]}


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    table = SilverTable(str(tmp_path / "silver"), ROW)
    for n, log in enumerate(([(1, "c", 1)], [(2, "c", 1)])):
        write_bronze(spark, str(tmp_path / f"bronze{n}"), log)
        bronze = topics.file_stream(spark, str(tmp_path / f"bronze{n}"), schemas.BRONZE)
        start_silver(bronze, table, str(tmp_path / f"ck{n}"), trigger=ALL_AVAILABLE).awaitTermination()
    assert names(read_current(spark, table)) == {1: ["c@1"], 2: ["c@1"]}
    bronze = topics.file_stream(spark, str(tmp_path / "bronze0"), schemas.BRONZE)
    start_silver(bronze, table, str(tmp_path / "ck-again"), trigger=ALL_AVAILABLE).awaitTermination()
    assert names(read_current(spark, table)) == {1: ["c@1"], 2: ["c@1"]}


def test_undecodable_messages_are_written_aside(spark, tmp_path):
    write_messages(spark, str(tmp_path / "in"), [envelope(1, name="a"), "{bad", b"\x00\x01", None])
    raw = topics.file_stream(spark, str(tmp_path / "in"), schemas.RAW_MESSAGE)
    paths = str(tmp_path / "aside"), str(tmp_path / "ck")
    start_quarantine(raw, changelog.json_envelope(), *paths, trigger=ALL_AVAILABLE).awaitTermination()
    aside = spark.read.parquet(paths[0]).collect()
    assert sorted(bytes(r["value"]) for r in aside) == [b"\x00\x00\x00\x00\x09{bad", b"\x00\x01"]


def test_replica_stream_keeps_deleted_rows(spark, tmp_path):
    table = SilverTable(str(tmp_path / "replica"), ROW)
    write_bronze(spark, str(tmp_path / "bronze"), [(1, "c", 1), (1, "d", 2), (2, "c", 1)])
    run_silver(spark, tmp_path, table, start_replica)
    assert names(read_current(spark, table)) == {1: ["c@1"], 2: ["c@1"]}


def test_a_failing_table_is_skipped_and_the_others_go_on():
    def start(name):
        if name == "devices":
            raise RuntimeError("no topic")
        return name.upper()

    results, failures = for_each_table(["users", "devices", "cam_bills"], start)
    assert results == {"users": "USERS", "cam_bills": "CAM_BILLS"}
    assert list(failures) == ["devices"]


def endless(spark, name, break_on=None):
    """A running stream; it fails in its first batch if told so."""

    def consume(batch, _):
        if break_on:
            raise ValueError(break_on)

    return (
        spark.readStream.format("rate").load().writeStream.queryName(name).foreachBatch(consume).start()
    )


def test_supervision_raises_when_a_stream_fails_and_stops_the_others(spark):
    good = endless(spark, "good")
    bad = endless(spark, "bad", "broken batch")
    with pytest.raises(Exception, match="broken batch"):
        supervise(spark, [good, bad], poll_seconds=1)
    assert not good.isActive and not bad.isActive
    spark.streams.resetTerminated()


def test_supervision_stops_all_on_interrupt(spark, monkeypatch):
    running = [endless(spark, "one"), endless(spark, "two")]

    def interrupted(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(type(spark.streams), "awaitAnyTermination", interrupted)
    supervise(spark, running, poll_seconds=1)
    assert not any(q.isActive for q in running)


def test_kafka_reader_options():
    options = topics.kafka_options("host:9092", "cdc_data.public.users", max_offsets=100)
    assert options["subscribe"] == "cdc_data.public.users"
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "100"
