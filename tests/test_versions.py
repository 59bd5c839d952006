"""Decoding by the writer's schema: renamed, added and unknown fields, unknown schemas."""

import json

from streambed.operators import changelog, silver, versions
from streambed.operators.versions import ReaderField
from tests.helpers import ROW, raw_messages, rows

READER = [ReaderField("id"), ReaderField("name", ("full_name", "label")), ReaderField("amount", default=1.5), ReaderField("note")]


def record(*names):
    return json.dumps({"type": "record", "name": "t", "fields": [{"name": n, "type": "string"} for n in names]})


def framed(schema_id, after, op="c", before=None, ts=1):
    text = json.dumps({"before": before, "after": after, "source": {"lsn": ts}, "op": op, "ts_ms": ts})
    return bytes([0]) + schema_id.to_bytes(4, "big") + text.encode()


def registry(spark):
    return versions.registry(spark, {1: record("id", "full_name"), 2: record("id", "name", "amount", "extra"), 3: "no schema", 4: '{"fields": 5}'})


MESSAGES = [
    framed(1, {"id": 1, "full_name": "old"}),
    framed(2, {"id": 2, "name": "new", "amount": 7.25, "extra": {"k": [1]}}),
    framed(2, {"id": 3, "name": None, "amount": None}),
    framed(1, None, "d", {"id": 1, "full_name": "old"}, ts=4),
    framed(99, {"id": 5, "name": "later"}),
    framed(3, {"id": 6}),
    b"\x00\x00",
    bytes([0, 0, 0, 0, 1]) + b"{bad",
    None,
]


def test_both_versions_of_a_topic_decode(spark):
    got = versions.to_bronze(raw_messages(spark, MESSAGES), changelog.json_envelope(), registry(spark), READER)
    images = {(r["id"], r["op"]): json.loads(r["after"] or r["before"]) for r in got.where("op IS NOT NULL").collect()}
    assert images == {
        ("1", "c"): {"id": 1, "name": "old", "amount": 1.5},
        ("2", "c"): {"id": 2, "name": "new", "amount": 7.25, "extra": {"k": [1]}},
        ("3", "c"): {"id": 3, "name": None, "amount": None},
        ("1", "d"): {"id": 1, "name": "old", "amount": 1.5},
    }
    state = silver.merge_changes(silver.empty_silver(spark, ROW), got, ROW)
    assert [(r[1], r[2] and str(r[2])) for r in sorted(silver.current_rows(state).select("id", "name", "amount").collect())] == [("new", "7.25"), (None, None)]


def test_unknown_schemas_and_broken_messages_go_to_quarantine(spark):
    aside = versions.quarantine(raw_messages(spark, MESSAGES), changelog.json_envelope(), registry(spark), READER).collect()
    assert sorted((r["schema_id"], r["known"]) for r in aside if r["schema_id"] is not None) == [(1, True), (3, False), (99, False)]
    assert sorted(bytes(r["value"]) for r in aside) == sorted(MESSAGES[k] for k in (4, 5, 6, 7))


def test_replay_once_the_schema_is_known(spark):
    more = registry(spark).union(versions.registry(spark, {99: record("id", "label", "name")}))
    got = versions.to_bronze(raw_messages(spark, [MESSAGES[4]]), changelog.json_envelope(), more, READER).first()
    assert json.loads(got["after"]) == {"id": 5, "name": "later", "amount": 1.5}


def test_one_schema_per_id_and_a_plan_without_a_shuffle_of_messages(spark):
    twice = registry(spark).union(registry(spark)).union(versions.registry(spark, {2: record("id", "zz")}))
    got = versions.to_bronze(raw_messages(spark, MESSAGES), changelog.json_envelope(), twice, READER)
    assert got.where("op IS NOT NULL").count() == 4
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_the_same_on_a_stream(spark, tmp_path):
    from streambed import schemas
    from streambed.sources import topics
    from streambed.streaming.bronze import ALL_AVAILABLE

    raw_messages(spark, MESSAGES).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = topics.file_stream(spark, str(tmp_path / "in"), schemas.RAW_MESSAGE)
    bronze = versions.to_bronze(stream, changelog.json_envelope(), registry(spark), READER)
    bronze.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(**ALL_AVAILABLE).start(
        str(tmp_path / "out")
    ).awaitTermination()
    want = versions.to_bronze(raw_messages(spark, MESSAGES), changelog.json_envelope(), registry(spark), READER)
    assert rows(spark.read.schema(want.schema).parquet(str(tmp_path / "out"))) == rows(want)
