import json

from pyspark.sql import functions as F

from streambed.functions import wire
from streambed.operators import changelog
from tests.helpers import ROW, changes, image, raw_messages, rows, table


def envelope(key, op="c", ts=5, **fields):
    after = {"id": key, **fields}
    return json.dumps({"before": None, "after": after, "source": {"table": "t", "lsn": 3}, "op": op, "ts_ms": ts})


def bronze(spark, texts, **at):
    return changelog.to_bronze(raw_messages(spark, texts, **at), changelog.json_envelope())


def test_tombstones_are_dropped_and_columns_flattened(spark):
    got = bronze(spark, [envelope(1, name="a", amount=12.5), None]).collect()
    assert len(got) == 1
    row = got[0]
    assert (row["id"], row["op"], row["ts_ms"], row["seq"]) == ("1", "c", 5, 3)
    assert (row["year"], row["month"], row["day"]) == (2024, 3, 5)
    assert row["before"] is None and json.loads(row["after"])["amount"] == 12.5


def test_delete_takes_its_id_from_before(spark):
    text = json.dumps({"before": {"id": 4}, "after": None, "source": {"lsn": 1}, "op": "d", "ts_ms": 1})
    assert bronze(spark, [text]).first()["id"] == "4"


def test_bad_and_short_messages_are_kept_and_can_be_quarantined(spark):
    broken = b"\x00\xff\xff\xff\xff\xfe\xff"
    texts = [envelope(1, name="a"), "{bad", b"\x00\x01", broken]
    got = bronze(spark, texts)
    assert got.count() == 4 and got.where("op IS NULL").count() == 3
    aside = changelog.quarantine(raw_messages(spark, texts), changelog.json_envelope()).collect()
    assert sorted(bytes(r["value"]) for r in aside) == [b"\x00\x00\x00\x00\x09{bad", b"\x00\x01", broken]


def test_frame_parts(spark):
    df = raw_messages(spark, ["{}", b"\x00\x00"])
    got = df.select(wire.frame_schema_id(F.col("value")).alias("s"), wire.frame_payload(F.col("value")).alias("p"))
    assert [(r["s"], bytes(r["p"])) for r in got.collect()] == [(9, b"{}"), (None, b"")]
    odd = raw_messages(spark, [b"\x00\xff\xff\xff\xff"])
    assert odd.select(wire.frame_schema_id(F.col("value"))).first()[0] is None
    framed = df.limit(1).select(wire.frame(70000, F.lit("x")).alias("v")).select(wire.frame_schema_id(F.col("v")))
    assert framed.first()[0] == 70000


def test_quotes_and_missing_fields_survive_the_payload(spark):
    names = ["O'Brien", 'a"b', "a\\b", "Nguyễn"]
    log = changes(spark, [(str(i), None, image(i, n), "c", 1, 0) for i, n in enumerate(names)])
    got = changelog.expand_payload(log, ROW, F.col("after"))
    assert got.columns == ["id", "name", "amount"]
    assert [(r["name"], r["amount"]) for r in got.orderBy("id").collect()] == [(n, None) for n in names]


def test_inferred_schema_sees_every_row(spark):
    texts = ['{"id":1,"name":null}', '{"id":2,"name":"O\'Brien","amount":1}', '{"id":3,"amount":1.5}', "{bad"]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    schema = changelog.infer_json_schema(df, "j")
    assert set(schema.names) == {"id", "name", "amount"}
    assert schema["name"].dataType.simpleString() == "string"
    assert schema["amount"].dataType.simpleString().startswith("decimal")


def test_bronze_keeps_every_field_and_digit(spark):
    source = '{"db":"shop","lsn":3,"schema":"public","table":"t","txId":77}'
    after = '{"amount":12.345,"big":12345678901234567890.12,"extra":{"k":[1,2.5]},"id":1,"name":"a"}'
    text = f'{{"before":null,"after":{after},"source":{source},"op":"c","ts_ms":5}}'
    row = bronze(spark, [text]).first()
    assert (row["after"], row["source"], row["before"], row["seq"]) == (after, source, None, 3)


def test_a_new_column_goes_from_message_to_silver(spark):
    from streambed.operators import silver
    from streambed import schemas

    wide = schemas.columns("id BIGINT, name STRING, note STRING")
    state = silver.merge_changes(silver.empty_silver(spark, wide), bronze(spark, [envelope(1, name="a", note="new")]), wide)
    assert [(r["id"], r["name"], r["note"]) for r in state.collect()] == [(1, "a", "new")]


def test_inferred_schema_of_odd_names_and_nested_values(spark):
    texts = [
        '{"VOIDED": true, "OBJECT<x": 1, "a`b": {"OBJECT<": [null, null]}, "list": [{"VOID": 1}, {"q, r: s": "t"}], "mixed": 1}',
        '{"VOIDED": false, "nothing": null, "mixed": "text"}',
    ]
    schema = changelog.infer_json_schema(spark.createDataFrame([(t,) for t in texts], "j string"), "j")
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds["VOIDED"] == "boolean" and kinds["OBJECT<x"] == "bigint" and kinds["nothing"] == kinds["mixed"] == "string"
    assert schema["a`b"].dataType["OBJECT<"].dataType.simpleString() == "array<string>"
    assert set(schema["list"].dataType.elementType.names) == {"VOID", "q, r: s"}
    row = changelog.expand_payload(spark.createDataFrame([(texts[0],)], "j string"), schema, F.col("j")).first()
    assert row["VOIDED"] is True and row["OBJECT<x"] == 1 and row["mixed"] == "1"


def test_first_image_prefers_after_and_falls_back_to_before(spark):
    log = changes(spark, [(1, "d", 1), (2, "c", 5, 0, "x"), (3, "c", 9, 0, "y")])
    assert json.loads(changelog.first_image(log).first()["image"])["name"] == "x"
    only_before = changes(spark, [(1, "d", 1)])
    assert json.loads(changelog.first_image(only_before).first()["image"]) == {"id": 1}
    assert changelog.first_image(changes(spark, [])).count() == 0


def test_diff_then_merge_gives_back_the_new_snapshot(spark):
    from streambed.operators import silver

    old = table(spark, ROW, [(1, "a", None), (2, "b", None), (3, None, None)])
    new = table(spark, ROW, [(2, "b", None), (3, "c", None), (4, None, None)])
    diff = changelog.diff_snapshots(old, new, "id", 20)
    assert {r["id"]: r["op"] for r in diff.collect()} == {"1": "d", "3": "u", "4": "c"}
    start = silver.merge_changes(
        silver.empty_silver(spark, ROW), changelog.snapshot_to_changes(old, "id", 10), ROW
    )
    assert rows(silver.current_rows(start)) == rows(old)
    assert rows(silver.current_rows(silver.merge_changes(start, diff, ROW))) == rows(new)
