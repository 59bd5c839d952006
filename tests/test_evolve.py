"""Growing schemas: merged trees hold both sides' values, rows are brought along."""

import json

from pyspark.sql import types as T

from streambed import schemas
from streambed.operators import evolve
from streambed.sinks import change_table as ct
from streambed.streaming.bronze import ALL_AVAILABLE
from streambed.streaming.silver import start_replica, start_silver
from streambed.sources import topics
from tests.helpers import ROW, changes, raw_messages, rows


def ddl(text):
    return T.DataType.fromDDL(text)


def test_types_are_widened_to_what_holds_both(spark):
    for a, b, want in [
        ("int", "bigint", "bigint"), ("bigint", "decimal(5,2)", "decimal(21,2)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("int", "float", "double"), ("decimal(38,2)", "decimal(38,10)", "double"), ("date", "timestamp", "timestamp"),
        ("boolean", "int", "string"), ("void", "int", "int"), ("array<int>", "array<double>", "array<double>"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("struct<a:int>", "string", "string"),
        ("struct<a:int,b:struct<c:int>>", "struct<b:struct<c:double,d:string>,e:date>", "struct<a:int,b:struct<c:double,d:string>,e:date>"),
    ]:
        assert evolve.merge_types(ddl(a), ddl(b)).simpleString() == want, (a, b)


def test_rows_keep_their_values_under_the_wider_schema(spark):
    old = spark.sql("SELECT 1 AS id, array(named_struct('a', 1)) AS list, named_struct('x', 2) AS s, map('k', 1) AS m, 5 AS n")
    new = spark.sql(
        "SELECT 2L AS id, array(named_struct('a', 1.5D, 'b', 'z')) AS list, named_struct('y', true) AS s, map('k', 2.5D) AS m, 'five' AS n, 7 AS extra"
    )
    got = {r["id"]: r.asDict(True) for r in evolve.union_evolved(old, new).collect()}
    assert got[1] == {"id": 1, "list": [{"a": 1.0, "b": None}], "s": {"x": 2, "y": None}, "m": {"k": 1.0}, "n": "5", "extra": None}
    assert got[2] == {"id": 2, "list": [{"a": 1.5, "b": "z"}], "s": {"x": None, "y": True}, "m": {"k": 2.5}, "n": "five", "extra": 7}
    odd = evolve.conform(spark.sql("SELECT CAST(NULL AS struct<a:int>) AS s"), T.StructType([T.StructField("s", ddl("struct<a:bigint,b:int>"))]))
    assert odd.first()["s"] is None


def test_observed_columns_are_those_with_values(spark):
    texts = ['{"id":1,"a":null,"b":{"c":null,"d":1}}', '{"id":2,"e":[null]}', "{bad", None]
    df = spark.createDataFrame([(t,) for t in texts], "after string")
    assert evolve.observed_schema(df).simpleString() == "struct<b:struct<d:bigint>,id:bigint>"
    assert evolve.observed_schema(df.limit(0)).simpleString() == "struct<>"


def log(key, op, ts, **fields):
    after = None if op == "d" else json.dumps({"id": key, **fields})
    return (str(key), None, after, op, ts, 0)


def test_columns_and_wider_types_reach_the_stored_table(spark, tmp_path):
    table = ct.ChangeTable(str(tmp_path / "t"), ROW, evolve=True, fold_share=100.0)
    batches = [
        [log(1, "c", 1, name="a"), log(2, "c", 1, name="b", score=None)],
        [log(3, "c", 2, name="c", score=7, tags={"x": 1})],
        [log(4, "c", 3, name="d", score=2.5, tags={"y": "z"}), log(2, "d", 3)],
        [log(1, "u", 4, name="a2")],
    ]
    for n, batch in enumerate(batches):
        ct.append_changes(spark, table, changes(spark, batch))
        if n == 2:
            ct.fold(spark, table)
    found = ct.read_current(spark, table)
    assert found.columns[:3] == ROW.names and set(found.columns[3:]) == {"score", "tags"}
    assert found.schema["tags"].dataType.simpleString() == "struct<x:bigint,y:string>"
    got = {r["id"]: (r["name"], None if r["score"] is None else float(r["score"]), r["tags"] and r["tags"].asDict()) for r in found.collect()}
    assert got == {1: ("a2", None, None), 3: ("c", 7.0, {"x": 1, "y": None}), 4: ("d", 2.5, {"x": None, "y": "z"})}
    plain = ct.ChangeTable(table.path, ROW)
    assert ct.read_current(spark, plain).columns == ROW.names


def test_a_wider_declared_type_is_taken_up(spark, tmp_path):
    narrow, wide = schemas.columns("id BIGINT, size INT"), schemas.columns("id BIGINT, size BIGINT")
    ct.append_changes(spark, ct.ChangeTable(str(tmp_path / "t"), narrow, evolve=True), changes(spark, [log(1, "c", 1, size=5)]))
    table = ct.ChangeTable(str(tmp_path / "t"), wide, evolve=True)
    ct.append_changes(spark, table, changes(spark, [log(2, "c", 1, size=5_000_000_000)]))
    assert rows(ct.read_current(spark, table)) == [(1, 5), (2, 5_000_000_000)]


def test_a_new_source_column_goes_from_message_to_silver_to_replica(spark, tmp_path):
    from streambed.operators import changelog

    def message(key, op, ts, **fields):
        before, after = ({"id": key}, None) if op == "d" else (None, {"id": key, **fields})
        return json.dumps({"before": before, "after": after, "source": {"lsn": ts}, "op": op, "ts_ms": ts})

    for texts in ([message(1, "c", 1, name="a")], [message(2, "c", 2, name="b", note="new")], [message(1, "d", 3)]):
        raw = raw_messages(spark, texts)
        bronze = changelog.to_bronze(raw, changelog.json_envelope())
        bronze.coalesce(1).write.mode("append").parquet(str(tmp_path / "bronze"))
    got = {}
    for name, start in (("silver", start_silver), ("replica", start_replica)):
        table = ct.ChangeTable(str(tmp_path / name), ROW, evolve=True)
        stream = topics.file_stream(spark, str(tmp_path / "bronze"), schemas.BRONZE, max_files=1)
        start(stream, table, str(tmp_path / f"ck-{name}"), trigger=ALL_AVAILABLE).awaitTermination()
        got[name] = {r["id"]: r["note"] for r in ct.read_current(spark, table).collect()}
    assert got == {"silver": {2: "new"}, "replica": {1: None, 2: "new"}}
