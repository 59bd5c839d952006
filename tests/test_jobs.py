"""The jobs end to end, with messages in files where the topics would be."""

import json

from pyspark.sql import functions as F

from streambed import schemas
from streambed.operators import changelog
from streambed.plans import jobs, marts
from streambed.sources import lake, topics
from streambed.streaming.bronze import ALL_AVAILABLE
from tests.helpers import raw_messages, rows

AT = "2024-01-01 00:00:00"
DATA = {
    "users": [{"id": 1, "name": "O'Brien", "email": "a@x"}, {"id": 2, "name": "b", "email": "b@x"}],
    "devices": [{"id": 1, "name": "d", "device_type": "cam", "status": "online", "owner_id": 1}],
    "cam_bills": [{"id": 1, "user_id": 1, "device_id": 1, "amount": 600000.5, "plan_type": "yearly", "status": "paid"}],
}


def send(spark, root, name, row, op, ts):
    after, before = (None, {"id": row["id"]}) if op == "d" else (row, None)
    text = json.dumps({"before": before, "after": after, "source": {"table": name, "lsn": ts}, "op": op, "ts_ms": ts})
    raw_messages(spark, [text, None]).coalesce(1).write.mode("append").parquet(f"{root}/topics/{name}")


def ingest(spark, root, monkeypatch):
    """Run the bronze job with file streams in place of the topics."""

    def from_files(spark, servers, topic, max_offsets=None):
        name = topic.split(".")[-1]
        if not lake.table_exists(spark, f"{root}/topics/{name}"):
            raise RuntimeError(f"no topic {topic}")
        return topics.file_stream(spark, f"{root}/topics/{name}", schemas.RAW_MESSAGE)

    monkeypatch.setattr(jobs.topics, "kafka_topic", from_files)
    return jobs.run_bronze(spark, root, "nowhere:9092", "cdc_data.public", trigger=ALL_AVAILABLE)


def test_bronze_silver_gold(spark, tmp_path, monkeypatch, capsys):
    root = str(tmp_path)
    for name, data in DATA.items():
        for row in data:
            send(spark, root, name, row, "c", 1)
    assert ingest(spark, root, monkeypatch) == {}
    assert jobs.run_silver(spark, root) == {}
    assert jobs.run_gold(spark, root, "2024-01-01", AT) == {
        "user_360": 2, "device_performance": 1, "daily_executive_kpi": 1,
    }
    exported = spark.read.schema(schemas.USER_360).json(f"{root}/gold/user_360")
    got = {r["user_id"]: r for r in exported.collect()}
    assert (got[1]["user_name"], got[1]["vip_tier"], float(got[1]["total_spent"])) == ("O'Brien", "GOLD", 600000.5)
    assert got[2]["vip_tier"] == "STANDARD"

    jobs.run_gold(spark, root, "2024-01-01", "2024-01-01 06:00:00")
    assert spark.read.json(f"{root}/gold/user_360").count() == 4
    kept = jobs.read_gold(spark, root, "user_360").collect()
    assert sorted((r["user_id"], r["updated_at"]) for r in kept) == [
        (1, "2024-01-01 06:00:00"), (2, "2024-01-01 06:00:00"),
    ]
    assert jobs.read_gold(spark, root, "daily_executive_kpi").count() == 1
    assert jobs.read_gold(spark, root, "device_performance").count() == 1

    send(spark, root, "users", {"id": 2}, "d", 5)
    send(spark, root, "users", {**DATA["users"][0], "name": "new"}, "u", 6)
    ingest(spark, root, monkeypatch)
    jobs.run_silver(spark, root, max_files=1)
    jobs.run_silver(spark, root)
    live = jobs.read_silver(spark, root, "users")
    assert [(r["id"], r["name"]) for r in live.collect()] == [(1, "new")]
    counts = jobs.run_check(spark, root)
    assert counts == {"users": 1, "devices": 1, "cam_bills": 1}
    assert jobs.run_check(spark, root, "bronze")["users"] == 4
    assert "silver users: 1 rows" in capsys.readouterr().out


def test_missing_topics_and_tables(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    send(spark, root, "users", DATA["users"][0], "r", 1)
    raw_messages(spark, ["{bad"]).coalesce(1).write.mode("append").parquet(f"{root}/topics/users")
    assert set(ingest(spark, root, monkeypatch)) == {"devices", "cam_bills"}
    assert spark.read.parquet(f"{root}/quarantine/users").count() == 1
    assert set(jobs.run_silver(spark, root)) == {"devices", "cam_bills"}
    made = jobs.gold_marts(spark, root, "2024-01-01", AT)
    assert made["user_360"].count() == 1 and made["device_performance"].count() == 0
    empty_root = str(tmp_path / "nothing")
    try:
        jobs.run_gold(spark, empty_root, "2024-01-01")
        raise AssertionError("a lake without users must stop the job")
    except lake.MissingTable:
        pass


def test_gold_over_silver_equals_gold_over_the_source(spark, tmp_path):
    """The shared tables sent through the change log give the marts of the tables themselves."""
    from streambed.catalog import views
    from streambed.sinks.silver_table import apply_changes
    from tests.conftest import SMALL

    root = str(tmp_path)
    source = {"users": views.users, "devices": views.devices, "cam_bills": views.invoices}
    for name, view in source.items():
        snapshot = view(spark, SMALL)
        log = changelog.snapshot_to_changes(snapshot, "id", 1)
        apply_changes(spark, jobs.silver_table(root, name), log)
        assert rows(jobs.read_silver(spark, root, name)) == rows(snapshot)
    want = marts.user_360(*[view(spark, SMALL) for view in source.values()], AT)
    assert rows(jobs.gold_marts(spark, root, "2024-01-01", AT)["user_360"]) == rows(want)
    assert want.where(F.col("vip_tier") == "STANDARD").count() > 0


def test_failed_tables_give_a_failing_exit(spark, tmp_path, monkeypatch):
    import pytest

    monkeypatch.setattr(jobs, "build_session", lambda *_: spark)
    for job in ("silver", "check"):
        with pytest.raises(SystemExit) as stopped:
            jobs.main([job, "--root", str(tmp_path)])
        assert stopped.value.code == 1


def test_files_job(spark, tmp_path):
    root = str(tmp_path)
    folder = tmp_path / "files" / "device_logs" / "year=1970" / "month=01"
    folder.mkdir(parents=True)
    log = {"event_id": "a", "timestamp": 5, "device_id": 1, "event_type": "heartbeat"}
    (folder / "one.json").write_text(json.dumps(log) + "\n{broken\n")
    assert set(jobs.run_files(spark, root)) == {"payments"}
    (tmp_path / "files" / "payments").mkdir()
    head = "partner_trans_id,bill_id,user_id,payment_gateway,trans_amount,partner_fee,trans_time,trans_status,bank_code"
    line = "VNP_1,1,2,VNPay,10.50,0.12,2024-03-05 10:00:00,SUCCESS,BIDV"
    (tmp_path / "files" / "payments" / "one.csv").write_text(f"{head}\n{line}\n")
    assert jobs.run_files(spark, root) == {}
    assert spark.read.parquet(f"{root}/facts/device_logs").count() == 1
    assert spark.read.parquet(f"{root}/rejected/device_logs").count() == 1
    assert spark.read.parquet(f"{root}/facts/payments").count() == 1


def test_fold_job(spark, tmp_path):
    from streambed.sinks import change_table
    from tests.helpers import changes

    root = str(tmp_path)
    table = jobs.silver_table(root, "users")
    for ts in (1, 2):
        change_table.append_changes(spark, table, changes(spark, [(1, "c", ts)]))
    assert jobs.run_fold(spark, root) == {}
    assert change_table.finished(spark, table, "snapshots") == [2]
    assert jobs.read_silver(spark, root, "users").count() == 1


def test_many_runs_of_a_mart_are_read_in_two_parts(spark, tmp_path, monkeypatch):
    """A hundred exports: the current part and the last run are all that a reader opens."""
    root = str(tmp_path)
    rows = lambda run: spark.createDataFrame(
        [(k, f"u{k}", "e", 1, 1, 0, run, None, "SILVER", "monthly", f"2024-01-01 00:{run // 60:02d}:{run % 60:02d}") for k in range(run % 7 + 1)],
        schemas.USER_360,
    )
    for run in range(1, 99):
        rows(run).coalesce(1).write.json(f"{root}/gold/user_360/run={run:012d}")
    want = sorted((r["user_id"], r["total_bills"]) for r in jobs.read_gold(spark, root, "user_360").collect())
    assert jobs.fold_gold(spark, root, "user_360") and not jobs.fold_gold(spark, root, "user_360")
    assert len(jobs.gold_parts(spark, root, "user_360")) == 1
    assert sorted((r["user_id"], r["total_bills"]) for r in jobs.read_gold(spark, root, "user_360").collect()) == want
    monkeypatch.setattr(jobs, "gold_marts", lambda *_: {"user_360": rows(99)})
    assert jobs.run_gold(spark, root, "2024-01-01") == {"user_360": 99 % 7 + 1}
    parts = jobs.gold_parts(spark, root, "user_360")
    assert len(parts) == 2 and jobs.gold_runs(spark, root, "user_360")[-1] == 99
    got = {r["user_id"]: r["total_bills"] for r in jobs.read_gold(spark, root, "user_360").collect()}
    assert got == dict(want) | {0: 99, 1: 99}
    jobs.fold_gold(spark, root, "user_360")
    rows(100).coalesce(1).write.json(f"{root}/gold/user_360/run={100:012d}")
    jobs.fold_gold(spark, root, "user_360")
    assert jobs.folded_gold(spark, root, "user_360") == [99, 100]
    assert jobs.read_gold(spark, root, "daily_executive_kpi").count() == 0
