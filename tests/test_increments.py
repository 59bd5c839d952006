"""Marts by differences equal marts over the whole tables, after any changes."""

import random

from streambed import schemas
from streambed.operators import changelog, silver
from streambed.plans import increments, marts
from tests.helpers import rows

AT = "2024-01-01 00:00:00"
SHAPES = {"users": schemas.USERS, "devices": schemas.DEVICES, "cam_bills": schemas.BILLS}


def random_row(draw, name, key):
    user = draw.choice([None, 1, 2, 3, 4])
    return {
        "users": {"id": key, "name": f"n{draw.randrange(5)}", "email": "e"},
        "devices": {"id": key, "name": "d", "status": draw.choice([None, "online", "offline"]), "owner_id": user},
        "cam_bills": {"id": key, "user_id": user, "amount": round(draw.random() * 1e6, 2), "status": draw.choice(["paid", "pending", None])},
    }[name]


def batch(spark, draw, name, ts):
    import json

    found = []
    for seq in range(12):
        key, op = draw.randrange(1, 9), draw.choice("ccrud")
        after = None if op == "d" else json.dumps(random_row(draw, name, key))
        # Some changes are late: older than what is stored.
        found.append((str(key), None, after, op, ts - draw.choice([0, 0, 0, 25]), seq))
    return spark.createDataFrame(found, "id string, before string, after string, op string, ts_ms long, seq long")


def test_random_batches_with_deletes(spark):
    draw = random.Random(11)
    stored = {name: silver.empty_silver(spark, shape) for name, shape in SHAPES.items()}
    totals = {}
    ops = (*changelog.WRITE_OPS, changelog.DELETE_OP)
    for step in range(1, 4):
        changed = {}
        for name, shape in SHAPES.items():
            log = batch(spark, draw, name, 100 * step)
            newest = silver.newest_changes(log, shape, "id", ops)
            changed[name] = increments.differences(stored[name], newest)
            merged = silver.merge_changes(stored[name], log, shape)
            stored[name] = spark.createDataFrame(merged.collect(), silver.silver_schema(shape))
        parts = {
            "devices": increments.device_differences(changed["devices"]),
            "bills": increments.bill_differences(changed["cam_bills"]),
            "kpi": increments.kpi_differences(changed["users"], changed["devices"], changed["cam_bills"]),
        }
        for name, part in parts.items():
            part = spark.createDataFrame(part.collect(), part.schema)
            totals[name] = totals[name].unionByName(part) if name in totals else part
        live = {name: silver.current_rows(df) for name, df in stored.items()}
        want = marts.user_360(live["users"], live["devices"], live["cam_bills"], AT)
        assert rows(increments.user_360(live["users"], totals["devices"], totals["bills"], AT)) == rows(want)
        kpi = marts.executive_kpi(live["users"], live["devices"], live["cam_bills"], "2024-01-01", AT)
        assert rows(increments.executive_kpi(totals["kpi"], "2024-01-01", AT)) == rows(kpi)
    folded = increments.folded(totals["devices"], "owner_id")
    assert folded.count() <= 4 and folded.where("total_devices = 0 AND online_devices = 0 AND offline_devices = 0").count() == 0


def test_a_batch_that_changes_nothing_has_no_differences(spark):
    log = spark.createDataFrame(
        [("1", None, '{"id":1,"name":"a"}', "c", 5, 0), ("2", None, None, "d", 5, 0)],
        "id string, before string, after string, op string, ts_ms long, seq long",
    )
    ops = (*changelog.WRITE_OPS, changelog.DELETE_OP)
    newest = silver.newest_changes(log, schemas.USERS, "id", ops)
    stored = silver.merge_changes(silver.empty_silver(spark, schemas.USERS), log, schemas.USERS)
    assert increments.differences(stored, newest).count() == 0
    first = increments.differences(silver.empty_silver(spark, schemas.USERS), newest).collect()
    assert [(r["id"], r["_sign"]) for r in first] == [(1, 1)]


def test_whole_tables_to_begin_with(spark):
    bills = spark.createDataFrame([(1, 1, 1, None, "yearly", "paid", 5), (2, None, 1, None, "yearly", "paid", 5)], schemas.BILLS)
    devices = spark.createDataFrame([(1, "d", "t", None, 1, 5)], schemas.DEVICES)
    users = spark.createDataFrame([(1, "a", "e", 5)], schemas.USERS)
    got = increments.user_360(
        users, increments.device_differences(increments.inserted(devices)), increments.bill_differences(increments.inserted(bills)), AT
    )
    assert rows(got) == rows(marts.user_360(users, devices, bills, AT))
