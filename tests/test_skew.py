"""Hot keys: results stay whole, and the plans split or pre-aggregate them."""

import json

import pytest
from pyspark.sql import functions as F

from streambed.operators import latest, silver
from streambed.operators.joins import full_join_fan_out, left_join_fan_out
from streambed.plans import facts, marts
from tests.helpers import ROW

ROWS = 60000


@pytest.fixture
def low_limits(spark):
    """Skew handling that starts at a few kilobytes, and no broadcast joins."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in old.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def many_rows(spark):
    """A third of the rows under key 7, a few without a key."""
    third = F.col("id") < ROWS // 3
    key = F.when(third, F.lit(7)).when(F.col("id") == ROWS - 1, F.lit(None)).otherwise(F.col("id"))
    return spark.range(0, ROWS, 1, 16).select(key.alias("many_key"), F.col("id").alias("n"), F.md5(F.col("id").cast("string")).alias("text"))


def one_rows(spark):
    return spark.range(0, 2 * ROWS, 1, 16).select(F.col("id").alias("one_key"), F.lit("x").alias("label"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_left_fan_out_splits_the_hot_key(low_limits):
    spark = low_limits
    got = left_join_fan_out(one_rows(spark), many_rows(spark), "one_key", "many_key")
    assert "skew=true" in final_plan(got)
    plain = one_rows(spark).join(many_rows(spark), F.col("one_key") == F.col("many_key"), "left")
    columns = ["one_key", "label", "many_key", "n", "text"]
    assert got.count() == plain.count()
    assert got.select(*columns).exceptAll(plain.select(*columns)).isEmpty()


def test_full_fan_out_splits_the_hot_key(low_limits):
    spark = low_limits
    got = full_join_fan_out(one_rows(spark), many_rows(spark), "one_key", "many_key")
    assert "skew=true" in final_plan(got)
    plain = one_rows(spark).join(many_rows(spark), F.col("one_key") == F.col("many_key"), "full_outer")
    columns = ["one_key", "label", "many_key", "n", "text"]
    assert got.count() == plain.count()
    assert got.select(*columns).exceptAll(plain.select(*columns)).isEmpty()


def hot_log(spark, op):
    """A change log with a third of the changes on key 7."""
    key = F.when(F.col("id") < ROWS // 3, F.lit(7)).otherwise(F.col("id"))
    base = spark.range(0, ROWS, 1, 16).select(
        key.cast("string").alias("id"),
        F.lit(None).cast("string").alias("before"),
        F.to_json(F.struct(key.alias("id"), F.col("id").cast("string").alias("name"))).alias("after"),
        op.alias("op"),
        F.lit(1).cast("long").alias("ts_ms"),
        F.col("id").alias("seq"),
    )
    return base


def test_latest_cuts_rows_before_the_shuffle(spark):
    log = hot_log(spark, F.lit("u"))
    for form, marker in ((latest.latest_per_key, "WindowGroupLimit"), (latest.latest_per_key_agg, "partial_max_by")):
        df = form(log, "id")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex(marker) > plan.index("Exchange hashpartitioning(id"), plan
        hot = df.where("id = '7'").collect()
        assert len(hot) == 1 and json.loads(hot[0]["after"])["name"] == str(ROWS // 3 - 1)


def test_replayed_inserts_of_one_key_all_stay_and_their_join_is_split(low_limits):
    spark = low_limits
    even_updates = F.when(F.col("id") >= ROWS - 100, "u").otherwise("c")
    got = silver.crud_reconstruct(hot_log(spark, even_updates), ROW)
    assert "skew=true" in final_plan(got)
    assert got.where("id = 7").count() == ROWS // 3 and got.count() == ROWS


def test_merge_shuffles_the_changes_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = silver.empty_silver(spark, ROW)
        plan = silver.merge_changes(state, hot_log(spark, F.lit("u")), ROW)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # one per side


def hot_lake(spark):
    """Device 7 has a third of the bills; a third of the devices have no owner, a third owner 5."""
    n = F.col("id")
    users = spark.range(0, 20000, 1, 16).select(
        n.alias("id"), F.md5(n.cast("string")).alias("name"), F.lit("e").alias("email"), F.lit(0).cast("long").alias("updated_at")
    )
    owner = F.when(n < ROWS // 3, F.lit(None)).when(n < 2 * ROWS // 3, F.lit(5)).otherwise(n).cast("long")
    devices = spark.range(0, ROWS, 1, 16).select(
        n.alias("id"),
        F.md5(n.cast("string")).alias("name"),
        F.lit("cam").alias("device_type"),
        F.lit("online").alias("status"),
        owner.alias("owner_id"),
        F.lit(0).cast("long").alias("updated_at"),
    )
    bills = spark.range(0, ROWS, 1, 16).select(
        n.alias("id"),
        n.alias("user_id"),
        F.when(n < ROWS // 3, F.lit(7)).otherwise(n).cast("long").alias("device_id"),
        n.cast("decimal(15,2)").alias("amount"),
        F.md5(n.cast("string")).alias("plan_type"),
        F.lit("paid").alias("status"),
        F.lit(0).cast("long").alias("updated_at"),
    )
    return users, devices, bills


def test_device_mart_with_a_hot_device_and_hot_owners(low_limits):
    users, devices, bills = hot_lake(low_limits)
    got = marts.device_performance(devices, users, bills, "2024-01-01 00:00:00")
    assert final_plan(got).split("== Initial Plan ==")[0].count("skew=true") >= 2
    per_device = {r["device_id"]: r["n"] for r in got.groupBy("device_id").agg(F.count("*").alias("n")).collect()}
    assert len(per_device) == ROWS and per_device[7] == ROWS // 3
    assert sum(per_device.values()) == bills.count() + ROWS // 3 - 1
    assert got.where("owner_name = 'Unassigned'").count() > 0
    assert got.where("owner_id = 5 AND owner_name <> 'Unassigned'").count() > 0


def test_user_mart_aggregates_before_it_joins(low_limits):
    users, devices, bills = hot_lake(low_limits)
    got = marts.user_360(users, devices, bills, "2024-01-01 00:00:00")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 2 and plan.count("Exchange hashpartitioning") == 3
    assert {r["user_id"]: r["total_devices"] for r in got.where("user_id = 5").collect()} == {5: ROWS // 3}


def test_reconciliation_with_a_hot_bill(low_limits):
    spark = low_limits
    _, _, bills = hot_lake(spark)
    paid = bills.select(
        F.lit("t").alias("partner_trans_id"),
        F.col("device_id").alias("bill_id"),
        "user_id",
        F.col("plan_type").alias("payment_gateway"),
        F.col("amount").alias("trans_amount"),
        F.col("amount").alias("partner_fee"),
        F.lit("SUCCESS").alias("trans_status"),
    )
    got = facts.reconcile_payments(bills, paid)
    assert "skew=true" in final_plan(got)
    outcomes = {r["outcome"]: r["n"] for r in got.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    third = ROWS // 3
    assert outcomes == {"matched": ROWS - third + 1, "amount_mismatch": third - 1, "missing_payment": third - 1}


def test_devices_without_an_owner_are_dealt_over_the_tasks(spark):
    kept = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name) for name in kept}
    try:
        for name, value in kept.items():
            spark.conf.set(name, value)
        users, devices, _ = hot_lake(spark)
        nobodys = marts.device_columns(devices.withColumn("owner_id", F.lit(None).cast("long")))
        per_task = marts.owned_devices(nobodys, users).groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in per_task) == ROWS and max(r["count"] for r in per_task) < ROWS / 3


def test_the_aggregate_sorts_the_results_columns_only(spark, tmp_path):
    from datetime import datetime

    from streambed.catalog import queries, views

    at = datetime(2024, 1, 2)
    rows = {"orders": [(1, 5, "O", 10.0, at, "1-URGENT"), (2, 5, "F", 20.0, at, "5-LOW")],
            "lineitem": [(1, 7, 8, n, 1.0, 30.0 + n, 0.0, 0.0, "N", "O", at) for n in (1, 2)]}
    for name, data in rows.items():
        spark.createDataFrame(data, views.TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = queries.latest_per_key_agg(spark, str(tmp_path))
    newest = 2 * views.LINE_STEP + 7
    assert sorted((r.id, r.op, r.seq, r.amount) for r in got.collect()) == [("1", "u", newest, 32.0), ("2", "r", 0, 20.0)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(line for line in plan.splitlines() if "max_by" in line)
    assert not any(f"{image}#" in aggregate for image in ("before", "after", "source", "year"))
