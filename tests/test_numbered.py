"""Stored key counters and sketches that roll up."""

import os

from pyspark.sql import functions as F

from streambed import schemas
from streambed.plans import sketches
from streambed.sinks import numbered
from streambed.sinks.numbered import NumberedTable

SCHEMA = schemas.columns("id BIGINT, name STRING")


def batch(spark, n, tasks=3):
    return spark.range(n).select(F.format_string("n%d", "id").alias("name")).repartition(tasks)


def test_two_batches_and_a_truncation(spark, tmp_path):
    table = NumberedTable(str(tmp_path / "t"), SCHEMA)
    ids = lambda: sorted(r["id"] for r in numbered.read_rows(spark, table).collect())
    assert ids() == [] and numbered.high_water(spark, table) == 0
    assert numbered.append_rows(spark, table, batch(spark, 50)) == 50
    assert numbered.append_rows(spark, table, batch(spark, 30)) == 30
    assert numbered.append_rows(spark, table, batch(spark, 0)) == 0
    assert ids() == list(range(1, 81))
    numbered.truncate(spark, [table])
    assert ids() == [] and spark.read.schema(SCHEMA).parquet(f"{table.path}/rows").count() == 0
    numbered.append_rows(spark, table, batch(spark, 5))
    assert ids() == [1, 2, 3, 4, 5]
    numbered.truncate(spark, [table], restart=False)
    numbered.append_rows(spark, table, batch(spark, 2))
    assert ids() == [6, 7]


def test_a_stopped_draw_is_taken_up_again(spark, tmp_path):
    table = NumberedTable(str(tmp_path / "t"), SCHEMA)
    numbered.append_rows(spark, table, batch(spark, 3))
    numbered._store(spark, table, 8)
    os.remove(f"{table.path}/counter/{8:020d}/_SUCCESS")
    numbered.append_rows(spark, table, batch(spark, 5))
    assert sorted(r["id"] for r in numbered.read_rows(spark, table).collect()) == list(range(1, 9))
    # Drawn, but its rows never written: a gap, no key twice.
    numbered._store(spark, table, 10)
    numbered.append_rows(spark, table, batch(spark, 2))
    assert sorted(r["id"] for r in numbered.read_rows(spark, table).collect())[-2:] == [11, 12]


def test_merged_days_are_as_good_as_one_sketch(spark):
    day = 86_400_000
    logs = spark.range(60_000).select(
        (F.col("id") % 59 * day).alias("timestamp"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("device_id"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("event_type"),
    )
    daily = sketches.daily_devices(logs)
    assert daily.select(F.max(F.length("devices_sketch"))).first()[0] < 8192
    for unit in ("month", "year"):
        rolled = sketches.rolled_up(daily, unit).join(sketches.exact(logs, unit), [unit, "event_type"]).collect()
        assert len(rolled) == (4 if unit == "month" else 2)
        for r in rolled:
            assert abs(r["devices"] - r["exact_devices"]) <= 4 * sketches.STANDARD_ERROR * r["exact_devices"]
    none = sketches.rolled_up(sketches.daily_devices(logs.withColumn("device_id", F.lit(None).cast("long")))).first()
    assert none["devices"] == 0 and none["events"] > 0
