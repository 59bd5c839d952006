"""Marts kept by differences.

A merge tells what it changed: each changed row's old image counts -1, its new one +1. Counts and sums
over these differences, added to stored totals, are the totals over the whole tables, at a cost that
follows the batch. Sums are exact decimals, so nothing drifts.

Stored totals are additive: differences may be appended to them and added up on read, or ``folded`` into one
row per key from time to time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streambed.functions import business
from streambed.operators import silver
from streambed.plans import marts

SIGN = "_sign"
TOTAL = marts.TOTAL


def differences(rows: DataFrame, newest: DataFrame, pk: str = "id") -> DataFrame:
    """What laying ``newest`` (silver rows, one per key) over ``rows`` (silver rows) changes.

    Live rows that go have ``_sign`` -1, live rows that come +1; an older change changes nothing. The stored
    rows meet the batch in inner joins, where the batch may be broadcast.
    """
    columns = [c for c in rows.columns if c not in silver.HIDDEN.names]
    position = lambda side: F.struct(f"{side}._ts_ms", f"{side}._seq")
    met = (
        rows.alias("t")
        .join(newest.alias("s"), F.col(f"t.{pk}") == F.col(f"s.{pk}"))
        .select(
            F.struct(*[F.col(f"t.`{c}`") for c in columns]).alias("old"),
            F.struct(*[F.col(f"s.`{c}`") for c in columns]).alias("new"),
            F.col("t._deleted").alias("gone"),
            F.col("s._deleted").alias("goes"),
            (position("s") >= position("t")).alias("newer"),
        )
        .where("newer AND NOT (old <=> new AND gone = goes)")
    )
    minus = met.where("NOT gone").select("old.*", F.lit(-1).alias(SIGN))
    plus = met.where("NOT goes").select("new.*", F.lit(1).alias(SIGN))
    known = rows.select(pk).join(newest.select(pk), pk, "left_semi")
    added = newest.join(known, pk, "left_anti").where("NOT _deleted").select(*columns, F.lit(1).alias(SIGN))
    return minus.unionByName(plus).unionByName(added)


def inserted(rows: DataFrame) -> DataFrame:
    """A whole table as differences, to begin with."""
    return rows.withColumn(SIGN, F.lit(1))


def _count(condition: Column | None = None) -> Column:
    return F.sum(F.col(SIGN) if condition is None else F.when(condition, F.col(SIGN)).otherwise(0)).cast("long")


def device_differences(devices: DataFrame) -> DataFrame:
    """Device counts per owner."""
    status = F.col("device_status")
    return (
        _signed(devices, marts.device_columns)
        .where(F.col("owner_id").isNotNull())
        .groupBy("owner_id")
        .agg(
            _count(F.col("device_id").isNotNull()).alias("total_devices"),
            _count(status == "online").alias("online_devices"),
            _count(status != "online").alias("offline_devices"),
        )
    )


def bill_differences(bills: DataFrame) -> DataFrame:
    """Bills and paid amounts per user; ``paid_bills`` tells when nothing paid is left."""
    return (
        _signed(bills, marts.bill_columns)
        .where(F.col("bill_user_id").isNotNull())
        .groupBy("bill_user_id")
        .agg(_count(F.col("bill_id").isNotNull()).alias("total_bills"), *_paid())
    )


def _paid() -> list[Column]:
    paid = F.col("bill_status") == "paid"
    amount = F.when(paid, F.col("amount") * F.col(SIGN)).otherwise(F.lit(0))
    return [F.sum(amount).cast(TOTAL).alias("total_spent"), _count(paid & F.col("bill_id").isNotNull()).alias("paid_bills")]


def _signed(rows: DataFrame, columns: Callable[..., DataFrame]) -> DataFrame:
    """The mart's columns of signed rows, with their sign."""
    return columns(rows, F.col(SIGN))


def kpi_differences(users: DataFrame, devices: DataFrame, bills: DataFrame) -> DataFrame:
    """One row: the changes of all that the executive KPI counts."""
    online = F.col("device_status") == "online"
    parts = [
        users.agg(_count().alias("users")),
        _signed(devices, marts.device_columns).agg(_count().alias("devices"), _count(online).alias("online")),
        _signed(bills, marts.bill_columns).agg(*_paid()).withColumnsRenamed({"total_spent": "revenue", "paid_bills": "paid"}),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def folded(totals: DataFrame, *keys: str) -> DataFrame:
    """Stored totals added up: one row per key, without the keys that have nothing left."""
    sums = [c for c in totals.columns if c not in keys]
    kinds = {f.name: f.dataType for f in totals.schema.fields}
    added = totals.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(kinds[c]).alias(c) for c in sums])
    if not keys:
        return added
    left = F.lit(False)
    for c in sums:
        left = left | (F.col(c) != 0)
    return added.where(left)


def user_360(users: DataFrame, devices: DataFrame, bills: DataFrame, as_of: str | None = None) -> DataFrame:
    """The user mart from stored totals: ``devices`` of ``device_differences``, ``bills`` of ``bill_differences``."""
    spent = F.col("total_spent")
    return (
        marts.user_columns(users)
        .join(folded(devices, "owner_id"), F.col("user_id") == F.col("owner_id"), "left")
        .join(folded(bills, "bill_user_id"), F.col("user_id") == F.col("bill_user_id"), "left")
        .select(
            "user_id",
            "user_name",
            "email",
            *[marts.zero_if_null(c).alias(c) for c in ("total_devices", "online_devices", "offline_devices", "total_bills")],
            marts.zero_if_null("total_spent").cast(TOTAL).alias("total_spent"),
            business.vip_tier(spent).alias("vip_tier"),
            F.lit("monthly").alias("primary_plan"),
            marts.run_time(as_of).alias("updated_at"),
        )
    )


def executive_kpi(totals: DataFrame, report_date: str, as_of: str | None = None) -> DataFrame:
    """The KPI row from stored totals of ``kpi_differences``."""
    return marts.kpi_row(folded(totals), report_date, as_of)
