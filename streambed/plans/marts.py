"""The three gold marts.

Inputs are silver rows (users, devices, bills); ``as_of`` is the run time written to
``updated_at``, an argument so that a re-run gives the same output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streambed.functions import business, moments
from streambed.operators.joins import left_join_fan_out

MONEY = "decimal(15,2)"
TOTAL = "decimal(38,2)"
# Values of the join key that deals devices without an owner over the tasks.
DEALT = 1024


def run_time(as_of: str | None) -> Column:
    return moments.epoch_text(F.current_timestamp() if as_of is None else F.lit(as_of))


def user_columns(users: DataFrame) -> DataFrame:
    return users.select(F.col("id").try_cast("long").alias("user_id"), F.col("name").alias("user_name"), "email")


def device_columns(devices: DataFrame, *more: Column) -> DataFrame:
    return devices.select(
        F.col("id").try_cast("long").alias("device_id"),
        F.col("name").alias("device_name"),
        "device_type",
        F.col("status").alias("device_status"),
        F.col("owner_id").try_cast("long").alias("owner_id"),
        *more,
    )


def bill_columns(bills: DataFrame, *more: Column) -> DataFrame:
    return bills.select(
        F.col("id").try_cast("long").alias("bill_id"),
        F.col("user_id").try_cast("long").alias("bill_user_id"),
        F.col("device_id").try_cast("long").alias("bill_device_id"),
        F.col("amount").cast(MONEY).alias("amount"),
        "plan_type",
        F.col("status").alias("bill_status"),
        F.col("updated_at").try_cast("long").alias("billed_at"),
        *more,
    )


def zero_if_null(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def device_counts(devices: DataFrame) -> DataFrame:
    """Devices per owner; a device without a status is in the total only."""
    return (
        device_columns(devices)
        .where(F.col("owner_id").isNotNull())
        .groupBy("owner_id")
        .agg(
            F.count("device_id").alias("total_devices"),
            F.count_if(F.col("device_status") == "online").alias("online_devices"),
            F.count_if(F.col("device_status") != "online").alias("offline_devices"),
        )
    )


def paid_amount() -> Column:
    """Sum of the paid bills, 0 where none is paid."""
    paid = F.when(F.col("bill_status") == "paid", F.col("amount"))
    return F.coalesce(F.sum(paid), F.lit(0).cast(MONEY))


def bill_totals(bills: DataFrame) -> DataFrame:
    """Bills per user: all of them counted, only paid ones summed."""
    return (
        bill_columns(bills)
        .where(F.col("bill_user_id").isNotNull())
        .groupBy("bill_user_id")
        .agg(F.count("bill_id").alias("total_bills"), paid_amount().alias("total_spent"))
    )


def main_plan(bills: DataFrame) -> DataFrame:
    """The plan a user has most bills for; the first by name when two tie."""
    per_plan = (
        bill_columns(bills)
        .where(F.col("plan_type").isNotNull())
        .groupBy("bill_user_id", "plan_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_plan.groupBy("bill_user_id").agg(
        F.min_by("plan_type", F.struct(-F.col("n"), "plan_type")).alias("main_plan")
    )


def user_360(users: DataFrame, devices: DataFrame, bills: DataFrame, as_of: str | None = None) -> DataFrame:
    """Every user once, with device counts, spend and tier.

    Devices and bills are aggregated before the joins, so no join has a repeated key.
    """
    return (
        user_columns(users)
        .join(device_counts(devices), F.col("user_id") == F.col("owner_id"), "left")
        .join(bill_totals(bills), F.col("user_id") == F.col("bill_user_id"), "left")
        .select(
            "user_id",
            "user_name",
            "email",
            zero_if_null("total_devices").alias("total_devices"),
            zero_if_null("online_devices").alias("online_devices"),
            zero_if_null("offline_devices").alias("offline_devices"),
            zero_if_null("total_bills").alias("total_bills"),
            zero_if_null("total_spent").cast(TOTAL).alias("total_spent"),
            business.vip_tier(F.col("total_spent")).alias("vip_tier"),
            F.lit("monthly").alias("primary_plan"),
            run_time(as_of).alias("updated_at"),
        )
    )


def owned_devices(devices: DataFrame, users: DataFrame) -> DataFrame:
    """Device rows with their owner; users are unique, so rows are kept one to one.

    Rows without an owner would all have one join key; a second key, which follows from the owner where
    there is one, deals them over the tasks.
    """
    own, nobody = F.xxhash64("owner_id"), F.xxhash64(*devices.columns)
    dealt = F.pmod(F.when(F.col("owner_id").isNull(), nobody).otherwise(own), F.lit(DEALT))
    owners = user_columns(users).withColumn("_user_part", F.pmod(F.xxhash64("user_id"), F.lit(DEALT)))
    same = (F.col("owner_id") == F.col("user_id")) & (F.col("_part") == F.col("_user_part"))
    return devices.withColumn("_part", dealt).join(owners, same, "left").drop("_part", "_user_part")


def device_mart_columns(as_of: str | None) -> list[Column]:
    return [
        F.col("device_id"),
        F.col("device_name"),
        F.col("device_type"),
        F.col("device_status").alias("status"),
        zero_if_null("owner_id").alias("owner_id"),
        F.coalesce("user_name", F.lit("Unassigned")).alias("owner_name"),
        F.coalesce("email", F.lit("N/A")).alias("owner_email"),
        zero_if_null("amount").cast(MONEY).alias("bill_amount"),
        F.coalesce("plan_type", F.lit("none")).alias("plan_type"),
        F.coalesce("bill_status", F.lit("unbilled")).alias("bill_status"),
        run_time(as_of).alias("updated_at"),
    ]


def device_performance(devices: DataFrame, users: DataFrame, bills: DataFrame, as_of: str | None = None) -> DataFrame:
    """Every device with its owner, one row per bill; a device without bills has one row.

    Bare device rows are fanned out first and meet their owners once, after that.
    """
    billed = bill_columns(bills).select("bill_device_id", "amount", "plan_type", "bill_status")
    joined = left_join_fan_out(device_columns(devices), billed, "device_id", "bill_device_id")
    return owned_devices(joined, users).select(*device_mart_columns(as_of))


def newest_bills(bills: DataFrame) -> DataFrame:
    """The newest bill per device, chosen by every column so that ties cannot matter."""
    columns = ["billed_at", "bill_id", "amount", "plan_type", "bill_status"]
    newest = F.max(F.struct(*columns)).alias("newest")
    return bill_columns(bills).groupBy("bill_device_id").agg(newest).select("bill_device_id", "newest.*")


def device_performance_latest(
    devices: DataFrame, users: DataFrame, bills: DataFrame, as_of: str | None = None
) -> DataFrame:
    """Every device once, with its newest bill. Bills are reduced first, so nothing fans out."""
    joined = owned_devices(device_columns(devices), users).join(
        newest_bills(bills), F.col("device_id") == F.col("bill_device_id"), "left"
    )
    return joined.select(*device_mart_columns(as_of))


def share(part: Column, whole: Column) -> Column:
    """part / whole rounded to 2 places, 0 when there is no whole."""
    return F.when(whole > 0, F.round(part / whole, 2)).otherwise(F.lit(0)).cast(TOTAL)


def executive_kpi(
    users: DataFrame, devices: DataFrame, bills: DataFrame, report_date: str, as_of: str | None = None
) -> DataFrame:
    """One row a day. Each table is read once; the three one-row totals are added up."""
    totals = {"users": "long", "devices": "long", "online": "long", "revenue": "decimal(38,2)", "paid": "long"}

    def one_row(df: DataFrame, **aggregates: Column) -> DataFrame:
        row = df.agg(*[column.alias(name) for name, column in aggregates.items()])
        return row.select(*[(F.col(n) if n in aggregates else F.lit(0)).cast(t).alias(n) for n, t in totals.items()])

    paid = F.col("bill_status") == "paid"
    parts = [
        one_row(users, users=F.count(F.lit(1))),
        one_row(
            device_columns(devices),
            devices=F.count(F.lit(1)),
            online=F.count_if(F.col("device_status") == "online"),
        ),
        one_row(bill_columns(bills), revenue=paid_amount(), paid=F.count(F.when(paid, F.col("bill_id")))),
    ]
    added = reduce(DataFrame.unionByName, parts).agg(*[F.sum(n).cast(t).alias(n) for n, t in totals.items()])
    return kpi_row(added, report_date, as_of)


def kpi_row(added: DataFrame, report_date: str, as_of: str | None) -> DataFrame:
    """The report's columns from one row of users, devices, online, revenue and paid."""
    return added.select(
        F.lit(report_date).alias("report_date"),
        F.col("users").alias("total_registered_users"),
        F.col("devices").alias("total_active_devices"),
        F.col("online").alias("online_devices"),
        share(F.col("online").cast("decimal(20,0)") * 100, F.col("devices")).cast("double").alias("device_online_ratio_pct"),
        F.col("revenue").alias("total_revenue"),
        F.col("paid").alias("total_paid_transactions"),
        share(F.col("revenue"), F.col("users")).alias("avg_revenue_per_user"),
        run_time(as_of).alias("updated_at"),
    )


def device_status_counts(devices: DataFrame) -> DataFrame:
    """Device counts by type."""
    return (
        device_columns(devices)
        .groupBy("device_type")
        .agg(
            F.count("device_id").alias("total_devices"),
            F.count_if(F.col("device_status") == "online").alias("online_devices"),
            F.count_if(F.col("device_status") != "online").alias("offline_devices"),
        )
    )


def monthly_revenue(bills: DataFrame) -> DataFrame:
    """Paid revenue, bills and billed devices by month and plan."""
    month = F.trunc(moments.day_of_millis(F.col("billed_at")), "month")
    return (
        bill_columns(bills)
        .groupBy(month.alias("month"), "plan_type")
        .agg(
            paid_amount().cast(TOTAL).alias("revenue"),
            F.count("bill_id").alias("bills"),
            F.count_if(F.col("bill_status") == "paid").alias("paid_bills"),
            F.count_distinct("bill_device_id").alias("devices"),
        )
        .withColumn("month", F.date_format("month", "yyyy-MM"))
    )


def bills_by_day(bills: DataFrame) -> DataFrame:
    """Bills by calendar day."""
    return (
        bill_columns(bills)
        .groupBy(moments.day_of_millis(F.col("billed_at")).alias("bill_date"))
        .agg(F.count(F.lit(1)).alias("bills"), F.sum("amount").cast(TOTAL).alias("amount"))
        .withColumn("bill_date", F.col("bill_date").cast("string"))
    )
