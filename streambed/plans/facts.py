"""The file path: device logs and partner payments to fact tables, and what is read off them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streambed.functions import business, moments
from streambed.operators.joins import full_join_fan_out
from streambed.plans.marts import TOTAL


def device_logs_fact(logs: DataFrame) -> DataFrame:
    """Scanned log rows with event time and date, and the scan's folder columns, which readers prune by."""
    event_time = moments.from_millis(F.col("timestamp"))
    return logs.select(
        "event_id",
        F.date_format(event_time, "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.to_date(event_time).cast("string").alias("event_date"),
        "device_id",
        "event_type",
        "severity",
        "firmware_version",
        "ip_address",
        "fps",
        "bitrate_kbps",
        "duration_sec",
        "error_code",
        *[c for c in ("year", "month") if c in logs.columns],
    )


def payment_fact(payments: DataFrame) -> DataFrame:
    """Scanned payment rows with typed money and text times."""
    return payments.select(
        "partner_trans_id",
        "bill_id",
        "user_id",
        "payment_gateway",
        "trans_amount",
        "partner_fee",
        F.date_format("trans_time", "yyyy-MM-dd HH:mm:ss").alias("trans_time"),
        F.to_date("trans_time").cast("string").alias("trans_date"),
        "trans_status",
        "bank_code",
    )


def reconcile_payments(bills: DataFrame, payments: DataFrame) -> DataFrame:
    """Every bill and every payment, matched on the bill id, with the outcome.

    A bill may be paid many times, so payments are the side that may have a hot key.
    """
    billed = bills.select(
        F.col("id").alias("billed_id"),
        F.col("user_id").alias("billed_user_id"),
        F.col("amount").alias("billed_amount"),
        F.col("status").alias("bill_status"),
    )
    paid = payments.select(
        F.col("bill_id").alias("paid_id"),
        F.col("user_id").alias("paid_user_id"),
        "payment_gateway",
        "trans_amount",
        "partner_fee",
        "trans_status",
    )
    outcome = (
        F.when(F.col("billed_id").isNull(), "orphan_payment")
        .when(F.col("paid_id").isNull(), "missing_payment")
        .when(~F.col("billed_amount").eqNullSafe(F.col("trans_amount")), "amount_mismatch")
        .when(
            ~business.expected_payment_status(F.col("bill_status")).eqNullSafe(F.col("trans_status")),
            "status_mismatch",
        )
        .otherwise("matched")
    )
    return full_join_fan_out(billed, paid, "billed_id", "paid_id").select(
        F.coalesce("billed_id", "paid_id").alias("bill_id"),
        F.coalesce("billed_user_id", "paid_user_id").alias("user_id"),
        F.coalesce("payment_gateway", F.lit("none")).alias("payment_gateway"),
        F.coalesce("bill_status", F.lit("none")).alias("bill_status"),
        F.coalesce("trans_status", F.lit("none")).alias("trans_status"),
        "billed_amount",
        F.col("trans_amount").alias("paid_amount"),
        "partner_fee",
        outcome.alias("outcome"),
    )


def reconcile_summary(reconciled: DataFrame) -> DataFrame:
    """Rows, amount and fee by gateway and outcome. A bill's amount counts once, however many payments
    of that gateway and outcome it has."""
    per_bill = reconciled.groupBy("payment_gateway", "outcome", "bill_id").agg(
        F.count(F.lit(1)).alias("payments"),
        F.max("billed_amount").alias("billed_amount"),
        F.sum("paid_amount").alias("paid_amount"),
        F.sum("partner_fee").alias("partner_fee"),
    )
    money = [F.coalesce(F.sum(c), F.lit(0)).cast(TOTAL).alias(c) for c in ("billed_amount", "paid_amount", "partner_fee")]
    return per_bill.groupBy("payment_gateway", "outcome").agg(F.sum("payments").alias("payments"), *money)


def enrich_logs(logs: DataFrame, devices: DataFrame) -> DataFrame:
    """Log rows with the type and owner of their device; logs of unknown devices stay."""
    known = devices.select(F.col("id").alias("device_id"), "device_type", "owner_id")
    return logs.join(known, "device_id", "left")


def connection_errors(logs: DataFrame, devices: DataFrame) -> DataFrame:
    """Camera faults by day, device type, event type and error code.

    Faults are first counted per device and day, so the join with devices and the final
    count work on that much smaller set.
    """
    per_device = (
        logs.where(F.col("error_code").isNotNull())
        .groupBy(
            moments.day_of_millis(F.col("timestamp")).alias("event_date"),
            "event_type",
            "error_code",
            "device_id",
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        enrich_logs(per_device, devices)
        .groupBy("event_date", F.coalesce("device_type", F.lit("unknown")).alias("device_type"), "event_type", "error_code")
        .agg(
            F.sum("n").alias("errors"),
            F.count("device_id").alias("devices"),
        )
        .withColumn("event_date", F.col("event_date").cast("string"))
    )


def subscription_renewals(bills: DataFrame, end_date: str) -> DataFrame:
    """One row for every renewal due up to ``end_date`` of the subscriptions whose first bill is paid.

    The last date is checked before the schedule is made: a sequence may not end before it starts.
    """
    first_date = moments.day_of_millis(F.col("updated_at"))
    end = F.lit(end_date).cast("date")
    days = business.plan_days(F.col("plan_type"))
    due = (
        bills.where(F.col("status") == "paid")
        .select("id", "user_id", "device_id", "amount", "plan_type", first_date.alias("start"), days.alias("days"))
        .withColumn("times", F.floor(F.datediff(end, F.col("start")) / F.col("days")).cast("int"))
        .where(F.col("times") >= 1)
    )
    return due.select(
        F.col("id").alias("first_bill_id"),
        "user_id",
        "device_id",
        "amount",
        "plan_type",
        "start",
        "days",
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("renewal_no"),
    ).select(
        "first_bill_id",
        "user_id",
        "device_id",
        "amount",
        "plan_type",
        "renewal_no",
        F.date_add("start", F.col("days") * F.col("renewal_no")).cast("string").alias("renewal_date"),
    )


def bills_with_renewals(bills: DataFrame, end_date: str) -> DataFrame:
    """The bill table of the subscriptions: every first bill as number 0, and the renewals of the paid ones."""
    columns = ["first_bill_id", "renewal_no", "user_id", "device_id", "amount", "plan_type", "status", "bill_date"]
    first = bills.select(
        F.col("id").alias("first_bill_id"),
        F.lit(0).alias("renewal_no"),
        "user_id",
        "device_id",
        "amount",
        "plan_type",
        "status",
        moments.day_of_millis(F.col("updated_at")).cast("string").alias("bill_date"),
    )
    renewed = subscription_renewals(bills, end_date).withColumns(
        {"status": F.lit("paid"), "bill_date": F.col("renewal_date")}
    )
    return first.select(*columns).unionByName(renewed.select(*columns))
