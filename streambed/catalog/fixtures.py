"""Payments and log fields of the test tables, made by the rules of the systems that send them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streambed.functions import moments
from streambed.functions.business import expected_payment_status

# Rates, names and codes that must equal the source system's.
FEE_RATE = "0.011"
GATEWAYS = ["ViettelMoney", "VNPay", "Momo", "MBBank", "Vietcombank", "Techcombank"]
BANKS = ["MBBank", "Vietcombank", "Techcombank", "BIDV", "VietinBank", "VPBank"]
CONNECTION_ERRORS = ["ERR_SOCKET_TIMEOUT", "ERR_DHCP_FAILED", "ERR_SIGNAL_WEAK"]
SD_CARD_ERRORS = ["ERR_SD_CARD_FULL", "ERR_WRITE_FAILED"]
FIRMWARE_VERSIONS = ["v1.4.2", "v2.0.1", "v2.1.0", "v2.2.0-beta"]


def pick(values: list[str], index: Column) -> Column:
    """``values[index mod len(values)]`` as a Column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def partner_fee(amount: Column) -> Column:
    """1.1 % of the amount. Decimal arithmetic, so HALF_UP is exact."""
    return F.round(amount.cast("decimal(15,2)") * F.lit(FEE_RATE).cast("decimal(4,3)"), 2).cast("decimal(15,2)")


def transaction_id(gateway: Column, day: Column, bill_id: Column) -> Column:
    """``VIE_20260131_000042``; ids of more than six digits are kept whole."""
    return F.concat_ws(
        "_",
        F.upper(F.substring(gateway, 1, 3)),
        F.date_format(day, "yyyyMMdd"),
        F.format_string("%06d", bill_id),
    )


def payment_status(bill_status: Column, refunded: Column) -> Column:
    return F.when(refunded, "REFUNDED").otherwise(expected_payment_status(bill_status))


def log_severity(event_type: Column) -> Column:
    return (
        F.when(event_type == "connection_lost", "ERROR")
        .when(event_type == "sd_card_error", "WARN")
        .otherwise("INFO")
    )


def log_error_code(event_type: Column, variant: Column) -> Column:
    """The error code of a faulty event, null for every other event."""
    return F.when(event_type == "connection_lost", pick(CONNECTION_ERRORS, variant)).when(
        event_type == "sd_card_error", pick(SD_CARD_ERRORS, variant)
    )


def log_duration(event_type: Column, seconds: Column) -> Column:
    return F.when(event_type.contains("detected"), seconds.cast("int")).otherwise(F.lit(0))


def partner_payments(bills: DataFrame, **rules) -> DataFrame:
    """Payment rows for bills, as the payment partner reports them.

    ``rules`` are Columns over the bill: gateway, bank, refunded, and optionally paid_bill_id
    and paid_amount where the partner's figures differ from the bill's.
    """
    paid_at = moments.from_millis(F.col("updated_at"))
    amount = rules.get("paid_amount", F.col("amount")).cast("decimal(15,2)")
    booked = bills.select(
        rules.get("paid_bill_id", F.col("id")).alias("bill_id"),
        "user_id",
        rules["gateway"].alias("payment_gateway"),
        amount.alias("trans_amount"),
        partner_fee(amount).alias("partner_fee"),
        paid_at.alias("trans_time"),
        payment_status(F.col("status"), rules["refunded"]).alias("trans_status"),
        rules["bank"].alias("bank_code"),
    )
    trans_id = transaction_id(F.col("payment_gateway"), F.col("trans_time"), F.col("bill_id"))
    return booked.select(trans_id.alias("partner_trans_id"), "*")
