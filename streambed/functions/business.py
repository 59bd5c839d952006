"""Business rules of the camera-subscription domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and periods that must equal the source system's.
DIAMOND_FROM = 1000000
GOLD_FROM = 500000
PLAN_DAYS = {"monthly": 30, "quarterly": 90, "yearly": 365}


def vip_tier(spent: Column) -> Column:
    """Tier of the unrounded spend; null and zero are STANDARD."""
    return (
        F.when(spent >= DIAMOND_FROM, "DIAMOND")
        .when(spent >= GOLD_FROM, "GOLD")
        .when(spent > 0, "SILVER")
        .otherwise("STANDARD")
    )


def expected_payment_status(bill_status: Column) -> Column:
    return F.when(bill_status == "paid", "SUCCESS").otherwise("PENDING")


def plan_days(plan_type: Column) -> Column:
    """Days between two bills of a plan; any plan not listed renews like the longest one."""
    days = F.when(plan_type == "monthly", PLAN_DAYS["monthly"])
    return days.when(plan_type == "quarterly", PLAN_DAYS["quarterly"]).otherwise(PLAN_DAYS["yearly"])


def flip_status(status: Column) -> Column:
    """online becomes offline; offline, unknown and null become online."""
    return F.when(status == "online", "offline").otherwise("online")
