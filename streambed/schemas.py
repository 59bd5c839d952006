"""Declared schemas of every table. Money is DECIMAL(15,2), totals of money are DECIMAL(38,2)."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BINARY": T.BinaryType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "VARIANT": T.VariantType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "MONEY": T.DecimalType(15, 2),
    "TOTAL": T.DecimalType(38, 2),
}


def columns(text: str) -> T.StructType:
    """A schema from ``name TYPE, …``. Unlike ``StructType.fromDDL`` it needs no running session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])



USERS = columns("id BIGINT, name STRING, email STRING, updated_at BIGINT")
DEVICES = columns(
    "id BIGINT, name STRING, device_type STRING, status STRING, owner_id BIGINT, updated_at BIGINT"
)
BILLS = columns(
    "id BIGINT, user_id BIGINT, device_id BIGINT, amount MONEY, "
    "plan_type STRING, status STRING, updated_at BIGINT"
)
TABLES = {"users": USERS, "devices": DEVICES, "cam_bills": BILLS}

RAW_MESSAGE = columns("value BINARY, timestamp TIMESTAMP")
# The change envelope of a JSON message; images and source are of any shape.
ENVELOPE = columns("before VARIANT, after VARIANT, source VARIANT, op STRING, ts_ms BIGINT")

# The nine columns of a change row plus `seq`, the position that breaks ts_ms ties.
BRONZE = columns(
    "id STRING, before STRING, after STRING, source STRING, op STRING, ts_ms BIGINT, seq BIGINT, "
    "year INT, month INT, day INT"
)

DEVICE_LOGS = columns(
    "event_id STRING, timestamp BIGINT, device_id BIGINT, event_type STRING, severity STRING, "
    "firmware_version STRING, ip_address STRING, fps INT, bitrate_kbps INT, duration_sec INT, "
    "error_code STRING"
)
PAYMENTS = columns(
    "partner_trans_id STRING, bill_id BIGINT, user_id BIGINT, payment_gateway STRING, "
    "trans_amount MONEY, partner_fee MONEY, trans_time TIMESTAMP, "
    "trans_status STRING, bank_code STRING"
)

USER_360 = columns(
    "user_id BIGINT, user_name STRING, email STRING, total_devices BIGINT, online_devices BIGINT, "
    "offline_devices BIGINT, total_bills BIGINT, total_spent TOTAL, vip_tier STRING, "
    "primary_plan STRING, updated_at STRING"
)
DEVICE_PERFORMANCE = columns(
    "device_id BIGINT, device_name STRING, device_type STRING, status STRING, owner_id BIGINT, "
    "owner_name STRING, owner_email STRING, bill_amount MONEY, plan_type STRING, "
    "bill_status STRING, updated_at STRING"
)
EXECUTIVE_KPI = columns(
    "report_date DATE, total_registered_users BIGINT, total_active_devices BIGINT, online_devices BIGINT, "
    "device_online_ratio_pct FLOAT, total_revenue TOTAL, total_paid_transactions BIGINT, "
    "avg_revenue_per_user TOTAL, updated_at STRING"
)
MARTS = {
    "user_360": USER_360,
    "device_performance": DEVICE_PERFORMANCE,
    "daily_executive_kpi": EXECUTIVE_KPI,
}

