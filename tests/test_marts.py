from decimal import Decimal

import pytest

from streambed import schemas
from streambed.functions import business
from streambed.operators import contract
from streambed.plans import marts
from tests.helpers import table

AT = "2024-01-01 00:00:00"


@pytest.fixture(scope="module")
def lake(spark):
    users = table(spark, schemas.USERS, [(k, f"user {k}", f"u{k}@x", 0) for k in range(1, 8)])
    devices = [
        (1, "d1", "cam", "online", 1, 0),
        (2, "d2", "cam", "offline", 1, 0),
        (3, "d3", "bell", None, 1, 0),
        (4, "d4", "bell", "online", None, 0),
        (5, "d5", "bell", "online", 99, 0),
    ]
    spent = {1: "1000000.00", 2: "999999.99", 3: "500000.00", 4: "499999.99", 5: "0.00"}
    bills = [(k, k, 1, Decimal(v), "yearly", "paid", 10) for k, v in spent.items()]
    bills += [(6, 6, 1, Decimal("5"), "monthly", "pending", 10), (7, 6, 2, Decimal("7"), "monthly", None, 10)]
    return users, table(spark, schemas.DEVICES, devices), table(spark, schemas.BILLS, bills)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_user_360_edges(lake):
    got = by(marts.user_360(*lake, AT), "user_id")
    assert len(got) == 7
    tiers = {k: r["vip_tier"] for k, r in got.items()}
    assert tiers == {1: "DIAMOND", 2: "GOLD", 3: "GOLD", 4: "SILVER", 5: "STANDARD", 6: "STANDARD", 7: "STANDARD"}
    one = got[1]
    assert (one["total_devices"], one["online_devices"], one["offline_devices"]) == (3, 1, 1)
    assert (got[6]["total_bills"], got[6]["total_spent"]) == (2, 0.0)
    none = got[7]
    assert (none["total_devices"], none["total_bills"], none["total_spent"]) == (0, 0, 0.0)
    assert {r["primary_plan"] for r in got.values()} == {"monthly"} and one["updated_at"] == AT


def test_main_plan_counts_bills(lake):
    assert by(marts.main_plan(lake[2]), "bill_user_id")[6]["main_plan"] == "monthly"


def test_device_performance_edges(lake):
    users, devices, bills = lake
    got = marts.device_performance(devices, users, bills, AT).collect()
    assert len(got) == 6 + 1 + 3
    one = {r["device_id"]: r for r in got}
    assert (one[4]["owner_id"], one[4]["owner_name"], one[4]["owner_email"]) == (0, "Unassigned", "N/A")
    assert (one[5]["owner_id"], one[5]["owner_name"]) == (99, "Unassigned")
    assert (one[3]["bill_amount"], one[3]["plan_type"], one[3]["bill_status"]) == (0.0, "none", "unbilled")
    assert one[2]["bill_status"] == "unbilled"  # its only bill has no status


def test_device_performance_latest_has_one_row_per_device(spark, lake):
    users, devices, _ = lake
    bills = [
        (1, 1, 1, Decimal("1"), "monthly", "paid", 10),
        (2, 1, 1, Decimal("2"), "monthly", "pending", 30),
        (3, 1, 1, Decimal("3"), "yearly", "paid", 30),
    ]
    got = by(marts.device_performance_latest(devices, users, table(spark, schemas.BILLS, bills), AT), "device_id")
    assert len(got) == 5 and got[1]["bill_amount"] == 3.0 and got[2]["bill_status"] == "unbilled"


def test_kpi_with_and_without_rows(spark, lake):
    users, devices, bills = lake
    row = marts.executive_kpi(users, devices, bills, "2024-01-01", AT).first()
    assert (row["total_registered_users"], row["total_active_devices"], row["online_devices"]) == (7, 5, 3)
    assert row["device_online_ratio_pct"] == 60.0
    assert row["total_revenue"] == Decimal("2999999.98") and row["total_paid_transactions"] == 5
    assert row["avg_revenue_per_user"] == Decimal("428571.43")
    none = [table(spark, s, []) for s in (schemas.USERS, schemas.DEVICES, schemas.BILLS)]
    empty = marts.executive_kpi(*none, "2024-01-01", AT).collect()
    assert len(empty) == 1
    assert (empty[0]["device_online_ratio_pct"], empty[0]["avg_revenue_per_user"], empty[0]["total_revenue"]) == (0, 0, 0)


def test_ratio_rounds_half_up(spark):
    df = spark.createDataFrame([(5350, 2000)], "a long, b long")
    got = df.select(marts.share(df["a"].cast("decimal(20,0)"), df["b"]).alias("x")).first()["x"]
    assert got == Decimal("2.68")


def test_marts_without_devices_and_bills(spark, lake):
    devices, bills = table(spark, schemas.DEVICES, []), table(spark, schemas.BILLS, [])
    assert marts.user_360(lake[0], devices, bills, AT).count() == 7
    assert marts.device_performance(devices, lake[0], bills, AT).count() == 0


def test_contract(spark, lake):
    mart = marts.user_360(*lake, AT)
    assert contract.conform(mart, schemas.USER_360).schema.simpleString() == schemas.USER_360.simpleString()
    with pytest.raises(ValueError, match="vip_tier"):
        contract.conform(mart.drop("vip_tier"), schemas.USER_360)


def test_large_money_and_counts_survive_to_the_export(spark, lake):
    users, devices, _ = lake
    paid = [(k, 1, 1, Decimal("9999999999999.99"), "yearly", "paid", 10) for k in range(3)]
    bills = table(spark, schemas.BILLS, paid + [(9, 2, 2, Decimal("12345678901.25"), "yearly", "paid", 10)])
    spent = by(contract.conform(marts.user_360(*lake[:2], bills, AT), schemas.USER_360), "user_id")
    assert spent[1]["total_spent"] == Decimal("29999999999999.97")
    billed = contract.conform(marts.device_performance(devices, users, bills, AT), schemas.DEVICE_PERFORMANCE)
    assert {r["bill_amount"] for r in billed.where("device_id = 2").collect()} == {Decimal("12345678901.25")}
    kpi = contract.conform(marts.executive_kpi(users, devices, bills, "2024-01-01", AT), schemas.EXECUTIVE_KPI).first()
    assert kpi["total_revenue"] == Decimal("30012345678901.22") - Decimal("0.00")
    many = spark.range(1).selectExpr(
        "date'2024-01-01' AS report_date", "2200000000 AS total_registered_users", "1L AS total_active_devices",
        "1L AS online_devices", "1.0D AS device_online_ratio_pct", "1 AS total_revenue", "1L AS total_paid_transactions",
        "1 AS avg_revenue_per_user", "'x' AS updated_at",
    )
    assert contract.conform(many, schemas.EXECUTIVE_KPI).first()["total_registered_users"] == 2200000000


def test_a_value_that_does_not_fit_fails_the_load(spark):
    wide = spark.range(1).selectExpr("CAST('99999999999999999' AS DECIMAL(38,2)) AS amount")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        contract.conform(wide, schemas.columns("amount MONEY")).collect()


def test_tier_of_null_is_standard(spark):
    df = spark.createDataFrame([(None,)], "x decimal(15,2)")
    assert df.select(business.vip_tier(df["x"])).first()[0] == "STANDARD"
