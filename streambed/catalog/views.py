"""The shared test tables as the domain's tables. Every view reads its tables whole."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streambed import schemas
from streambed.catalog import fixtures
from streambed.functions import moments, wire
from streambed.session import prepare
from streambed.sources import topics

# Ids above every customer key: accounts that have nothing, and owners that do not exist.
SUPPLIER_IDS = 1000000000000
UNKNOWN_OWNERS = 2000000000000
WRONG_BILLS = 3000000000000
# Places line numbers above part keys in the sequence that orders a bill's changes.
LINE_STEP = 1000000000000
USERS_UPDATED_AT = 1704067200000
SCHEMA_ID = 7

# What the change-log views read of their tables.
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus",
    "l_shipdate",
]


# Declared, so that opening a table reads no file footers.
TABLES = {
    "customer": schemas.columns(
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": schemas.columns("s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"),
    "orders": schemas.columns(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": schemas.columns(
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": schemas.columns(
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "documents": schemas.columns("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def millis(column: str) -> str:
    return f"unix_millis(CAST({column} AS TIMESTAMP))"


def account(key: str, name: str) -> list[str]:
    return [
        f"{key} AS id",
        f"{name} AS name",
        f"lower(replace({name}, '#', '_')) || '@example.com' AS email",
        f"{USERS_UPDATED_AT} AS updated_at",
    ]


def customer_users(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*account("c_custkey", "c_name"), *extra)


def supplier_users(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    named = account(f"s_suppkey + {SUPPLIER_IDS}", "s_name")
    return table(spark, sf_dir, "supplier").selectExpr(*named, *extra)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, and suppliers as accounts without devices or bills."""
    return customer_users(spark, sf_dir).unionByName(supplier_users(spark, sf_dir))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; urgent ones have no owner, low-priority ones an owner that is not a user,
    and those of status P no status."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "'Device ' || CAST(o_orderkey AS STRING) AS name",
        "o_orderpriority AS device_type",
        "CASE o_orderstatus WHEN 'O' THEN 'online' WHEN 'F' THEN 'offline' END AS status",
        f"""CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey + {UNKNOWN_OWNERS}
                 WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS owner_id""",
        f"{millis('o_orderdate')} AS updated_at",
    )


PLAN_OF_FLAG = "CASE l_returnflag WHEN 'A' THEN 'monthly' WHEN 'N' THEN 'quarterly' ELSE 'yearly' END"
PAID_LINE = "CASE WHEN l_linestatus = 'F' THEN 'paid' ELSE 'pending' END"


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items. The part is the user, so that some bills belong to users that do not exist."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "l_partkey AS user_id",
        "l_orderkey AS device_id",
        "CAST(l_extendedprice AS DECIMAL(15,2)) AS amount",
        f"{PLAN_OF_FLAG} AS plan_type",
        f"{PAID_LINE} AS status",
        f"{millis('l_shipdate')} AS updated_at",
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bills with a unique id."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "o_custkey AS user_id",
        "o_orderkey AS device_id",
        "CAST(o_totalprice AS DECIMAL(15,2)) AS amount",
        """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'monthly'
                WHEN o_orderpriority = '3-MEDIUM' THEN 'quarterly' ELSE 'yearly' END AS plan_type""",
        "CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'pending' END AS status",
        f"{millis('o_orderdate')} AS updated_at",
    )


def payments_of(invoiced: DataFrame) -> DataFrame:
    """One payment per invoice. Pending quarterly ones are booked under a wrong bill, pending
    yearly ones over their amount, and refunds hit the paid quarterly ones. Paid yearly ones of
    every fifth user are paid twice, and the status of every seventh user's payments is missing."""
    pending, plan = F.col("status") == "pending", F.col("plan_type")
    twice = (F.col("status") == "paid") & (plan == "yearly") & (F.col("user_id") % 5 == 0)
    copies = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    paid = fixtures.partner_payments(
        invoiced.withColumn("copy", F.explode(copies)),
        gateway=fixtures.pick(fixtures.GATEWAYS, F.col("user_id")),
        bank=fixtures.pick(fixtures.BANKS, F.col("id")),
        refunded=(F.col("status") == "paid") & (plan == "quarterly"),
        paid_bill_id=F.when(pending & (plan == "quarterly"), F.col("id") + WRONG_BILLS).otherwise(F.col("id")),
        paid_amount=F.when(pending & (plan == "yearly"), F.col("amount") + 1).otherwise(F.col("amount")),
    )
    return paid.withColumn("trans_status", F.when(F.col("user_id") % 7 != 0, F.col("trans_status")))


def envelopes(df: DataFrame, op: str, at: str, seq: str, **image: str) -> DataFrame:
    """Change envelopes of bills, from SQL text for each part.

    Deletes have a before-image with the key only, and no after-image.
    """
    types = {f.name: f.dataType.simpleString() for f in schemas.BILLS.fields}
    after = ", ".join(f"'{name}', CAST({image[name]} AS {kind})" for name, kind in types.items())
    nulls = ", ".join(f"'{name}', CAST(NULL AS {kind})" for name, kind in types.items() if name != "id")
    return df.selectExpr("*", f"{op} AS op").selectExpr(
        f"CASE WHEN op IN ('u', 'd') THEN named_struct('id', {image['id']}, {nulls}) END AS before",
        f"CASE WHEN op <> 'd' THEN named_struct({after}) END AS after",
        f"named_struct('db', 'shop', 'table', 'cam_bills', 'txId', CAST({seq} AS BIGINT) + 1000, 'lsn', CAST({seq} AS BIGINT)) AS source",
        "op",
        f"{millis(at)} AS ts_ms",
        f"CAST({at} AS TIMESTAMP) AS timestamp",
    )


def event_envelopes(events: DataFrame) -> DataFrame:
    """Events as changes of the bill with the user's id; costly errors delete it."""
    return envelopes(
        events,
        op="""CASE WHEN event_type = 'error' AND value > 200 THEN 'd' WHEN event_type = 'signup' THEN 'c'
                   WHEN event_type = 'purchase' THEN 'r' ELSE 'u' END""",
        at="ts",
        seq="event_id",
        id="user_id",
        user_id="user_id",
        device_id="event_id",
        amount="value",
        plan_type="CASE event_type WHEN 'signup' THEN 'yearly' WHEN 'view' THEN 'quarterly' ELSE 'monthly' END",
        status="CASE WHEN event_type = 'purchase' THEN 'paid' ELSE 'pending' END",
        updated_at=millis("ts"),
    )


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the first change of a bill: finished ones from the snapshot, others inserted."""
    return envelopes(
        table(spark, sf_dir, "orders").select(*ORDER_COLUMNS),
        op="CASE WHEN o_orderstatus = 'F' THEN 'r' ELSE 'c' END",
        at="o_orderdate",
        seq="0",
        id="o_orderkey",
        user_id="o_custkey",
        device_id="o_orderkey",
        amount="o_totalprice",
        plan_type="'monthly'",
        status="'pending'",
        updated_at=millis("o_orderdate"),
    )


def line_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as later changes of their order's bill: returned and finished ones delete it,
    the seventh line of a new one carries an op nobody knows, the rest update it."""
    return envelopes(
        table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS),
        op="""CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'd'
                   WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 't' ELSE 'u' END""",
        at="l_shipdate",
        seq=f"CAST(l_linenumber AS BIGINT) * {LINE_STEP} + l_partkey",
        id="l_orderkey",
        user_id="l_partkey",
        device_id="l_suppkey",
        amount="l_extendedprice",
        plan_type=PLAN_OF_FLAG,
        status=PAID_LINE,
        updated_at=millis("l_shipdate"),
    )


def messages(changes: DataFrame) -> DataFrame:
    """Envelopes as framed topic messages, a tombstone after every delete."""
    text = F.to_json(F.struct("before", "after", "source", "op", "ts_ms"))
    # Deletes are framed under a later schema.
    framed = F.when(F.col("op") == "d", wire.frame(SCHEMA_ID + 1, text)).otherwise(wire.frame(SCHEMA_ID, text))
    sent = F.when(F.col("op") == "d", F.array(framed, F.lit(None).cast("binary"))).otherwise(F.array(framed))
    return changes.select(F.explode(sent).alias("value"), "timestamp")


# The writer schemas of ``versioned_messages``: its names for a bill's columns, by id.
OLD_SCHEMA, RENAMED_SCHEMA, UNKNOWN_SCHEMA = 20, 21, 22
RENAMED = {"amount": "total", "status": "state"}


def writer_schemas() -> dict[int, str]:
    """The first schema lacks the plan; the second calls amount and status otherwise."""
    old = [name for name in schemas.BILLS.names if name != "plan_type"]
    renamed = [RENAMED.get(name, name) for name in schemas.BILLS.names]
    record = lambda names: json.dumps({"type": "record", "name": "cam_bills", "fields": [{"name": n} for n in names]})
    return {OLD_SCHEMA: record(old), RENAMED_SCHEMA: record(renamed)}


def versioned_messages(changes: DataFrame) -> DataFrame:
    """Envelopes as framed messages of several writers: snapshot rows under the first schema, inserts
    under one that nobody registered, the rest under the second."""
    renamed = F.col("text")
    for name, called in RENAMED.items():
        renamed = F.replace(renamed, F.lit(f'"{name}":'), F.lit(f'"{called}":'))
    framed = (
        F.when(F.col("op") == "r", wire.frame(OLD_SCHEMA, F.regexp_replace("text", ',"plan_type":"[a-z]*"', "")))
        .when(F.col("op") == "c", wire.frame(UNKNOWN_SCHEMA, F.col("text")))
        .otherwise(wire.frame(RENAMED_SCHEMA, renamed))
    )
    text = F.to_json(F.struct("before", "after", "source", "op", "ts_ms")).alias("text")
    return changes.select("op", text, "timestamp").select(framed.alias("value"), "timestamp")


def bronze_rows(changes: DataFrame) -> DataFrame:
    """Envelopes as bronze rows without the way over the wire."""
    from streambed.operators.changelog import flatten_envelope

    data = F.struct("before", "after", "source", "op", "ts_ms")
    return flatten_envelope(changes.select(data.alias("data"), "timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a stream."""
    return topics.file_stream(prepare(spark), topics.as_glob(f"{sf_dir}/events.parquet"), TABLES["events"])


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_envelopes(events(spark, sf_dir).select(*EVENT_COLUMNS))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(event_changes(spark, sf_dir))


def event_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(event_changes(spark, sf_dir))


def order_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(order_envelopes(spark, sf_dir))


def line_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(line_envelopes(spark, sf_dir))


def line_bronze_wider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items' changes with two columns that bills do not declare: the line, and what is bought, a
    whole number for the first lines and one with decimals for the others."""
    log = line_bronze(spark, sf_dir)
    line = F.floor(F.col("seq") / LINE_STEP)
    part = F.col("seq") % LINE_STEP
    extra = F.to_json(
        F.struct(
            line.alias("line"),
            F.struct(F.when(line == 1, part).alias("whole"), F.when(line > 1, part + F.lit(0.5)).alias("part")).alias("bought"),
        )
    )
    merged = F.concat(F.expr("substring(after, 1, length(after) - 1)"), F.lit(","), F.expr("substring(extra, 2)"))
    return log.withColumn("extra", extra).withColumn("after", merged).drop("extra")


def bill_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log of all bills: orders, then their line items."""
    return order_bronze(spark, sf_dir).unionByName(line_bronze(spark, sf_dir))


def device_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as camera log rows."""
    kind = F.col("event_type")
    event_type = (
        F.when(kind == "error", "connection_lost")
        .when(kind == "signup", "sd_card_error")
        .when(kind == "view", "motion_detected")
        .when(kind == "click", "human_detected")
        .otherwise("heartbeat")
    )
    row = events(spark, sf_dir).select(
        F.format_string("evt-%012x", F.col("event_id")).alias("event_id"),
        moments.to_millis(F.col("ts")).alias("timestamp"),
        F.col("user_id").alias("device_id"),
        event_type.alias("event_type"),
        F.col("event_id").alias("n"),
    )
    named = F.col("event_type")
    return row.select(
        "event_id",
        "timestamp",
        "device_id",
        "event_type",
        fixtures.log_severity(named).alias("severity"),
        fixtures.pick(fixtures.FIRMWARE_VERSIONS, F.col("n")).alias("firmware_version"),
        F.concat(F.lit("192.168.1."), (F.pmod("device_id", F.lit(254)) + 1).cast("string")).alias("ip_address"),
        F.lit(25).alias("fps"),
        F.lit(2048).alias("bitrate_kbps"),
        fixtures.log_duration(named, 10 + F.pmod("n", F.lit(51))).alias("duration_sec"),
        fixtures.log_error_code(named, F.col("n")).alias("error_code"),
    )
