"""Every operator as a registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed import schemas
from streambed.catalog import views
from streambed.functions import business, moments, text, wire
from streambed.operators import changelog, contract, edits, handover, latest, silver, versions
from streambed.plans import facts, increments, jobs, marts, sketches
from streambed.session import run_folder
from streambed.sinks import change_table, numbered
from streambed.sinks import files as file_sinks
from streambed.sinks.change_table import ChangeTable
from streambed.sinks.numbered import NumberedTable
from streambed.sinks.silver_table import read_current
from streambed.sources import files as file_sources
from streambed.sources import lake, topics
from streambed.streaming import files as file_streams
from streambed.streaming import keyed, progress
from streambed.streaming.bronze import ALL_AVAILABLE, start_bronze
from streambed.streaming.silver import start_replica, start_silver
from streambed.streaming.supervise import for_each_table, keep_running

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

AS_OF = "2024-02-01 00:00:00"
REPORT_DATE = "2024-02-01"
RENEW_UNTIL = "2001-08-01"
SNAPSHOT_MS = 1704067200000
PICK_SEED = 42


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def plain_money(df: DataFrame) -> DataFrame:
    """Decimals as doubles, as the results are compared."""
    money = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in money})


def bill_output(df: DataFrame) -> DataFrame:
    """Bill columns with the amount as a double."""
    return plain_money(df.select(*schemas.BILLS.names))


def change_output(bronze: DataFrame) -> DataFrame:
    """Change columns and two fields of the image, instead of engine-specific JSON text."""
    image = F.from_json(changelog.after_or_before(), schemas.BILLS)
    return bronze.withColumn("image", image).select(
        "id",
        "op",
        "ts_ms",
        "seq",
        F.col("image.amount").cast("double").alias("amount"),
        F.col("image.status").alias("status"),
    )


def bill_decoder() -> changelog.Decoder:
    return changelog.json_envelope()


# Sources and the bronze layer


@query
def tombstone_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = changelog.drop_tombstones(views.event_messages(spark, sf_dir))
    payload = wire.frame_payload(F.col("value")).cast("string")
    return live.select(
        (F.length("value") > wire.HEADER_BYTES).alias("framed"),
        (F.get_json_object(payload, "$.op") == "d").alias("deletes"),
        moments.to_millis(F.col("timestamp")).alias("ts_ms"),
    )


@query
def wire_frame_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = changelog.drop_tombstones(views.event_messages(spark, sf_dir))
    payload = wire.frame_payload(F.col("value")).cast("string")
    return live.select(
        wire.frame_schema_id(F.col("value")).alias("schema_id"),
        F.get_json_object(payload, "$.op").alias("op"),
        F.get_json_object(payload, "$.source.lsn").cast("long").alias("seq"),
        F.get_json_object(payload, "$.ts_ms").cast("long").alias("ts_ms"),
    )


@query
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = changelog.decode_messages(views.event_messages(spark, sf_dir), bill_decoder())
    field = lambda part, name, kind: F.variant_get(f"data.{part}", f"$.{name}", kind)
    return decoded.select(
        F.coalesce(field("after", "id", "long"), field("before", "id", "long")).alias("id"),
        F.col("data.op").alias("op"),
        field("source", "table", "string").alias("source_table"),
        field("source", "db", "string").alias("source_db"),
        field("source", "lsn", "long").alias("seq"),
        F.col("data.ts_ms").alias("ts_ms"),
        field("after", "amount", "double").alias("amount"),
        field("after", "plan_type", "string").alias("plan_type"),
        (F.col("data.before").isNotNull() & ~F.is_variant_null("data.before")).alias("has_before"),
    )


def ingest_output(bronze: DataFrame) -> DataFrame:
    source = F.from_json("source", schemas.columns("table STRING, txId BIGINT"))
    return bronze.withColumn("origin", source).select(
        "id",
        "op",
        "ts_ms",
        "seq",
        F.from_json("after", schemas.BILLS)["amount"].cast("double").alias("amount"),
        F.col("origin.table").alias("source_table"),
        F.col("origin.txId").alias("transaction"),
        "year",
        "month",
        "day",
    )


@query
def bronze_ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_output(changelog.to_bronze(views.event_messages(spark, sf_dir), bill_decoder()))


def ingest_events(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Run the bronze stream over the events until all are in; the bronze table."""
    raw = views.messages(views.event_envelopes(views.event_stream(spark, sf_dir)))
    stream = start_bronze(raw, bill_decoder(), f"{root}/bronze", f"{root}/checkpoint", trigger=ALL_AVAILABLE)
    stream.awaitTermination()
    return spark.read.schema(schemas.BRONZE).parquet(f"{root}/bronze")


@query
def bronze_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_output(ingest_events(spark, sf_dir, run_folder(spark, "bronze_ingest_stream")))


@query
def timed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze stream with a processing-time trigger, stopped when it has taken in what is there."""
    root = run_folder(spark, "timed_stream")
    raw = views.messages(views.event_envelopes(views.event_stream(spark, sf_dir)))
    trigger = {"processingTime": "1 second"}
    stream = start_bronze(raw, bill_decoder(), f"{root}/bronze", f"{root}/checkpoint", "stream_timed", trigger)
    stream.processAllAvailable()
    stream.stop()
    return ingest_output(spark.read.schema(schemas.BRONZE).parquet(f"{root}/bronze"))


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress table of the bronze stream over three files of events, whose first run fails in its second
    batch and is started again."""
    root = run_folder(spark, "stream_progress")
    views.event_messages(spark, sf_dir).repartition(3).write.parquet(f"{root}/in")
    listener = progress.ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(listener)
    runs: list[str] = []

    def start():
        raw = topics.file_stream(spark, f"{root}/in", schemas.RAW_MESSAGE, max_files=1)
        bronze = changelog.to_bronze(raw, bill_decoder())

        def keep(batch: DataFrame, number: int) -> None:
            if len(runs) == 1 and number == 1:
                raise RuntimeError("first run stops here")
            batch.write.mode("overwrite").parquet(f"{root}/bronze/batch={number}")

        stream = bronze.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint")
        started = stream.queryName("stream_progress").trigger(**ALL_AVAILABLE).start()
        runs.append(str(started.runId))
        return started

    try:
        keep_running(spark, {"events": start}, poll_seconds=1)
        listener.wait_for_end(runs)
    finally:
        spark.streams.removeListener(listener)
    found = progress.summary(progress.read_progress(spark, f"{root}/progress"))
    taken_in = spark.read.schema(schemas.BRONZE).parquet(f"{root}/bronze").agg(F.count(F.lit(1)).alias("n"))
    return found.select("name", "batches", "input_rows", "runs", "failed_runs").withColumn("bronze_rows", taken_in.scalar())


BILL_READER = [
    versions.ReaderField(name, {"amount": ("total",), "status": ("state",)}.get(name, ()), "monthly" if name == "plan_type" else None)
    for name in schemas.BILLS.names
]


@query
def decode_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of two writer schemas, decoded by the id in their frame to the reader's names."""
    raw = views.versioned_messages(views.event_changes(spark, sf_dir))
    writers = versions.registry(spark, views.writer_schemas())
    bronze = versions.to_bronze(raw, bill_decoder(), writers, BILL_READER)
    image = F.from_json("after", schemas.BILLS)
    return bronze.withColumn("image", image).select(
        "id",
        "op",
        "seq",
        F.col("image.amount").cast("double").alias("amount"),
        F.col("image.plan_type").alias("plan_type"),
        F.col("image.status").alias("status"),
    )


@query
def schema_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose schema nobody registered, set aside by their schema id."""
    raw = views.versioned_messages(views.event_changes(spark, sf_dir))
    writers = versions.registry(spark, views.writer_schemas())
    aside = versions.quarantine(raw, bill_decoder(), writers, BILL_READER)
    return aside.select("schema_id", "known", moments.to_millis(F.col("timestamp")).alias("ts_ms"))


@query
def bronze_partition_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.events(spark, sf_dir).select("event_id", *moments.calendar_parts(moments.as_timestamp(F.col("ts"))))


@query
def bronze_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = views.event_bronze(spark, sf_dir)
    total = bronze.agg(F.count(F.lit(1)).alias("n"))
    first = lake.inspect(bronze, ["id", "op", "ts_ms", "seq", "year", "month", "day"], ["ts_ms", "seq"], 5)
    return first.withColumn("total_rows", total.scalar())


@query
def lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.prepare(spark)
    return lake.read_table(spark, f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query
def empty_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_folder(spark, "empty_fallback")
    devices = lake.read_or_empty(spark, f"{root}/devices", schemas.DEVICES)
    bills = lake.read_or_empty(spark, f"{root}/cam_bills", schemas.BILLS)
    return plain_money(marts.user_360(views.users(spark, sf_dir), devices, bills, AS_OF))


@query
def split_by_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = views.event_bronze(spark, sf_dir).select("id", "op", "ts_ms", "seq")
    parts = {"insert": changelog.inserts, "update": changelog.updates, "delete": changelog.deletes}
    split = [take(bronze).withColumn("part", F.lit(name)) for name, take in parts.items()]
    return split[0].unionByName(split[1]).unionByName(split[2])


@query
def first_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = changelog.first_image(views.event_bronze(spark, sf_dir))
    return bill_output(image.select(F.from_json("image", schemas.BILLS).alias("p")).select("p.*"))


@query
def silver_payload_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = views.event_bronze(spark, sf_dir).where(F.col("op").isin(*changelog.WRITE_OPS))
    return bill_output(changelog.expand_payload(written, schemas.BILLS, F.col("after")))


@query
def row_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = views.users(spark, sf_dir)
    image = users.select(changelog.row_image(users.columns).alias("image"))
    return image.select(
        F.get_json_object("image", "$.id").cast("long").alias("id"),
        F.get_json_object("image", "$.name").alias("name"),
        F.get_json_object("image", "$.email").alias("email"),
    )


@query
def infer_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = views.event_bronze(spark, sf_dir).where(F.col("after").isNotNull())
    inferred = changelog.infer_json_schema(written, "after")
    return bill_output(changelog.expand_payload(written, inferred, F.col("after")))


@query
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against a later state: furniture accounts closed, machinery ones renamed,
    suppliers added."""
    old = views.customer_users(spark, sf_dir)
    renamed = edits.update_where(
        views.customer_users(spark, sf_dir, "c_mktsegment").where("c_mktsegment <> 'FURNITURE'"),
        F.col("c_mktsegment") == "MACHINERY",
        name=F.concat("name", F.lit(" (Pro)")),
    ).drop("c_mktsegment")
    new = renamed.unionByName(views.supplier_users(spark, sf_dir))
    return changelog.diff_snapshots(old, new, "id", SNAPSHOT_MS).select(
        "id",
        "op",
        "ts_ms",
        F.get_json_object("before", "$.name").alias("old_name"),
        F.get_json_object("after", "$.name").alias("new_name"),
    )


SNAPSHOT_CHUNKS = 4


@query
def snapshot_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as a snapshot in chunks while the line items change their bills: one log, merged.

    Chunk k is read between 1 January and 1 July of 1992 + k; as the views have no state to read then,
    a row is the order's as it was placed.
    """
    columns = [c for c in schemas.BILLS.names if c != "plan_type"]
    rows = views.invoices(spark, sf_dir).select(*columns, F.lit("monthly").alias("plan_type"))
    chunks = rows.withColumn("chunk", F.pmod("id", F.lit(SNAPSHOT_CHUNKS)).cast("int"))
    at = lambda year, month: F.unix_millis(F.make_timestamp(F.lit(year), F.lit(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    windows = functools.reduce(
        DataFrame.unionByName,
        [
            spark.range(1).select(
                F.lit(k).alias("chunk"),
                at(1992 + k, 1).alias("low_ts_ms"),
                F.lit(0).cast("long").alias("low_seq"),
                at(1992 + k, 7).alias("high_ts_ms"),
                F.lit(0).cast("long").alias("high_seq"),
            )
            for k in range(SNAPSHOT_CHUNKS)
        ],
    )
    return change_output(handover.hand_over(chunks, windows, views.line_bronze(spark, sf_dir)))


# The silver layer


@query
def latest_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_output(silver.latest_update(views.bill_bronze(spark, sf_dir)))


@query
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_output(latest.latest_per_key(views.event_bronze(spark, sf_dir), "id"))


@query
def latest_per_key_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The aggregate sorts and shuffles whole rows, so it gets the columns of the result, not the images' texts.
    return latest.latest_per_key_agg(change_output(views.bill_bronze(spark, sf_dir)), "id")


@query
def anti_join_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_output(silver.inserts_without_update(views.bill_bronze(spark, sf_dir)))


@query
def union_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = views.bill_bronze(spark, sf_dir)
    return change_output(
        changelog.union_changes(silver.inserts_without_update(bronze), silver.latest_update(bronze))
    )


@query
def crud_reconstruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bill_output(silver.crud_reconstruct(views.bill_bronze(spark, sf_dir), schemas.BILLS))


def merged_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders merged into an empty table, then the line items merged into that."""
    start = silver.merge_changes(
        silver.empty_silver(spark, schemas.BILLS), views.order_bronze(spark, sf_dir), schemas.BILLS
    )
    return silver.current_rows(silver.merge_changes(start, views.line_bronze(spark, sf_dir), schemas.BILLS))


@query
def silver_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bill_output(merged_bills(spark, sf_dir))


@query
def silver_merge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through the bronze stream into a bronze table, and from there, again as a stream,
    into a silver table."""
    root = run_folder(spark, "silver_merge_stream")
    ingest_events(spark, sf_dir, root)
    silver_table = ChangeTable(f"{root}/silver", schemas.BILLS)
    bronze = topics.file_stream(spark, f"{root}/bronze", schemas.BRONZE)
    start_silver(bronze, silver_table, f"{root}/merge", trigger=ALL_AVAILABLE).awaitTermination()
    return bill_output(read_current(spark, silver_table))


@query
def merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a snapshot, line items merged on top in three batches of which the first comes twice and
    is folded; read with the other two laid over."""
    table = ChangeTable(f"{run_folder(spark, 'merge_on_read')}/bills", schemas.BILLS, fold_share=1000.0)
    change_table.append_changes(spark, table, views.order_bronze(spark, sf_dir))
    change_table.fold(spark, table)
    lines = views.line_bronze(spark, sf_dir)
    for batch in (0, 0, 1, 2):
        change_table.append_changes(spark, table, lines.where(F.pmod(F.xxhash64("id", "seq"), F.lit(3)) == batch))
        if batch == 0:
            change_table.fold(spark, table)
    return bill_output(read_current(spark, table))


@query
def evolve_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table that takes up columns its bills do not declare: a nested one whose second field comes
    with a later batch; rows from before have nulls."""
    root = run_folder(spark, "evolve_on_write")
    table = ChangeTable(f"{root}/bills", schemas.BILLS, evolve=True, fold_share=1000.0)
    change_table.append_changes(spark, table, views.order_bronze(spark, sf_dir))
    change_table.fold(spark, table)
    lines = views.line_bronze_wider(spark, sf_dir)
    first = F.col("seq") < 2 * views.LINE_STEP
    for batch in (lines.where(first), lines.where(~first)):
        change_table.append_changes(spark, table, batch)
    return plain_money(read_current(spark, table)).select(
        "id",
        "status",
        "amount",
        F.col("line").cast("long").alias("line"),
        F.coalesce("bought.part", "bought.whole").cast("double").alias("bought"),
    )


@query
def keyed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in several files, out of order and every file twice, through keyed state: the last change of
    each key that comes out is its newest."""
    root = run_folder(spark, "keyed_stream")
    bronze = views.event_bronze(spark, sf_dir)
    for time in ("first", "again"):
        bronze.repartition(2, "seq").write.mode("append").parquet(f"{root}/bronze")
    stream = keyed.advancing(topics.file_stream(spark, f"{root}/bronze", schemas.BRONZE, max_files=1))
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**ALL_AVAILABLE)
        .start(f"{root}/advances")
        .awaitTermination()
    )
    advances = spark.read.schema(schemas.BRONZE).parquet(f"{root}/advances")
    once = advances.groupBy("id", "ts_ms", "seq").count().agg(F.max("count").alias("times"))
    newest = change_output(latest.latest_per_key(advances, "id"))
    return newest.withColumn("times", once.scalar())


@query
def replica_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = silver.as_silver(views.invoices(spark, sf_dir))
    upserted = silver.replica_upsert(target, views.line_bronze(spark, sf_dir), schemas.BILLS)
    return bill_output(silver.current_rows(upserted))


@query
def replica_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events upserted into a replica as a stream, deletes ignored."""
    root = run_folder(spark, "replica_stream")
    replica = ChangeTable(f"{root}/replica", schemas.BILLS)
    bronze = views.bronze_rows(views.event_envelopes(views.event_stream(spark, sf_dir)))
    start_replica(bronze, replica, f"{root}/checkpoint", trigger=ALL_AVAILABLE).awaitTermination()
    return bill_output(read_current(spark, replica))


@query
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts seen in bills, inserted where no customer has the id."""
    seen = views.bills(spark, sf_dir).select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("Seen on "), F.col("device_id").cast("string")).alias("name"),
        F.lit("unknown").alias("email"),
        "updated_at",
    )
    return silver.insert_if_absent(views.customer_users(spark, sf_dir), seen, "id", ("updated_at", "name"))


@query
def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written without a column, appended to with it, and read with the schemas merged."""
    root = run_folder(spark, "schema_evolve")
    views.customer_users(spark, sf_dir).write.parquet(f"{root}/users")
    with_nation = views.supplier_users(spark, sf_dir, "CAST(s_nationkey AS STRING) AS nation")
    with_nation.write.mode("append").parquet(f"{root}/users")
    return lake.read_table(spark, f"{root}/users", mergeSchema="true").select("id", "name", "email", "nation")


@query
def keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = views.device_logs(spark, sf_dir)
    return latest.keep_latest(logs, ["event_type", "device_id"], "timestamp", "event_id").select(
        "event_type", "device_id", "event_id", "timestamp"
    )


@query
def id_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.id_high_water(
        {
            "users": views.users(spark, sf_dir),
            "devices": views.devices(spark, sf_dir),
            "cam_bills": views.bills(spark, sf_dir),
        }
    )


@query
def conditional_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag the names without a tag, twice: the second pass finds nothing to do."""
    users, untagged = views.users(spark, sf_dir), ~F.col("name").like("%(%")
    tag = {"name": F.concat("name", F.lit(" (VIP)")), "updated_at": F.lit(SNAPSHOT_MS)}
    return edits.update_where(edits.update_where(users, untagged, **tag), untagged, **tag)


@query
def toggle_device_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = views.devices(spark, sf_dir)
    flipped = edits.update_where(devices, F.lit(True), status=business.flip_status(F.col("status")))
    return flipped.select("id", "device_type", "status")


@query
def settle_pending_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = views.invoices(spark, sf_dir)
    return bill_output(
        edits.update_where(
            invoices, F.col("status") == "pending", status=F.lit("paid"), updated_at=F.lit(SNAPSHOT_MS)
        )
    )


@query
def scalar_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pending bill, picked in a seeded order, is paid."""
    invoices = views.invoices(spark, sf_dir)
    pending = invoices.where(F.col("status") == "pending")
    picked = edits.pick_one(pending, "id", edits.seeded_order("id", PICK_SEED))
    return bill_output(edits.row_with_key(invoices, "id", picked).withColumn("status", F.lit("paid")))


# The gold layer


def user_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_360(views.users(spark, sf_dir), views.devices(spark, sf_dir), views.bills(spark, sf_dir), AS_OF)


def device_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.device_performance(
        views.devices(spark, sf_dir), views.users(spark, sf_dir), views.bills(spark, sf_dir), AS_OF
    )


@query
def user_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_money(user_mart(spark, sf_dir))


@query
def device_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_money(device_mart(spark, sf_dir))


@query
def device_performance_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_money(
        marts.device_performance_latest(
            views.devices(spark, sf_dir), views.users(spark, sf_dir), views.bills(spark, sf_dir), AS_OF
        )
    )


def kpi_over(spark: SparkSession, sf_dir: str, bills: DataFrame) -> DataFrame:
    row = marts.executive_kpi(views.users(spark, sf_dir), views.devices(spark, sf_dir), bills, REPORT_DATE, AS_OF)
    return plain_money(row)


@query
def executive_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_over(spark, sf_dir, views.bills(spark, sf_dir))


@query
def kpi_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI row over bills that come out of the change log."""
    return kpi_over(spark, sf_dir, merged_bills(spark, sf_dir))


def mart_differences(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What merging the line items changes in the bills that the orders made, and the totals before."""
    stored = silver.merge_changes(silver.empty_silver(spark, schemas.BILLS), views.order_bronze(spark, sf_dir), schemas.BILLS)
    ops = (*changelog.WRITE_OPS, changelog.DELETE_OP)
    newest = silver.newest_changes(views.line_bronze(spark, sf_dir), schemas.BILLS, "id", ops)
    before = increments.inserted(silver.current_rows(stored))
    return {"before": before, "changed": increments.differences(stored, newest)}


@query
def user_360_by_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user mart from bill totals before the line items and the differences they make."""
    bills = mart_differences(spark, sf_dir)
    totals = increments.bill_differences(bills["before"]).unionByName(increments.bill_differences(bills["changed"]))
    devices = increments.device_differences(increments.inserted(views.devices(spark, sf_dir)))
    return plain_money(increments.user_360(views.users(spark, sf_dir), devices, totals, AS_OF))


@query
def kpi_by_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI row from totals before the line items and the differences they make."""
    bills = mart_differences(spark, sf_dir)
    users, devices = increments.inserted(views.users(spark, sf_dir)), increments.inserted(views.devices(spark, sf_dir))
    before = increments.kpi_differences(users, devices, bills["before"])
    changed = increments.kpi_differences(users.limit(0), devices.limit(0), bills["changed"])
    return plain_money(increments.executive_kpi(before.unionByName(changed), REPORT_DATE, AS_OF))


@query
def user_main_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.main_plan(views.bills(spark, sf_dir))


@query
def device_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.device_status_counts(views.devices(spark, sf_dir))


@query
def paid_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = marts.bill_totals(views.bills(spark, sf_dir))
    return totals.select("bill_user_id", "total_bills", F.col("total_spent").cast("double").alias("total_spent"))


@query
def vip_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = marts.bill_totals(views.bills(spark, sf_dir))
    return totals.select("bill_user_id", business.vip_tier(F.col("total_spent")).alias("vip_tier"))


@query
def bills_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_money(marts.bills_by_day(views.bills(spark, sf_dir)))


@query
def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_money(marts.monthly_revenue(views.bills(spark, sf_dir)))


@query
def contract_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_money(contract.conform(device_mart(spark, sf_dir), schemas.DEVICE_PERFORMANCE))


@query
def mart_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{run_folder(spark, 'mart_export')}/user_360"
    file_sinks.export_mart(contract.conform(user_mart(spark, sf_dir), schemas.USER_360), path)
    return plain_money(spark.read.schema(schemas.USER_360).json(path))


@query
def folded_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user mart exported three times and folded after the second: read from the current part and the
    last run."""
    root = run_folder(spark, "folded_exports")
    tables = views.users(spark, sf_dir), views.devices(spark, sf_dir), views.bills(spark, sf_dir)
    for run, as_of in enumerate(("2024-01-30 00:00:00", "2024-01-31 00:00:00", AS_OF), 1):
        mart = contract.conform(marts.user_360(*tables, as_of), schemas.USER_360)
        file_sinks.export_mart(mart, f"{root}/gold/user_360/run={run:012d}")
        if run == 2:
            jobs.fold_gold(spark, root, "user_360")
    return plain_money(jobs.read_gold(spark, root, "user_360"))


@query
def skip_empty_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart appended once with its rows and once empty: the second run adds nothing, not even a file."""
    path = f"{run_folder(spark, 'skip_empty_export')}/users"
    users = views.users(spark, sf_dir)
    first = file_sinks.export_mart(users, path)
    files = len(lake.child_names(spark, path))
    second = file_sinks.export_mart(edits.emptied(users), path)
    return spark.read.schema(schemas.USERS).json(path).select(
        "id",
        F.lit(first).cast("long").alias("first_rows"),
        F.lit(second).cast("long").alias("second_rows"),
        F.lit(len(lake.child_names(spark, path)) - files).alias("new_files"),
    )


@query
def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accounts, overwritten by the customers."""
    path = f"{run_folder(spark, 'overwrite_table')}/users"
    file_sinks.overwrite_table(views.users(spark, sf_dir), path)
    file_sinks.overwrite_table(views.customer_users(spark, sf_dir), path)
    return lake.read_required(spark, path)


@query
def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and then suppliers numbered from a stored counter; the table truncated, its counter
    restarted; customers numbered again: rows and keys after each step."""
    table = NumberedTable(f"{run_folder(spark, 'numbered_rows')}/users", schemas.USERS)
    first, second = (view(spark, sf_dir).drop("id") for view in (views.customer_users, views.supplier_users))
    states = []

    def note(step: str) -> None:
        found = numbered.read_rows(spark, table).agg(
            F.count(F.lit(1)).alias("table_rows"), F.count_distinct("id").alias("keys"), F.min("id").alias("least"), F.max("id").alias("most")
        )
        row = found.first()
        states.append((step, *row, numbered.high_water(spark, table)))

    for step, rows in (("first", first), ("second", second), ("truncated", None), ("again", first)):
        numbered.append_rows(spark, table, rows) if rows is not None else numbered.truncate(spark, [table])
        note(step)
    return spark.createDataFrame(states, "step string, table_rows long, keys long, least long, most long, high_water long")


@query
def truncate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stored accounts before and after they are emptied."""
    path = f"{run_folder(spark, 'truncate_table')}/users"
    file_sinks.overwrite_table(views.users(spark, sf_dir), f"{path}/full")
    full = spark.read.schema(schemas.USERS).parquet(f"{path}/full")
    file_sinks.overwrite_table(edits.emptied(full), f"{path}/emptied")
    emptied = spark.read.schema(schemas.USERS).parquet(f"{path}/emptied")
    count = F.count(F.lit(1)).alias("table_rows")
    return full.agg(F.lit("full").alias("state"), count).unionByName(emptied.agg(F.lit("emptied").alias("state"), count))


@query
def tables_in_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job over several tables of which one is missing: that one is reported, the others go on."""
    names = ["customer", "orders", "no_such_table", "supplier"]
    count = F.count(F.lit(1)).alias("table_rows")
    results, failures = for_each_table(
        names, lambda name: lake.read_required(spark, f"{sf_dir}/{name}.parquet").agg(F.lit(name).alias("name"), count)
    )
    counted = functools.reduce(DataFrame.unionByName, results.values())
    failed = spark.createDataFrame([(name, None) for name in failures], "name string, table_rows long")
    return counted.unionByName(failed)


# The file path


@query
def device_logs_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{run_folder(spark, 'device_logs')}/logs"
    file_sinks.write_device_logs(views.device_logs(spark, sf_dir), folder)
    return facts.device_logs_fact(file_sources.accepted(file_sources.scan_device_logs(spark, folder)))


@query
def payment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{run_folder(spark, 'payments')}/files"
    file_sinks.write_payments(views.payments_of(views.invoices(spark, sf_dir)), folder)
    return plain_money(facts.payment_fact(file_sources.accepted(file_sources.scan_payments(spark, folder))))


@query
def file_stream_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device logs in files through the file stream: the second run finds the first run's files again and
    one with a broken record."""
    root = run_folder(spark, "file_stream_facts")
    logs = views.device_logs(spark, sf_dir)
    later = F.col("severity") == "ERROR"

    def run() -> None:
        stream = file_streams.arriving(spark, file_streams.LOGS, f"{root}/files")
        paths = f"{root}/facts", f"{root}/rejected", f"{root}/checkpoint"
        file_streams.start_files(stream, file_streams.LOGS, *paths, trigger=ALL_AVAILABLE).awaitTermination()

    file_sinks.write_device_logs(logs.where(~later), f"{root}/files")
    run()
    file_sinks.write_device_logs(logs, f"{root}/files")
    broken = logs.where(later).orderBy("event_id").limit(1).select(F.concat(F.lit("broken "), "event_id").alias("value"))
    broken.write.text(f"{root}/files/year=2024/month=01/broken")
    run()
    found = file_streams.read_facts(spark, file_streams.LOGS, f"{root}/facts")
    rejected = spark.read.schema("_file string, record string").parquet(f"{root}/rejected")
    return found.withColumn("rejected", rejected.agg(F.count(F.lit(1)).alias("n")).scalar())


@query
def monthly_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct devices by month from stored daily sketches, held against the exact count: within four
    standard errors."""
    folder = f"{run_folder(spark, 'monthly_devices')}/daily"
    logs = views.device_logs(spark, sf_dir)
    sketches.daily_devices(logs).write.parquet(folder)
    rolled = sketches.rolled_up(spark.read.parquet(folder))
    off = F.abs(F.col("devices") - F.col("exact_devices"))
    return rolled.join(sketches.exact(logs), ["month", "event_type"]).select(
        F.date_format("month", "yyyy-MM").alias("month"),
        "event_type",
        "events",
        "exact_devices",
        (off <= 4 * sketches.STANDARD_ERROR * F.col("exact_devices") + 1).alias("within"),
    )


@query
def reconcile_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = views.invoices(spark, sf_dir)
    return plain_money(facts.reconcile_payments(invoices, views.payments_of(invoices)))


@query
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = views.invoices(spark, sf_dir)
    return plain_money(facts.reconcile_summary(facts.reconcile_payments(invoices, views.payments_of(invoices))))


@query
def connection_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.connection_errors(views.device_logs(spark, sf_dir), views.devices(spark, sf_dir))


@query
def subscription_renewals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_money(facts.subscription_renewals(views.invoices(spark, sf_dir), RENEW_UNTIL))


@query
def bills_with_renewals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_money(facts.bills_with_renewals(views.invoices(spark, sf_dir), RENEW_UNTIL))


# Scalar functions


@query
def email_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "documents").select("doc_id", text.fold_accents(F.col("text")).alias("folded"))


@query
def epoch_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = moments.to_millis(F.col("ts"))
    at = moments.from_millis(ms)
    return views.events(spark, sf_dir).select(
        "event_id",
        ms.alias("ts_ms"),
        moments.epoch_text(at).alias("second"),
        F.to_date(at).cast("string").alias("day"),
        F.date_format(at, "yyyyMMdd").alias("compact_day"),
    )
