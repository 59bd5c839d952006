"""The jobs, as run by spark-submit: ``python -m streambed.plans.jobs silver --root hdfs://…``.

Layout below the root: ``bronze/<table>``, ``silver/<table>``, ``gold/<mart>``, ``checkpoints/…``.
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from streambed import schemas
from streambed.operators import changelog, contract, latest
from streambed.plans import marts
from streambed.session import build_session
from streambed.sinks.files import export_mart
from streambed.sinks import change_table
from streambed.sinks import silver_table as st
from streambed.sinks.change_table import ChangeTable
from streambed.sinks.silver_table import read_current
from streambed.sources import lake, topics
from streambed.streaming import files as file_streams
from streambed.streaming.bronze import ALL_AVAILABLE, EVERY_TEN_MINUTES, start_bronze, start_quarantine
from streambed.streaming.progress import ProgressLog
from streambed.streaming.silver import start_silver
from streambed.streaming.supervise import for_each_table, keep_running, supervise

log = logging.getLogger(__name__)

# The sort keys of the exported marts.
MART_KEYS = {
    "user_360": ["user_id"],
    "device_performance": ["device_type", "device_id"],
    "daily_executive_kpi": ["report_date"],
}


def silver_table(root: str, name: str) -> ChangeTable:
    return ChangeTable(f"{root}/silver/{name}", schemas.TABLES[name], evolve=True)


def run_bronze(
    spark: SparkSession,
    root: str,
    servers: str,
    prefix: str,
    avro_schemas: dict[str, str] | None = None,
    trigger: dict | None = None,
    max_offsets: int | None = None,
) -> dict:
    """Per table a stream to bronze and one that writes undecodable messages aside, under supervision.

    ``avro_schemas`` maps a table to its Avro schema text; a table without one carries JSON envelopes.
    ``max_offsets`` bounds a micro-batch. Returns what failed to start, by table.
    """

    def start(name: str):
        avro = (avro_schemas or {}).get(name)
        decode = changelog.avro_envelope(avro) if avro else changelog.json_envelope()
        raw = topics.kafka_topic(spark, servers, f"{prefix}.{name}", max_offsets)
        paths = f"{root}/bronze/{name}", f"{root}/checkpoints/bronze_{name}"
        aside = f"{root}/quarantine/{name}", f"{root}/checkpoints/quarantine_{name}"
        return [
            start_bronze(raw, decode, *paths, name=f"stream_{name}", trigger=trigger),
            start_quarantine(raw, decode, *aside, name=f"quarantine_{name}", trigger=trigger),
        ]

    started, failures = for_each_table(schemas.TABLES, start)
    supervise(spark, [query for queries in started.values() for query in queries])
    return failures


def run_silver(
    spark: SparkSession,
    root: str,
    continuous: bool = False,
    max_files: int | None = None,
) -> dict:
    """Merge what bronze received since the last run into silver, table by table.

    The file stream's checkpoint knows which bronze files are done, so a run reads the new
    ones only, including late records that went to the folder of an older day. ``max_files``
    bounds a merge, so that the first run over a long history goes in several.
    """

    def start(name: str):
        path = f"{root}/bronze/{name}"
        if not lake.table_exists(spark, path):
            raise lake.MissingTable(path)
        bronze = topics.file_stream(spark, path, schemas.BRONZE, max_files)
        trigger = EVERY_TEN_MINUTES if continuous else ALL_AVAILABLE
        checkpoint = f"{root}/checkpoints/silver_{name}"
        query = start_silver(bronze, silver_table(root, name), checkpoint, f"silver_{name}", trigger)
        if not continuous:
            query.awaitTermination()
        return query

    started, failures = for_each_table(schemas.TABLES, start)
    supervise(spark, list(started.values()))
    return failures


def run_files(
    spark: SparkSession, root: str, continuous: bool = False, max_files: int | None = None, restarts: int = 3
) -> dict:
    """Take in the log and payment files that arrived below ``files/<kind>``: facts below ``facts``, broken
    records below ``rejected``, read files moved to ``archive``. A stream that fails starts again."""

    def starter(path: file_streams.FilePath):
        def start():
            stream = file_streams.arriving(spark, path, f"{root}/files/{path.name}", f"{root}/archive/{path.name}", max_files)
            paths = [f"{root}/{part}/{path.name}" for part in ("facts", "rejected", "checkpoints/files")]
            trigger = EVERY_TEN_MINUTES if continuous else ALL_AVAILABLE
            return file_streams.start_files(stream, path, *paths, name=f"files_{path.name}", trigger=trigger)

        return start

    kinds = {path.name: path for path in (file_streams.LOGS, file_streams.PAYMENTS)}
    there = {name: starter(path) for name, path in kinds.items() if lake.table_exists(spark, f"{root}/files/{name}")}
    missing = {name: lake.MissingTable(f"{root}/files/{name}") for name in kinds if name not in there}
    return missing | keep_running(spark, there, restarts)


def run_fold(spark: SparkSession, root: str) -> dict:
    """Fold every silver table's changes into its next snapshot, beside running merges, and every mart's
    exports into its current part."""
    _, failures = for_each_table(schemas.TABLES, lambda name: change_table.fold(spark, silver_table(root, name)))
    _, more = for_each_table(schemas.MARTS, lambda name: fold_gold(spark, root, name))
    return failures | more


def read_silver(spark: SparkSession, root: str, name: str, required: bool = False) -> DataFrame:
    """Live silver rows; an optional table that does not exist yet has none."""
    table = silver_table(root, name)
    if required and not st.exists(spark, table):
        raise lake.MissingTable(table.path)
    return read_current(spark, table)


def gold_marts(spark: SparkSession, root: str, report_date: str, as_of: str | None = None) -> dict[str, DataFrame]:
    users = read_silver(spark, root, "users", required=True)
    devices, bills = read_silver(spark, root, "devices"), read_silver(spark, root, "cam_bills")
    return {
        "user_360": marts.user_360(users, devices, bills, as_of),
        "device_performance": marts.device_performance(devices, users, bills, as_of),
        "daily_executive_kpi": marts.executive_kpi(users, devices, bills, report_date, as_of),
    }


def gold_runs(spark: SparkSession, root: str, name: str) -> list[int]:
    """The numbers of a mart's exports."""
    found = [child.partition("run=")[2] for child in lake.child_names(spark, f"{root}/gold/{name}")]
    return [int(number) for number in found if number.isdigit()]


def folded_gold(spark: SparkSession, root: str, name: str) -> list[int]:
    """The numbers up to which a mart's exports have been folded."""
    path = f"{root}/gold_current/{name}"
    found = [int(number) for number in lake.child_names(spark, path) if number.isdigit()]
    return [n for n in found if lake.path_exists(spark, f"{path}/{n:012d}/_SUCCESS")]


def run_gold(
    spark: SparkSession, root: str, report_date: str, as_of: str | None = None, fmt: str = "json"
) -> dict[str, int]:
    """Compute the three marts and export them, each run to a folder of its own; returns the row counts."""
    counts = {}
    for name, mart in gold_marts(spark, root, report_date, as_of).items():
        run = max([0, *gold_runs(spark, root, name), *folded_gold(spark, root, name)]) + 1
        counts[name] = export_mart(contract.conform(mart, schemas.MARTS[name]), f"{root}/gold/{name}/run={run:012d}", fmt)
    return counts


def gold_parts(spark: SparkSession, root: str, name: str, fmt: str = "json") -> list[DataFrame]:
    """What a reader of a mart opens: the current part, and the exports since."""
    schema, whole = schemas.MARTS[name], folded_gold(spark, root, name)
    base = max(whole, default=0)
    parts = [spark.read.schema(schema).parquet(f"{root}/gold_current/{name}/{base:012d}")] if base else []
    since = [f"{root}/gold/{name}/run={n:012d}" for n in gold_runs(spark, root, name) if n > base]
    return parts + ([spark.read.schema(schema).format(fmt).load(since)] if since else [])


def read_gold(spark: SparkSession, root: str, name: str, fmt: str = "json") -> DataFrame:
    """An exported mart as its target keeps it: of all runs, one row per key, the newest run's.

    Rows of one run that share a key (a device's bills) are told apart by their other columns,
    so the row that stays does not depend on chance.
    """
    exported = reduce(DataFrame.unionByName, gold_parts(spark, root, name, fmt) or [spark.createDataFrame([], schemas.MARTS[name])])
    others = [c for c in exported.columns if c not in (*MART_KEYS[name], "updated_at")]
    return latest.keep_latest(exported, MART_KEYS[name], "updated_at", *others)


def fold_gold(spark: SparkSession, root: str, name: str, fmt: str = "json") -> bool:
    """Write a mart's current rows, in ranges of its key, so that readers open them and what comes after; the
    exports stay as history. Whether there was anything new."""
    runs, whole = gold_runs(spark, root, name), folded_gold(spark, root, name)
    if max(runs, default=0) <= max(whole, default=0):
        return False
    path = f"{root}/gold_current/{name}"
    rows = read_gold(spark, root, name, fmt)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(tasks, *MART_KEYS[name]).write.mode("overwrite").parquet(f"{path}/{max(runs):012d}")
    for number in whole[:-1]:  # the last one stays for readers that have begun
        folder, fs = lake.hadoop_path(spark, f"{path}/{number:012d}")
        fs.delete(folder, True)
    return True


def run_check(spark: SparkSession, root: str, layer: str = "silver") -> dict:
    """Show what the tables of a layer hold."""

    def show(name: str) -> int:
        if layer == "bronze":
            df = lake.read_required(spark, f"{root}/bronze/{name}")
            sample = lake.inspect(df, ["id", "op", "ts_ms", "year", "month", "day"], ["ts_ms", "seq"], 5)
        else:
            df = read_silver(spark, root, name, required=True)
            sample = df.limit(20)
        rows = df.count()
        print(f"{layer} {name}: {rows} rows")
        sample.show(truncate=False)
        return rows

    counts, failures = for_each_table(schemas.TABLES, show)
    return {**counts, **failures}


def main(argv: list[str] | None = None) -> None:
    """Run one job; the exit code is 1 if any table failed."""
    parser = argparse.ArgumentParser(description="change-data-capture lakehouse jobs")
    parser.add_argument("job", choices=["bronze", "silver", "fold", "files", "gold", "check"])
    parser.add_argument("--root", required=True, help="lake folder all executors can reach")
    parser.add_argument("--servers", default="localhost:9092", help="bronze: bootstrap servers")
    parser.add_argument("--prefix", default="cdc_data.public", help="bronze: topic name before the table")
    parser.add_argument("--avro-schema", action="append", default=[], metavar="TABLE=FILE", help="bronze")
    parser.add_argument("--max-offsets", type=int, help="bronze: most messages per micro-batch and table")
    parser.add_argument("--max-files", type=int, help="silver, files: most files per batch")
    parser.add_argument("--continuous", action="store_true", help="silver, files: keep going every ten minutes")
    parser.add_argument("--report-date", default=date.today().isoformat(), help="gold")
    parser.add_argument("--layer", choices=["bronze", "silver"], default="silver", help="check")
    args = parser.parse_args(argv)

    spark = build_session(f"streambed-{args.job}")
    failed: dict = {}
    if args.job in ("bronze", "silver", "files"):
        spark.streams.addListener(ProgressLog(spark, f"{args.root}/progress/{args.job}"))
    if args.job == "bronze":
        avro = {}
        for entry in args.avro_schema:
            table, _, file = entry.partition("=")
            with open(file, encoding="utf-8") as handle:
                avro[table] = handle.read()
        failed = run_bronze(spark, args.root, args.servers, args.prefix, avro, max_offsets=args.max_offsets)
    elif args.job == "silver":
        failed = run_silver(spark, args.root, args.continuous, args.max_files)
    elif args.job == "files":
        failed = run_files(spark, args.root, args.continuous, args.max_files)
    elif args.job == "fold":
        failed = run_fold(spark, args.root)
    elif args.job == "gold":
        print(run_gold(spark, args.root, args.report_date))
    else:
        shown = run_check(spark, args.root, args.layer)
        failed = {name: result for name, result in shown.items() if isinstance(result, Exception)}
    if failed:
        for name, error in failed.items():
            log.error("%s failed: %s", name, error)
        sys.exit(1)


if __name__ == "__main__":
    main()
