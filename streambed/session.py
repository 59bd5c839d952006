"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every operator relies on; all can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# A task's rows are bounded in bytes, at every size of the tables: rows in files and shuffles are packed, and
# take some 25 times as much as text or in a sort. Sessions may set less.
MOST_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}

# Folders are listed by so many tasks per core; Spark's own default, a task per folder, costs more than
# the listing itself where a table has thousands of folders.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_CORE = 4


def build_session(app_name: str, **conf: str) -> SparkSession:
    """A session for the jobs. Master, memory and shuffle width come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in MOST_BYTES.items():
        if as_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    if spark.conf.get(LISTING, None) is None:
        spark.conf.set(LISTING, str(LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session (tests) without the setting gets one of its own; a cluster
    without it is an error, because a machine-local folder would not survive there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(os.path.join(tempfile.gettempdir(), "streambed-checkpoints"))
    return context.getCheckpointDir()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, never reused folder below the shared one, removed when the driver's JVM ends."""
    folder = f"{shared_folder(spark)}/streambed/{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder
