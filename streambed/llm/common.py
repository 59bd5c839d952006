"""What the operators share: reading tables, bounded Arrow batches, tables between steps.

Joins with tables whose size nothing bounds carry a merge hint, at every size: they are never
broadcast, and Spark can split a frequent key's rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streambed.llm import bits
from streambed.session import run_folder

# Rows handed to Python at once. Rows hold whole texts, so Spark's 10,000 would be too many.
BATCH_ROWS = 512
# Rows and bytes a Python step gathers before it hands them back.
OUT_ROWS = 2048
OUT_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """Bound the rows of an Arrow batch in this session, for steps that read whole texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def text_hash(column: str) -> Column:
    """64 bits of a text; a null text counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def remove_at_end(spark: SparkSession, folder: str) -> None:
    """Have the driver's JVM remove a folder, which must exist, when it ends."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, read back: computed once, without lineage, in reach
    of every executor. It goes when the driver's JVM ends."""
    folder = f"{run_folder(df.sparkSession, name)}/rows"
    df.write.parquet(folder)
    remove_at_end(df.sparkSession, folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# Names that ``keyed`` adds and ``split`` compares; they begin like no column of a table.
OWN_ID, OWN_HASH, KEY_ID, KEY_HASH = "__own_id", "__own_hash", "__key_id", "__key_hash"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with its rows' identity: the id as a long and the text's hash."""
    return docs.withColumn(OWN_ID, F.col(id_col).cast("long")).withColumn(OWN_HASH, text_hash(text_col))


def same_document() -> Column:
    return F.col(OWN_ID).eqNullSafe(F.col(KEY_ID)) & (F.col(OWN_HASH) == F.col(KEY_HASH))


def split(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` (with its identity) as rows that are surely not among ``keys``, and all others.

    ``keys`` has KEY_ID and KEY_HASH. Whole texts need not be shuffled for the first kind; the second
    has to meet ``keys`` in a join. The test is a bit table of fixed size.
    """
    mixed = lambda a, b: F.xxhash64(F.coalesce(F.col(a), F.lit(-1)), b)
    known = bits.maybe_in(keys.select(mixed(KEY_ID, KEY_HASH)), mixed(OWN_ID, OWN_HASH))
    own = keyed(docs, id_col, text_col).withColumn("__known", known)
    return own.where(~F.col("__known")).drop("__known"), own.where("__known").drop("__known")


def pieces(text: str, limit: int = 1 << 20) -> Iterator[str]:
    """The text in parts of about ``limit`` characters, cut before a blank that follows no blank.

    A text without such a place stays whole.
    """
    start = 0
    while len(text) - start > limit:
        at = text.find(" ", start + limit)
        while at >= 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:] if start else text
