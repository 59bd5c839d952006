"""A training corpus from raw documents: each stage works on what the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``; the last returns packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streambed.llm import common, decontaminate, line_dedup, packing, simhash, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from labelled rows outside the held-out part."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"), learn)
    return toxicity.reject(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of runs of lines are deleted from the texts; every document stays."""
    return line_dedup.remove_repeated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.deduplicate(docs, shingle=3, max_bits=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", pack),
]

# Hashing, convolution and byte-pair encoding have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents`` after all stages."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
