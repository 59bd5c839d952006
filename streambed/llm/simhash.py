"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits share a variant that differs from each in at most
half of them. So every distinct fingerprint emits all variants within half the radius, variants are
grouped, and what collides is linked once its bit distance is checked. A variant has at most as many
fingerprints around it as the ball has members (65 for r = 2), so no group is large, however many
documents carry one fingerprint.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streambed.llm import common
from streambed.llm.components import components

SEED = 42
# Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned SimHash of a text's word shingles, repeats counted.

    A-Z are lower-cased; words are what blanks and the characters 9 to 13 separate. With fewer words
    than a shingle has, all of them are one shingle; without words the fingerprint is zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    count = len(words) - shingle + 1
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, count, CHUNK):
        upto = min(at + CHUNK, count)
        first, last = starts[at:upto].tolist(), ends[at + shingle - 1 : upto + shingle - 1].tolist()
        hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(first, last)], "<u8", upto - at)
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(k) for k in np.flatnonzero(2 * bits > count))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fingerprint as a signed long), one row per row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fingerprint", pa.int64())])

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(text.as_py(), shingle) for text in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], schema=schema
            )

    return (
        common.small_batches(docs)
        .select(
            F.col(id_col).cast("long").alias("doc_id"),
            common.text_hash(text_col).alias("text_hash"),
            F.col(text_col).cast("string").alias("text"),
        )
        .mapInArrow(run, "doc_id long, text_hash long, fingerprint long")
    )


def ball(radius: int) -> list[int]:
    """All 64-bit masks with at most ``radius`` set bits, as signed longs."""
    masks = [sum(1 << k for k in chosen) for n in range(radius + 1) for chosen in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _variants(prints: DataFrame, radius: int) -> DataFrame:
    masks = F.array(*[F.lit(m) for m in ball(radius)])
    return prints.select("fingerprint", F.explode(masks).alias("mask")).select(
        F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant"), "fingerprint"
    )


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(u, v): links between distinct fingerprints, as many as their components need.

    ``prints`` has the distinct fingerprints. For an even radius all members of a variant's group lie
    within the radius of each other, and one link from each to the smallest joins them all. For an odd
    one the larger half meets the smaller half. Every link's distance is checked.
    """
    half = max_bits // 2
    if max_bits % 2:
        near = _variants(prints, half).withColumnRenamed("fingerprint", "v")
        pairs = _variants(prints, half + 1).withColumnRenamed("fingerprint", "u").join(near, "variant")
    else:
        least = F.min("fingerprint").over(Window.partitionBy("variant"))
        pairs = _variants(prints, half).select(F.col("fingerprint").alias("u"), least.alias("v"))
    apart = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    return pairs.where("u <> v").where(apart <= max_bits).select("u", "v").distinct()


def groups(found: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fingerprint, root, component_id) of each distinct fingerprint of ``fingerprints``' rows."""
    prints = common.written(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "fingerprints")
    members = components(links(prints, max_bits))
    rooted = prints.join(members.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return common.written(rooted.join(ids, "root").select("fingerprint", "root", "component_id"), "groups")


def hexadecimal(column: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text_hash, fingerprint, root and component_id of every row.

    ``root`` names the group: the documents that links of at most ``max_bits`` differing bits join,
    directly or by way of others. ``component_id`` is the smallest id in it. A null or empty text has
    the fingerprint zero and is linked like any other; a null id stays null and counts for no
    ``component_id``, which is null if the whole group has none. Repeated rows are returned as often as
    they come. Other columns are left out.
    """
    found = common.written(fingerprints(docs, shingle, id_col, text_col), "documents")
    return found.join(groups(found, max_bits).hint("merge"), "fingerprint")


def deduplicate(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with one row of each group: that of the smallest id.

    Among rows with that id the one with the smallest text hash stays, once. A group of null ids
    alone keeps its smallest text hash. All columns are returned as they were.
    """
    found = near_duplicates(docs, shingle, max_bits, id_col, text_col).select("root", "component_id", "doc_id", "text_hash")
    counted = found.groupBy("root", "component_id", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    order = Window.partitionBy("root").orderBy("text_hash")
    first = counted.where("doc_id <=> component_id").withColumn("n", F.row_number().over(order)).where("n = 1")
    first = common.written(first.select("doc_id", "text_hash").toDF("__first_id", "__first_hash"), "firsts")
    # Rows to drop, and rows to keep once of several: all others stay as they are.
    is_first = F.col("doc_id").eqNullSafe(F.col("__first_id")) & (F.col("text_hash") == F.col("__first_hash"))
    judged = counted.join(first.withColumn("kept", F.lit(True)).hint("merge"), is_first, "left")
    touched = judged.where("kept is null or rows > 1").select("doc_id", "text_hash", F.coalesce("kept", F.lit(False)))
    touched = common.written(touched.toDF(common.KEY_ID, common.KEY_HASH, "__kept"), "touched")
    whole, others = common.split(docs, touched, id_col, text_col)
    others = others.join(touched.hint("merge"), common.same_document(), "left").where("__kept is null or __kept")
    others = others.dropDuplicates([common.OWN_ID, common.OWN_HASH])
    columns = [f"`{c}`" for c in docs.columns]
    return whole.select(*columns).unionByName(others.select(*columns))
