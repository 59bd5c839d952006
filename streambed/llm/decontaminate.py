"""Benchmark passages in documents, found by spaced seeds.

A seed mask looks at some positions of a stretch of words and ignores the others, so that a replaced
word under an ignored position does not hide a match. Hashes of all masked stretches of the benchmark
meet those of all documents in an equi-join; around each hit the words are compared one by one, and a
stretch of ``WINDOW`` words with at least ``MATCHES`` equal ones is an overlap.

The masks find every such stretch: whichever words of it differ, one mask fits between them (tested
over all cases). Documents first pass a bit table of the benchmark's hashes, of a fixed size whatever
the data's; it lets every true hit pass, and the join decides.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streambed.llm import bits, common

# Words compared, and how many of them must be equal: 0.8.
WINDOW = 15
MATCHES = 12
# Shorter items must be found whole and unchanged; still shorter ones say too little and are left out.
LEAST_WORDS = 8
# Positions that each mask looks at.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 4, 8, 9, 10), (0, 1, 3, 5, 9, 10))
WHOLE = tuple(range(LEAST_WORDS))
# Words hashed by one mask at once, and words kept with their hashes in each Python worker.
CHUNK = 1 << 18
KEPT_WORDS = 120_000

_WORD = re.compile(r"\w+")
_HITS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("seed", pa.int64()),
        ("position", pa.int64()),
        ("first", pa.int64()),
        ("around", pa.binary()),
    ]
)
_HITS_SQL = "doc_id long, text_hash long, seed long, position long, first long, around binary"
_SEEDS_SQL = "item_id long, item_size int, item_first long, item_around binary, seed long, position long"


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value
        return value


_kept = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words: letters, digits and underscores, lower-cased."""
    parts = []
    for part in common.pieces(text or ""):
        found = _WORD.findall(part.lower())
        parts.append(np.fromiter(map(_kept.__getitem__, found), np.uint64, len(found)))
    return np.concatenate(parts)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def seeds(words: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """The hash of the words under a mask at each position it fits."""
    count = len(words) - mask[-1]
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, number + 1, np.uint64)
    for offset in mask:
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[offset : offset + count]
    return _mixed(total)


def item_seeds(words: np.ndarray) -> list[tuple[int, int]]:
    """(seed, position) of an item; a short one has its first words' only."""
    if len(words) < LEAST_WORDS:
        return []
    if len(words) < WINDOW:
        return [(int(seeds(words[:LEAST_WORDS], WHOLE, len(MASKS))[0]), 0)]
    found = ((seeds(words, mask, k), mask) for k, mask in enumerate(MASKS))
    return [(int(seed), at) for values, _ in found for at, seed in enumerate(values)]


def benchmark_seeds(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, item_size, item_first, item_around, seed, position): items with equal words once, under the
    smallest id. Like a document's hit, each seed has only the words around it, from ``item_first`` on."""
    words_schema = pa.schema([("item_id", pa.int64()), ("item_words", pa.binary())])

    def tokenised(batches):
        for batch in batches:
            found = [word_hashes(text.as_py()).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], schema=words_schema)

    def rows(batches):
        for batch in batches:
            for item_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = np.frombuffer(packed, np.uint64)
                for seed, at in item_seeds(words):
                    first = max(0, at - WINDOW)
                    around = words[first : at + WINDOW + LEAST_WORDS].tobytes()
                    yield item_id, len(words), first, around, int(np.uint64(seed).astype(np.int64)), at

    def seeded(batches):
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        names = [part.split()[0] for part in _SEEDS_SQL.split(", ")]
        each = rows(batches)
        while found := list(islice(each, common.OUT_ROWS)):
            columns = [pa.array(c, kind) for c, kind in zip(zip(*found), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    own = common.small_batches(benchmark).select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")
    )
    items = own.mapInArrow(tokenised, "item_id long, item_words binary").groupBy("item_words")
    once = items.agg(F.min("item_id").alias("item_id")).select("item_id", "item_words")
    return once.mapInArrow(seeded, _SEEDS_SQL)


def document_hits(
    docs: DataFrame, table: np.ndarray, short_items: bool, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per masked stretch of a document that may be one of the benchmark's, with the words around it."""
    sent = docs.sparkSession.sparkContext.broadcast(table)
    masks = (*MASKS, WHOLE) if short_items else MASKS

    def rows(batches):
        known = sent.value
        for batch in batches:
            for doc_id, text_hash, text in zip(*(batch.column(k) for k in range(3))):
                words = word_hashes(text.as_py())
                for number, mask in enumerate(masks):
                    for start in range(0, max(0, len(words) - mask[-1]), CHUNK):
                        values = seeds(words[start : start + CHUNK + mask[-1]], mask, number)
                        for at in bits.places(known, values).tolist():
                            place = start + at
                            first = max(0, place - WINDOW)
                            around = words[first : place + WINDOW + LEAST_WORDS].tobytes()
                            seed = int(values[at].astype(np.int64))
                            yield doc_id.as_py(), text_hash.as_py(), seed, place, first, around

    def run(batches):
        found = []
        for row in rows(batches):
            found.append(row)
            if len(found) >= common.OUT_ROWS:
                yield _batch(found)
                found = []
        if found:
            yield _batch(found)

    own = common.small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"),
        common.text_hash(text_col).alias("text_hash"),
        F.col(text_col).cast("string").alias("text"),
    )
    return own.mapInArrow(run, _HITS_SQL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _HITS)], schema=_HITS)


def matched(
    doc: np.ndarray, first: int, at: int, item: np.ndarray, item_at: int, item_first: int = 0, item_size: int | None = None
) -> tuple[int, int, int] | None:
    """(start in the document, words, equal words) of what overlaps around a hit, or None.

    ``doc`` holds the document's words from ``first`` on, ``item`` those of an item of ``item_size`` words from
    ``item_first`` on; the words ``at`` and ``item_at`` begin the hit. Windows that begin up to a window before
    the hit are compared.
    """
    size = min(WINDOW, len(item) if item_size is None else item_size)
    least = MATCHES if size == WINDOW else size
    # Both sequences from the earliest place that they share.
    back = min(at - first, item_at - item_first)
    a, b = doc[at - first - back :], item[item_at - item_first - back :]
    length = min(len(a), len(b))
    equal = (a[:length] == b[:length]).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(equal)])
    inside = total[size:] - total[:-size] if length >= size else total[:0]
    starts = np.flatnonzero(inside >= least)
    starts = starts[(starts <= back) & (starts + size > back)]
    if not len(starts):
        return None
    low, high = int(starts[0]), int(starts[-1]) + size
    return at - back + low, high - low, int(total[high] - total[low])


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_hash, item_id, start, stop, hits) of every document and item that overlap.

    They overlap if 12 of 15 words at the same distance are equal, anywhere in either; an item of 8 to
    14 words must be found whole. Words are runs of letters, digits and underscores, lower-cased.
    ``start`` and ``stop`` bound the overlapping words in the document (of all places of the item in
    it), ``hits`` counts the seeds that led there. Items with equal words are one, under their
    smallest id; items of less than 8 words are left out. A null text has no words; null ids stay
    null; rows with equal id and text are one document. Other columns are left out.
    """
    items = common.written(benchmark_seeds(benchmark, item_id_col, item_text_col), "benchmark_seeds")
    short = items.where(F.col("item_size") < WINDOW).limit(1).count() > 0
    hits = document_hits(docs, bits.table(items.select("seed")), short, id_col, text_col)
    pairs = hits.withColumnsRenamed({"seed": "own"}).join(
        items.withColumnsRenamed({"position": "item_position"}).hint("merge"), F.col("own") == F.col("seed")
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64())]
        + [(name, pa.int64()) for name in ("start", "stop")]
    )

    def verify(batches):
        for batch in batches:
            found = []
            for doc_id, text_hash, at, first, around, item_id, size, item_first, item, item_at in zip(
                *(column.to_pylist() for column in batch.columns)
            ):
                near = np.frombuffer(around, np.uint64), first, at, np.frombuffer(item, np.uint64), item_at
                found_at = matched(*near, item_first, size)
                if found_at:
                    found.append((doc_id, text_hash, item_id, found_at[0], found_at[0] + found_at[1]))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema
                )

    checked = pairs.select(
        "doc_id", "text_hash", "position", "first", "around", "item_id", "item_size", "item_first", "item_around", "item_position"
    ).mapInArrow(verify, "doc_id long, text_hash long, item_id long, start long, stop long")
    return checked.groupBy("doc_id", "text_hash", "item_id").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("hits")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that overlap with no item, with all their columns as they were."""
    found = overlaps(docs, benchmark, id_col, text_col).select("doc_id", "text_hash").distinct()
    found = common.written(found.toDF(common.KEY_ID, common.KEY_HASH), "contaminated")
    clean, others = common.split(docs, found, id_col, text_col)
    kept = clean.unionByName(others.join(found.hint("merge"), common.same_document(), "left_anti"))
    return kept.select(*[f"`{c}`" for c in docs.columns])
