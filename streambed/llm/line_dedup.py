"""Repeated runs of lines, found by winnowing over line hashes.

A run is a stretch of consecutive lines with at least ``min_words`` words. A window is a run that no
shorter run from its first line on would be; the line with the smallest hash in a window is selected.
Equal runs hold equal windows and so equal selected lines: a run that occurs twice is met in both
places. Selected lines whose hash occurs once are dropped. From the others matches are extended both
ways, to each shortest run that holds the line, and the runs' digests say where such a run occurs
first. Longer equal runs are unions of these. Every later occurrence is deleted.

Positions of a frequent line are only ever aggregated and joined with one row per line or run, never
with each other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streambed.llm import common

MIN_WORDS = 50
DIGEST = 16

_SELECTED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("line", pa.int64()),
        ("print", pa.int64()),
        ("first", pa.int64()),
        ("digests", pa.binary()),
        ("words", pa.binary()),
    ]
)
_SELECTED_SQL = (
    "doc_id long, text_hash long, line long, print long, first long, digests binary, words binary"
)
_RUNS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("run", pa.binary()),
        ("start", pa.int64()),
        ("stop", pa.int64()),
    ]
)
_RUNS_SQL = "doc_id long, text_hash long, run binary, start long, stop long"


def lines(text: str) -> list[str]:
    """The lines that count: without surrounding blanks, blank ones left out."""
    return [line for line in map(str.strip, text.split("\n")) if line]


def windows(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first, last) of the window from each line on that reaches ``min_words`` words."""
    out, last, total = [], -1, 0
    for first in range(len(words)):
        while total < min_words and last + 1 < len(words):
            last += 1
            total += words[last]
        if total < min_words:
            break
        out.append((first, last))
        total -= words[first]
    return out


def selected(prints: list[int], words: list[int], min_words: int) -> list[int]:
    """The lines with a window's smallest hash, of equal ones the last."""
    picked: set[int] = set()
    best = seen = -1
    for first, last in windows(words, min_words):
        if best < first:
            best = seen = first
        for k in range(seen + 1, last + 1):
            if prints[k] <= prints[best]:
                best = k
        seen = last
        picked.add(best)
    return sorted(picked)


def _reach(words: list[int], at: int, min_words: int) -> tuple[int, int]:
    """First and last line that a shortest run with line ``at`` can have."""
    first, total = at, 0
    while first > 0 and total < min_words:
        first -= 1
        total += words[first]
    last, total = at, 0
    while last + 1 < len(words) and total < min_words:
        last += 1
        total += words[last]
    return first, last


def shortest_runs(words: list[int], at: int, min_words: int) -> set[tuple[int, int]]:
    """(first, last) of the runs with line ``at`` that end where ``min_words`` words are reached,
    counted from their first line on or back from their last."""
    forward = windows(words, min_words)
    size = len(words)
    backward = [(size - 1 - b, size - 1 - a) for a, b in windows(words[::-1], min_words)]
    return {(a, b) for a, b in forward + backward if a <= at <= b}


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


def _sent(rows, schema: pa.Schema):
    """Rows as batches of bounded size; a row's binaries count."""
    found, size = [], 0
    for row in rows:
        found.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(found) >= common.OUT_ROWS or size >= common.OUT_BYTES:
            yield _rows(found, schema)
            found, size = [], 0
    if found:
        yield _rows(found, schema)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        common.text_hash(text_col).alias("text_hash"),
        F.col(text_col).cast("string").alias("text"),
    )


def selected_lines(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """A row per selected line: its document, number and hash, and the lines around it that a run
    with it can have (the first one's number, their digests and word counts)."""

    def rows(batches):
        for batch in batches:
            for doc_id, text_hash, text in zip(*(batch.column(k) for k in range(3))):
                found = lines(text.as_py() or "")
                words = [len(line.split()) for line in found]
                if sum(words) < min_words:
                    continue
                digests = [xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass")) for line in found]
                prints = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
                doc_id, text_hash = doc_id.as_py(), text_hash.as_py()
                for at in selected(prints, words, min_words):
                    first, last = _reach(words, at, min_words)
                    around = b"".join(digests[first : last + 1])
                    counts = np.array(words[first : last + 1], "<u4").tobytes()
                    yield doc_id, text_hash, at, prints[at], first, around, counts

    keyed = common.small_batches(_keyed(docs, id_col, text_col))
    return keyed.mapInArrow(lambda batches: _sent(rows(batches), _SELECTED), _SELECTED_SQL)


def runs(selection: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs with each selected line: document, digest, first and last line."""

    def rows(batches):
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in _SELECTED.names)
            for doc_id, text_hash, at, _, first, digests, counts in zip(*columns):
                words = np.frombuffer(counts, "<u4").tolist()
                for a, b in shortest_runs(words, at - first, min_words):
                    run = xxhash.xxh3_128_digest(digests[DIGEST * a : DIGEST * (b + 1)])
                    yield doc_id, text_hash, run, first + a, first + b

    return selection.mapInArrow(lambda batches: _sent(rows(batches), _RUNS), _RUNS_SQL).distinct()


def _place() -> Column:
    """The order of places in the corpus: by id, ids that are null last, then by text and line."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "start")


def later_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, start, stop): the runs of at least ``min_words`` words that occur earlier.

    Lines are numbered from 0, blank ones left out. Earlier is a smaller doc_id (null ids come last),
    then a smaller text hash, then an earlier line; a run may overlap its earlier occurrence. Rows with
    equal id and text are one document.
    """
    every = common.written(selected_lines(docs, min_words, id_col, text_col), "selected_lines")
    repeated = every.groupBy("print").count().where("count > 1").select(F.col("print").alias("again"))
    repeated = common.written(repeated, "repeated_lines")
    met = every.join(repeated.hint("merge"), F.col("print") == F.col("again"), "left_semi")
    found = common.written(runs(met, min_words), "runs")
    place = found.groupBy("run").agg(F.count("*").alias("n"), F.min(_place()).alias("place")).where("n > 1")
    earliest = common.written(place.select(F.col("run").alias("same"), "place"), "earliest_runs")
    joined = found.join(earliest.hint("merge"), F.col("run") == F.col("same")).where(_place() > F.col("place"))
    return joined.select("doc_id", "text_hash", "start", "stop")


def _without(text: str | None, spans: list | None) -> tuple[str | None, int]:
    """The text without the lines that the spans name, and how many those are."""
    if spans is None:
        return None, 0
    gone, number, kept = set(), 0, []
    for span in spans:
        gone.update(range(span["start"], span["stop"] + 1))
    for line in (text or "").split("\n"):
        if not line.strip():
            kept.append(line)
            continue
        if number not in gone:
            kept.append(line)
        number += 1
    return ("\n".join(kept) if any(map(str.strip, kept)) else ""), len(gone)


def remove_repeated(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    removed_col: str | None = None,
) -> DataFrame:
    """``docs`` with later occurrences of repeated runs of lines deleted from their texts.

    Every row stays with all its columns; an ``n_chars`` column is set to the new text's code points
    where the text changed. A text whose lines are all deleted becomes empty. Lines are compared
    without surrounding blanks; blank lines are not compared and stay. The first occurrence in the
    order of ``later_runs`` stays, so rows with equal id and text keep or lose the same lines. A null
    text stays null. ``removed_col`` names a column to add with the number of deleted lines.
    """
    spans = later_runs(docs, min_words, id_col, text_col).groupBy("doc_id", "text_hash")
    spans = spans.agg(F.collect_list(F.struct("start", "stop")).alias("__spans"))
    spans = common.written(spans.toDF(common.KEY_ID, common.KEY_HASH, "__spans"), "later_runs")
    whole, others = common.split(docs, spans, id_col, text_col)
    joined = others.join(spans.hint("merge"), common.same_document(), "left")

    @F.pandas_udf("text string, removed int")
    def shortened(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_without(t, s) for t, s in zip(texts, spans)], columns=["text", "removed"])

    new = F.lit(None).cast("struct<text: string, removed: int>")
    changed = joined.withColumn("__new", F.when(F.col("__spans").isNotNull(), shortened(F.col(text_col).cast("string"), "__spans")))
    both = whole.withColumn("__new", new).unionByName(changed.drop("__spans", common.KEY_ID, common.KEY_HASH))
    columns = []
    for name in docs.columns:
        column = F.col(f"`{name}`")
        if name == text_col:
            column = F.coalesce("__new.text", column)
        elif name == "n_chars":
            fresh = F.length("__new.text").cast(docs.schema[name].dataType)
            column = F.coalesce(fresh, column)
        columns.append(column.alias(name))
    if removed_col:
        columns.append(F.coalesce("__new.removed", F.lit(0)).alias(removed_col))
    return both.select(*columns)
