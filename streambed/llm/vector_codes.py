"""Vector codes: integer product quantisation with adaptive distance bounds (Drake and Hamerly).

Vectors become integers and are cut into equal parts; each part position has a codebook, which k-means
over all vectors improves. Between rounds a written table keeps, for every part, its entry with an upper
bound of the distance, its b next closest entries with lower bounds in order, and one outer bound for
all other entries. When entries move, the bounds move with them. A part whose upper bound stays below a
lower bound needs only the entries before that one looked at, most need none; whatever the bounds leave
open is decided in integers. b shrinks to what the parts really needed.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streambed.llm import common
from streambed.session import run_folder

# Vectors of an Arrow batch.
BATCH_ROWS = 4096
# Bounds are single precision and rounded away from the distance; closer ones than this are left open.
ROUNDING, MARGIN = 1e-6, 1e-3
# b shrinks as long as at most this share of the parts would have needed more.
SPARE = 0.02

STATE = "vec_id long, label string, width int, ints array<int>, nearest array<tinyint>, bounds array<float>, needed array<tinyint>"
CODED = "vec_id long, label string, code string, error long, codebooks_sha256 string"
SUMS = "width int, part int, entry int, place int, total long"


class Codebooks(NamedTuple):
    """The entries by vector length, each (parts, entries, components), and how far the last round moved them."""

    entries: dict[int, np.ndarray]
    moves: dict[int, np.ndarray]

    def sha256(self, width: int) -> str:
        return hashlib.sha256(",".join(map(str, self.entries[width].ravel().tolist())).encode()).hexdigest()


class Bounds(NamedTuple):
    """Per part: entries from the nearest on, an upper bound, ordered lower bounds (the last is the outer one)."""

    nearest: np.ndarray  # (parts, 1 + b)
    upper: np.ndarray  # (parts,)
    lower: np.ndarray  # (parts, b + 1)
    needed: np.ndarray  # (parts,): how many lower bounds failed


def _up(values: np.ndarray) -> np.ndarray:
    return (values * (1 + ROUNDING)).astype(np.float32)


def _down(values: np.ndarray) -> np.ndarray:
    return (np.maximum(values, 0) * (1 - ROUNDING)).astype(np.float32)


def integers(values: np.ndarray, parts: int, scale: int) -> np.ndarray:
    """(rows, components) as floor(scale * x), with zeros up to a multiple of ``parts`` components."""
    found = np.floor(values.astype(np.float64) * scale)
    # Sums of squared distances over whole vectors must fit 64 bits, components 32 bits.
    largest = min((2.0**62 / max(values.shape[1], 1)) ** 0.5 / 2, 2.0**31 - 1)
    if found.size and np.abs(found).max() > largest:
        raise ValueError(f"components beyond {largest / scale:.0f} have no distances in 64 bits")
    return np.pad(found.astype(np.int64), ((0, 0), (0, -values.shape[1] % parts)))


def distances(parts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Squared distances of (n, w) parts to their (n, c, w) entries."""
    return np.square(parts[:, None, :] - chosen).sum(-1)


def assign_fully(x: np.ndarray, part: np.ndarray, books: np.ndarray, b: int) -> Bounds:
    """Bounds from the distances to all entries."""
    d = np.empty((len(x), books.shape[1]), np.int64)
    for k in range(books.shape[1]):
        d[:, k] = np.square(x - books[part, k]).sum(-1)
    order = np.argsort(d, axis=1, kind="stable")  # ties: the lower index first
    root = np.sqrt(np.take_along_axis(d, order, 1))
    outer = root[:, b + 1 : b + 2] if books.shape[1] > b + 1 else np.full((len(x), 1), np.inf)
    lower = np.concatenate([_down(root[:, 1 : b + 1]), _down(outer)], axis=1)
    return Bounds(order[:, : b + 1], _up(root[:, 0]), lower, np.full(len(x), b + 1))


def assign_by_bounds(x: np.ndarray, part: np.ndarray, books: np.ndarray, moves: np.ndarray, old: Bounds, b: int) -> Bounds:
    """The nearest entries after the entries moved, looking only at what the bounds leave open.

    ``old`` may hold more than b lower bounds; those beyond are merged into the outer one.
    """
    upper = _up(old.upper + moves[part, old.nearest[:, 0]].astype(np.float64))
    moved = np.concatenate([moves[part[:, None], old.nearest[:, 1:]], moves.max(1)[part][:, None]], axis=1)
    lower = _ordered(_down(old.lower.astype(np.float64) - moved))[:, : b + 1]
    nearest = old.nearest[:, : b + 1].copy()

    needed = _needed(upper, lower)
    open_ = np.flatnonzero(needed)
    exact = distances(x[open_], books[part[open_], nearest[open_, 0]][:, None, :])[:, 0]
    upper[open_] = _up(np.sqrt(exact))
    needed[open_] = _needed(upper[open_], lower[open_])
    for z in range(1, b + 1):
        at = np.flatnonzero(needed == z)
        if not len(at):
            continue
        entries = nearest[at, : z + 1]
        d = distances(x[at], books[part[at][:, None], entries])
        order = np.lexsort((entries, d))
        nearest[at, : z + 1] = np.take_along_axis(entries, order, 1)
        root = np.sqrt(np.take_along_axis(d, order, 1))
        upper[at], lower[at, :z] = _up(root[:, 0]), _down(root[:, 1:])
    at = np.flatnonzero(needed == b + 1)
    if len(at):
        nearest[at], upper[at], lower[at], _ = assign_fully(x[at], part[at], books, b)
    return Bounds(nearest, upper, _ordered(lower), needed)


def _ordered(lower: np.ndarray) -> np.ndarray:
    """Each bound holds for its entry and all after it."""
    return np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]


def _needed(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return (lower <= upper[:, None] + np.float32(MARGIN)).sum(1)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def _by_width(batch: pa.RecordBatch):
    """The rows of each vector length by themselves."""
    widths = batch.column("width").to_numpy()
    for width in np.unique(widths).tolist():
        yield width, batch.filter(pa.array(widths == width))


def _state(batch: pa.RecordBatch, width: int, ints: np.ndarray, found: Bounds) -> pa.RecordBatch:
    rows = batch.num_rows
    columns = {
        "vec_id": batch.column("vec_id"),
        "label": batch.column("label"),
        "width": pa.array(np.full(rows, width, np.int32)),
        "ints": _lists(ints.reshape(rows, -1), pa.int32()),
        "nearest": _lists(found.nearest.reshape(rows, -1), pa.int8()),
        "bounds": _lists(np.concatenate([found.upper[:, None], found.lower], axis=1).reshape(rows, -1), pa.float32()),
        "needed": _lists(found.needed.reshape(rows, -1), pa.int8()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


class _Step:
    """What the tasks of one round need; small: codebooks only."""

    def __init__(self, books: Codebooks, parts: int, scale: int, b: int):
        self.books, self.parts, self.scale, self.b = books, parts, scale, b

    def _parts(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows * parts, components), and each one's position."""
        return rows.reshape(len(rows) * self.parts, -1), np.tile(np.arange(self.parts), len(rows))

    def depth(self, width: int) -> int:
        return min(self.b, self.books.entries[width].shape[1] - 1)

    def first(self, batches):
        for batch in batches:
            for width, rows in _by_width(batch):
                values = _flat(rows.column("vector")).reshape(rows.num_rows, width)
                ints = integers(values, self.parts, self.scale)
                found = assign_fully(*self._parts(ints), self.books.entries[width], self.depth(width))
                yield _state(rows, width, ints, found)

    def _next(self, rows: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Bounds]:
        ints = _flat(rows.column("ints")).astype(np.int64).reshape(rows.num_rows, -1)
        x, part = self._parts(ints)
        bounds = _flat(rows.column("bounds")).reshape(len(x), -1)
        nearest = _flat(rows.column("nearest")).astype(np.int64).reshape(len(x), -1)
        old = Bounds(nearest, bounds[:, 0], bounds[:, 1:], None)
        depth = min(self.depth(width), nearest.shape[1] - 1)
        found = assign_by_bounds(x, part, self.books.entries[width], self.books.moves[width], old, depth)
        return ints, x, part, found

    def again(self, batches):
        for batch in batches:
            for width, rows in _by_width(batch):
                ints, _, _, found = self._next(rows, width)
                yield _state(rows, width, ints, found)

    def sums(self, batches):
        """Per codebook entry the components' sums and the count (place -1); how deep parts had to look (entry -1)."""
        totals, depths = {}, {}
        for batch in batches:
            for width, rows in _by_width(batch):
                x, part = self._parts(_flat(rows.column("ints")).astype(np.int64).reshape(rows.num_rows, -1))
                entry = _flat(rows.column("nearest")).reshape(len(x), -1)[:, 0]
                found = totals.setdefault(width, np.zeros((*self.books.entries[width].shape[:2], 1 + x.shape[1]), np.int64))
                np.add.at(found, (part, entry), np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1))
                count = np.bincount(_flat(rows.column("needed")), minlength=128)
                depths[width] = depths.get(width, 0) + count
        rows = [
            (width, p, k, place - 1, int(total))
            for width, found in totals.items()
            for (p, k, place), total in np.ndenumerate(found)
        ] + [(width, -1, -1, int(z), int(count[z])) for width, count in depths.items() for z in np.flatnonzero(count)]
        if rows:
            kinds = [pa.int32()] * 4 + [pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["width", "part", "entry", "place", "total"])

    def codes(self, batches):
        for batch in batches:
            for width, rows in _by_width(batch):
                _, x, part, found = self._next(rows, width)
                entry = found.nearest[:, 0]
                error = np.square(x - self.books.entries[width][part, entry]).sum(-1)
                digits = entry.astype(np.uint8).tobytes().hex()
                size = 2 * self.parts
                columns = [
                    rows.column("vec_id"),
                    rows.column("label"),
                    pa.array([digits[size * k : size * (k + 1)] for k in range(rows.num_rows)]),
                    pa.array(error.reshape(rows.num_rows, -1).sum(1)),
                    pa.array([self.books.sha256(width)] * rows.num_rows),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error", "codebooks_sha256"])


class _Tables:
    """Tables between rounds in the shared folder; a round's table goes when the next one is complete."""

    def __init__(self, spark):
        self.spark, self.last = spark, None

    def written(self, df: DataFrame) -> DataFrame:
        folder = run_folder(self.spark, "vector_codes")
        df.write.option("compression", "zstd").parquet(f"{folder}/rows")
        if self.last:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.last)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.last = folder
        common.remove_at_end(self.spark, folder)
        return self.spark.read.schema(df.schema).parquet(f"{folder}/rows")


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label (as text), width and vector of the rows whose vectors are whole and finite."""
    found = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.size(vector_col).alias("width"),
        F.col(vector_col).alias("vector"),
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return found.where(F.col("vector").isNotNull() & F.forall("vector", finite))


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """Per usable vector vec_id, label (as text), code (two hex digits per part), error (squared distance to
    the coded vector, in units of 1 / scale squared) and codebooks_sha256; and the final codebooks.

    Each codebook starts as its part of the vectors of the smallest ids, ``entries`` of them; each of
    ``rounds`` rounds assigns all parts (ties to the lower index) and replaces every entry by the floor of its
    parts' mean; unused entries stay. At the end all parts are assigned once more.

    Vectors that are null or hold null or non-finite components are left out. Vectors of each length have
    codebooks of their own; a length that is no multiple of ``parts`` is filled up with zeros. Rows with
    equal ids count each for itself; equal ids start in the order of their vectors, null ids last. Fewer vectors than ``entries``
    give as many entries. Components so large that squared distances exceed 64 bits are an error (with 64 components
    some 30,000 at scale 4096). Other columns are left out. No rows give no rows.
    """
    if not 1 <= entries <= 127:
        raise ValueError("1 to 127 entries")
    spark = vectors.sparkSession
    kept = common.small_batches(usable(vectors, id_col, vector_col, label_col), BATCH_ROWS)
    books = Codebooks(_first_entries(kept, parts, entries, scale), {})
    tables = _Tables(spark)
    b = max(entries // 4, 1)
    state = tables.written(kept.mapInArrow(_Step(books, parts, scale, b).first, STATE))
    for left in reversed(range(rounds)):
        step = _Step(books, parts, scale, b)
        sums = state.mapInArrow(step.sums, SUMS).groupBy("width", "part", "entry", "place").agg(F.sum("total").alias("total"))
        books, needed = _moved(books, sums.toArrow().to_pylist())
        b = _fewer(b, needed, max(entries // 8, 1))
        step = _Step(books, parts, scale, b)
        if left:
            state = tables.written(state.mapInArrow(step.again, STATE))
    if not rounds:
        books = Codebooks(books.entries, {w: np.zeros(e.shape[:2]) for w, e in books.entries.items()})
        step = _Step(books, parts, scale, b)
    return tables.written(state.mapInArrow(step.codes, CODED)), books


def _first_entries(kept: DataFrame, parts: int, entries: int, scale: int) -> dict[int, np.ndarray]:
    """The codebooks that the smallest ids of each length give; so many rows per length reach the driver."""
    order = Window.partitionBy("width").orderBy(F.asc_nulls_last("vec_id"), "vector")
    first = kept.withColumn("place", F.row_number().over(order)).where(F.col("place") <= entries)
    found = {}
    for row in sorted(first.select("width", "place", "vector").collect()):
        found.setdefault(row.width, []).append(row.vector)
    return {
        width: integers(np.array(rows, np.float64).reshape(len(rows), width), parts, scale)
        .reshape(len(rows), parts, -1)
        .swapaxes(0, 1)
        .copy()
        for width, rows in found.items()
    }


def _moved(books: Codebooks, sums: list[dict]) -> tuple[Codebooks, np.ndarray]:
    """The codebooks of the parts' means, and how many parts needed how many lower bounds."""
    totals = {width: np.zeros((*old.shape[:2], 1 + old.shape[2]), np.int64) for width, old in books.entries.items()}
    needed = np.zeros(128, np.int64)
    for row in sums:
        if row["entry"] < 0:
            needed[row["place"]] += row["total"]
        else:
            totals[row["width"]][row["part"], row["entry"], row["place"] + 1] = row["total"]
    new = {
        width: np.where(totals[width][..., :1] > 0, totals[width][..., 1:] // np.maximum(totals[width][..., :1], 1), old)
        for width, old in books.entries.items()
    }
    moves = {width: np.sqrt(np.square(new[width] - old).sum(-1)) * (1 + ROUNDING) for width, old in books.entries.items()}
    return Codebooks(new, moves), needed


def _fewer(b: int, needed: np.ndarray, least: int) -> int:
    """The smallest b that would have served all parts but a small share of those that b served."""
    for z in range(least, b):
        if needed[z + 1 : b + 1].sum() <= SPARE * needed.sum() and needed[b + 1 :].sum() < needed.sum():
            return z
    return b


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the error summed over all rows of the same label, null labels together."""
    sums = coded.groupBy(F.col("label").alias("sum_label")).agg(F.sum("error").alias("label_error"))
    sums = common.written(sums, "label_errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("sum_label")), "left").drop("sum_label")
