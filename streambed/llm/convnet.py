"""A small convolutional classifier in numpy: hashed embeddings, filter widths, max pooling.

An input is an integer array (positions, k): the embedding rows whose sum is the vector at each
position. Filters of several widths run over the positions, each keeps its largest response, and a
linear layer turns these into log odds. Trained by Adagrad on the cross entropy: in one process, or in
passes over a table of any size, whose shards each learn from the same network and are then averaged.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = 32
RATE = 0.08
# Positions that run through the filters at once.
CHUNK = 1 << 15
# Rows of a shard, which learns on its own in one pass; passes over small and over very large tables.
SHARD_ROWS = 4000
MOST_PASSES = 8
LEAST_PASSES = 2
# Parameter rows handed back at once.
OUT_ROWS = 8192
# Where every history of squared gradients begins.
START = 1e-4
NEWTON_STEPS = 50


@dataclass
class Net:
    widths: tuple[int, ...]
    embeddings: np.ndarray  # (rows, size)
    filters: list[np.ndarray]  # by width: (width, size, filters)
    offsets: list[np.ndarray]
    weights: np.ndarray
    bias: float

    @staticmethod
    def fresh(rows: int, size: int, widths: tuple[int, ...], filters: int, seed: int) -> Net:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        return Net(
            widths,
            draw(0.1, rows, size),
            [draw(1 / np.sqrt(w * size), w, size, filters) for w in widths],
            [np.zeros(filters, np.float32) for _ in widths],
            draw(0.3, len(widths) * filters),
            0.0,
        )

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """The largest response of each filter (0 at least), its position by width, the vectors."""
        vectors = self.embeddings[rows].sum(1)
        if len(vectors) < max(self.widths):
            short = max(self.widths) - len(vectors)
            vectors = np.vstack([vectors, np.zeros((short, self.embeddings.shape[1]), np.float32)])
        best, where = [], []
        for width, kernel, offset in zip(self.widths, self.filters, self.offsets):
            count = len(vectors) - width + 1
            total = offset + vectors[:count] @ kernel[0]
            for k in range(1, width):
                total += vectors[k : k + count] @ kernel[k]
            where.append(total.argmax(0))
            best.append(total[where[-1], np.arange(len(offset))])
        return np.maximum(np.concatenate(best), 0), where, vectors

    def longest(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], Callable]:
        """As ``pooled``, of an input of any length, with the vectors at given positions."""
        if len(rows) <= CHUNK:
            best, where, vectors = self.pooled(rows)
            return best, where, vectors.__getitem__
        count = len(self.offsets[0])
        top, places = None, None
        for at in range(0, len(rows), CHUNK):
            best, where, _ = self.pooled(rows[at : at + CHUNK + max(self.widths) - 1])
            where = np.concatenate(where) + at
            if top is None:
                top, places = best, where
            else:
                places = np.where(best > top, where, places)
                top = np.maximum(best, top)

        def vectors(positions: np.ndarray) -> np.ndarray:
            inside = positions < len(rows)
            found = self.embeddings[rows[np.where(inside, positions, 0)]].sum(1)
            return np.where(inside[:, None], found, 0).astype(np.float32)

        return top, list(places.reshape(len(self.widths), count)), vectors

    def log_odds(self, rows: np.ndarray) -> float:
        """Of an input of any length, run through the filters in overlapping parts."""
        best = np.zeros_like(self.weights)
        for at in range(0, max(1, len(rows)), CHUNK):
            best = np.maximum(best, self.pooled(rows[at : at + CHUNK + max(self.widths) - 1])[0])
        return float(best @ self.weights + self.bias)

    def train(self, inputs: list[np.ndarray], labels: np.ndarray, epochs: int, seed: int) -> None:
        seen, rng, order = {}, np.random.default_rng(seed), np.arange(len(inputs))
        for _ in range(epochs):
            rng.shuffle(order)
            for at in range(0, len(order), BATCH):
                self._step([(inputs[k], labels[k]) for k in order[at : at + BATCH]], seen)

    def _step(self, batch: list[tuple[np.ndarray, int]], seen: dict) -> None:
        """One step on a batch; only the pooled positions get gradients."""
        count = len(self.offsets[0])
        grads = {"w": np.zeros_like(self.weights), "b": 0.0}
        for k in range(len(self.widths)):
            grads["f", k], grads["o", k] = np.zeros_like(self.filters[k]), np.zeros_like(self.offsets[k])
        touched, pushed = [], []
        for rows, label in batch:
            best, where, vectors = self.longest(rows)
            error = 1 / (1 + np.exp(-np.clip(float(best @ self.weights + self.bias), -30, 30))) - label
            grads["w"] += error * best
            grads["b"] += error
            back = np.where(best > 0, error * self.weights, 0).reshape(len(self.widths), count)
            for k, width in enumerate(self.widths):
                grads["o", k] += back[k]
                for j in range(width):
                    at = where[k] + j
                    grads["f", k][j] += (vectors(at) * back[k][:, None]).T
                    real = at < len(rows)
                    touched.append(rows[at[real]])
                    pushed.append((back[k][:, None] * self.filters[k][j].T)[real])

        def move(name, value, grad):
            grad = grad / len(batch)
            total = seen[name] = seen.get(name, START) + grad * grad
            return (value - RATE * grad / np.sqrt(total)).astype(np.float32)

        ids, vectors = np.concatenate(touched), np.concatenate(pushed) / len(batch)
        flat, inverse = np.unique(ids, return_inverse=True)
        places = inverse.reshape(ids.shape)
        total = np.zeros((len(flat), vectors.shape[1]), np.float32)
        for c in range(vectors.shape[1]):
            weights = np.repeat(vectors[:, c], ids.shape[1])
            total[:, c] = np.bincount(places.ravel(), weights, len(flat))
        history = seen.setdefault("e", np.full_like(self.embeddings, START))
        history[flat] += total * total
        self.embeddings[flat] -= RATE * total / np.sqrt(history[flat])
        self.weights = move("w", self.weights, grads["w"])
        self.bias = float(move("b", np.float64(self.bias), np.float64(grads["b"])))
        for k in range(len(self.widths)):
            self.filters[k] = move(("f", k), self.filters[k], grads["f", k])
            self.offsets[k] = move(("o", k), self.offsets[k], grads["o", k])


    def copied(self) -> Net:
        same = lambda arrays: [a.copy() for a in arrays]
        return Net(self.widths, self.embeddings.copy(), same(self.filters), same(self.offsets), self.weights.copy(), self.bias)

    def dense(self, seen: dict) -> np.ndarray:
        """All parameters but the embeddings in one vector, then their histories."""
        names = [*(("f", k) for k in range(len(self.widths))), *(("o", k) for k in range(len(self.widths))), "w", "b"]
        values = [*self.filters, *self.offsets, self.weights, np.float64(self.bias)]
        history = [np.broadcast_to(seen.get(name, START), np.shape(value)) for name, value in zip(names, values)]
        return np.concatenate([np.ravel(a) for a in values + history]).astype(np.float32)

    def take_dense(self, flat: np.ndarray, seen: dict) -> None:
        """The reverse of ``dense``."""
        names = [*(("f", k) for k in range(len(self.widths))), *(("o", k) for k in range(len(self.widths))), "w", "b"]
        shapes = [*(f.shape for f in self.filters), *(o.shape for o in self.offsets), self.weights.shape, ()]
        parts, at = [], 0
        for shape in shapes * 2:
            size = int(np.prod(shape))
            parts.append(flat[at : at + size].reshape(shape))
            at += size
        wide = len(self.widths)
        self.filters, self.offsets = parts[:wide], parts[wide : 2 * wide]
        self.weights, self.bias = parts[2 * wide], float(parts[2 * wide + 1])
        seen.update(zip(names, parts[len(shapes) :]))


def passes_over(rows: int) -> int:
    """Small tables are gone through more often, every table whole each time."""
    return max(LEAST_PASSES, min(MOST_PASSES, -(-MOST_PASSES * SHARD_ROWS // max(rows, 1))))


def sharded(rows: DataFrame, count: int, *order: Column) -> DataFrame:
    """The rows with their ``shard``, by the hash of ``order``, and within it in an order that follows it."""
    shards = max(1, -(-count // SHARD_ROWS))
    placed = rows.withColumns({"place": F.xxhash64(*order), "shard": F.pmod(F.xxhash64(*order, F.lit(2)), F.lit(shards))})
    return placed.repartition(shards, "shard").sortWithinPartitions("shard", "place", *order)


def train_spread(rows: DataFrame, read: Callable[[Iterable], Iterator], net: Net, passes: int) -> Net:
    """``net`` trained on all rows of a ``sharded`` table, which is best stored.

    ``read`` turns Arrow batches into (shard, input, label). In each pass every shard learns from the same
    network in a task; a parameter becomes the mean over the shards that moved it.
    """
    spark, size = rows.sparkSession, net.embeddings.shape[1]
    seen = {"e": np.full_like(net.embeddings, START)}
    columns = [F.avg(F.get("v", F.lit(k))).alias(f"v{k}") for k in range(2 * size)]
    for _ in range(passes):
        sent = spark.sparkContext.broadcast((net, seen))

        def run(batches, sent=sent):
            for _, examples in itertools.groupby(read(batches), lambda row: row[0]):
                own, history = sent.value[0].copied(), {**sent.value[1], "e": sent.value[1]["e"].copy()}
                pairs = ((x, label) for _, x, label in examples)
                while batch := list(itertools.islice(pairs, BATCH)):
                    own._step(batch, history)
                moved = np.flatnonzero((history["e"] != sent.value[1]["e"]).any(1))
                dense = own.dense(history)
                dense = np.pad(dense, (0, -len(dense) % (2 * size))).reshape(-1, 2 * size)
                values = np.concatenate([np.hstack([own.embeddings[moved], history["e"][moved]]), dense])
                places = np.concatenate([moved, -1 - np.arange(len(dense))])
                for at in range(0, len(places), OUT_ROWS):
                    some = values[at : at + OUT_ROWS].astype(np.float32)
                    ends = np.arange(0, some.size + 1, 2 * size, dtype=np.int32)
                    listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(some.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(places[at : at + OUT_ROWS]), listed], ["place", "v"])

        moved = rows.mapInArrow(run, "place long, v array<float>").groupBy("place").agg(*columns).toArrow()
        sent.destroy()
        if not moved.num_rows:
            break
        places = moved["place"].to_numpy()
        values = np.stack([moved[f"v{k}"].to_numpy() for k in range(2 * size)], 1).astype(np.float32)
        net, seen = net.copied(), {**seen, "e": seen["e"].copy()}
        own = places >= 0
        net.embeddings[places[own]], seen["e"][places[own]] = values[own, :size], values[own, size:]
        dense = values[~own][np.argsort(-places[~own])]
        net.take_dense(dense.ravel(), seen)
    return net


def calibrate_rows(rows: DataFrame, weights: tuple[float, float]) -> tuple[float, float]:
    """``calibrate`` of a table of ``odds`` and ``label``, with the weights of label 0 and 1."""
    ones, zeros = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    theta = np.array([1.0, 0.0])
    odds, one = F.col("odds"), F.col("label") == 1
    weight = F.when(one, F.lit(float(weights[1]))).otherwise(F.lit(float(weights[0])))
    wanted = F.when(one, F.lit(1 - 1 / (2 + ones))).otherwise(F.lit(1 / (2 + zeros)))
    for _ in range(NEWTON_STEPS):
        p = chance(odds, *theta)
        off, bent = weight * (p - wanted), weight * p * (1 - p)
        sums = rows.agg(*[F.sum(c) for c in (off * odds, off, bent * odds * odds, bent * odds, bent)]).first()
        slope = np.array(sums[:2]) + 1e-3 * (theta - [1.0, 0.0])
        bend = np.array([[sums[2], sums[3]], [sums[3], sums[4]]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta - step * min(1.0, 2.0 / (1e-9 + np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def chance(odds: Column, scale: float, shift: float) -> Column:
    """``probability`` as a column."""
    value = F.least(F.greatest(odds * float(scale) + F.lit(float(shift)), F.lit(-60.0)), F.lit(60.0))
    return 1 / (1 + F.exp(-value))


def held_out(labels: np.ndarray, every: int) -> np.ndarray:
    """True for one row in ``every`` of each label."""
    held = np.zeros(len(labels), bool)
    for label in (0, 1):
        held[np.flatnonzero(labels == label)[every - 1 :: every]] = True
    return held


def probability(odds: np.ndarray, scale: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(scale * np.asarray(odds, np.float64) + shift, -60, 60)))


def calibrate(odds: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of log odds that fit the labels: weighted logistic regression, damped Newton steps."""
    wanted = np.where(labels == 1, 1 - 1 / (2 + labels.sum()), 1 / (2 + (1 - labels).sum()))
    x, theta = np.stack([odds, np.ones_like(odds)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = probability(x @ theta, 1.0, 0.0)
        slope = x.T @ (weight * (p - wanted)) + 1e-3 * (theta - [1.0, 0.0])
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta - step * min(1.0, 2.0 / (1e-9 + np.abs(step).max()))
    return max(float(theta[0]), 1e-3), float(theta[1])
