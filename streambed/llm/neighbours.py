"""Approximate nearest neighbours by learned partitions.

The index is learned on a bounded sample: its neighbour graph is cut into parts of about equal size
with few edges between them, and a small network learns which parts a vector's neighbours lie in. It
sends every vector to its most probable part and every query to as many parts as the sample needs for
the wanted recall. Queries are compared with the vectors of their parts exactly, in blocks of bounded
size, and the nearest are kept. A query whose parts hold too few vectors is compared with all.

The number of parts grows with the root of the table, so that routing and comparing grow alike. A sample
tells MOST_PARTS parts apart: more parts come in two levels, each first part being cut again, in a task
of its own, by a sample of its own vectors. Beyond MOST_PARTS squared parts (some 268 million vectors)
the parts grow instead.

Equal vectors are searched once: of their rows only the smallest ids can be in a result, as equal
nearness goes to the smaller id.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streambed.llm import common

# Bound of the sample that the index learns from.
SAMPLE = 4096
# Parts are the root of the number of vectors divided by this; the most parts that a sample can tell apart.
ROOT_SHARE = 4
MOST_PARTS = 64
# Neighbours in the sample's graph.
DEGREE = 10
# Recall that the number of searched parts is chosen for, on the sample.
WANTED = 0.95
# Vectors and queries in a block.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024
HIDDEN = 64
EPOCHS = 40


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def neighbour_graph(unit: np.ndarray, degree: int) -> np.ndarray:
    """The nearest others of each row by cosine."""
    degree = min(degree, len(unit) - 1)
    out = np.empty((len(unit), degree), np.int64)
    for at in range(0, len(unit), 1024):
        near = unit[at : at + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + 1024] = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
    return out


def balanced_parts(near: np.ndarray, parts: int, slack: float = 1.05, sweeps: int = 20, seed: int = 3) -> np.ndarray:
    """A part for each node of a neighbour graph: none above ``slack`` times the mean size, few edges cut.

    Parts grow along edges from unassigned nodes until they are full; then nodes move to the part of
    most of their neighbours as long as it has room.
    """
    count = len(near)
    rng, label = np.random.default_rng(seed), np.full(count, -1)
    links: list[set[int]] = [set() for _ in range(count)]
    for a, row in enumerate(near.tolist()):
        for b in row:
            links[a].add(b)
            links[b].add(a)
    sizes, order = np.zeros(parts, np.int64), iter(rng.permutation(count).tolist())
    for part in range(parts):
        want, frontier = (count * (part + 1)) // parts - (count * part) // parts, []
        while sizes[part] < want:
            node = frontier.pop(0) if frontier else next(order)
            if label[node] >= 0:
                continue
            label[node] = part
            sizes[part] += 1
            frontier += [b for b in links[node] if label[b] < 0]
    limit = max(math.ceil(count / parts), math.floor(slack * count / parts))
    for _ in range(sweeps):
        moved = 0
        for node in rng.permutation(count).tolist():
            votes = np.bincount(label[list(links[node])], minlength=parts)
            own = label[node]
            votes[(sizes >= limit) & (np.arange(parts) != own)] = -1
            best = int(votes.argmax())
            if votes[best] > votes[own]:
                label[node] = best
                sizes[own] -= 1
                sizes[best] += 1
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """A network with one hidden layer: the probability of each part, and how many parts to search.

    With ``inner`` routers, one per part, the parts are those of all inner routers, one after the other.
    """

    layers: list[np.ndarray]
    probes: int
    inner: list[Router] | None = None

    @property
    def parts(self) -> int:
        return sum(r.parts for r in self.inner) if self.inner else len(self.layers[3])

    def log_odds(self, unit: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        odds = np.maximum(unit @ w1 + b1, 0) @ w2 + b2
        if not self.inner:
            return odds
        outer = _log_share(odds)
        return np.concatenate([outer[:, k : k + 1] + _log_share(r.log_odds(unit)) for k, r in enumerate(self.inner)], axis=1)

    def ranked(self, unit: np.ndarray, count: int) -> np.ndarray:
        """The most probable parts of each row, the best first."""
        return np.argsort(-self.log_odds(unit), axis=1, kind="stable")[:, :count]


def _log_share(odds: np.ndarray) -> np.ndarray:
    """Log probabilities of a row's odds."""
    odds = odds - odds.max(1, keepdims=True)
    return odds - np.log(np.exp(odds).sum(1, keepdims=True))


def _train(unit: np.ndarray, wanted: np.ndarray, seed: int = 5) -> list[np.ndarray]:
    """Adam on the cross entropy with each row's distribution over parts."""
    rng = np.random.default_rng(seed)
    size, parts = unit.shape[1], wanted.shape[1]
    layers = [
        rng.normal(0, 1 / np.sqrt(size), (size, HIDDEN)) * 2,
        np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, parts)),
        np.zeros(parts),
    ]
    mean, square = [np.zeros_like(x) for x in layers], [np.zeros_like(x) for x in layers]
    step, order = 0, np.arange(len(unit))
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            x, t = unit[rows], wanted[rows]
            h = np.maximum(x @ layers[0] + layers[1], 0)
            z = h @ layers[2] + layers[3]
            p = np.exp(z - z.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - t) / len(rows)
            back = (d @ layers[2].T) * (h > 0)
            step += 1
            for k, g in enumerate((x.T @ back, back.sum(0), h.T @ d, d.sum(0))):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                layers[k] -= 0.01 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return layers


def learn(sample: np.ndarray, parts: int, k: int = 5, wanted: float = WANTED) -> Router:
    """A router from sample vectors; the number of probes is the least that finds ``wanted`` of the
    sample's ``k`` nearest others in it, with each vector in the part the router sends it to.

    The last quarter of the sample is not learnt from, and the probes are chosen by it.
    """
    unit = _unit(sample)
    size = unit.shape[1]
    if parts < 2 or len(unit) < 8 * parts:
        return Router([np.zeros((size, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1)
    known = unit[: 3 * len(unit) // 4]
    near = neighbour_graph(known, DEGREE)
    label = balanced_parts(near, parts)
    votes = np.zeros((len(known), parts))
    np.add.at(votes, (np.arange(len(known))[:, None], label[near]), 1.0)
    votes[np.arange(len(known)), label] += 2.0
    router = Router(_train(known, votes / votes.sum(1, keepdims=True)), parts)
    router.probes = needed_probes(router, unit, k, wanted)
    return router


def needed_probes(router: Router, unit: np.ndarray, k: int, wanted: float) -> int:
    """The least number of parts in which ``wanted`` of the nearest others are, over the sample's last quarter."""
    home = router.ranked(unit, 1)[:, 0]
    asked = np.arange(3 * len(unit) // 4, len(unit))
    cosines = unit[asked] @ unit.T
    cosines[np.arange(len(asked)), asked] = -np.inf
    true = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    ranks = np.argsort(np.argsort(-router.log_odds(unit[asked]), axis=1, kind="stable"), axis=1)
    needed = np.sort(ranks[np.arange(len(asked))[:, None], home[true]].ravel())
    return int(needed[math.ceil(wanted * len(needed)) - 1]) + 1


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector): rows with an id and a vector that has a direction, each pair once.

    Vectors that are null, zero, or hold null or non-finite components are left out.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    ).where("id is not null and vector is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0)).distinct()


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(key, vector, ids): each vector once, with its ``keep`` smallest ids.

    Ranks are cut before the shuffle, so a vector that a third of the rows share travels in few rows.
    """
    order = Window.partitionBy("vector").orderBy("id")
    least = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)
    ids = least.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return ids.select(F.sha2(F.to_json("vector"), 256).alias("key"), "vector", "ids")


@dataclass
class Share:
    """How vectors of one length are searched: their router, their first part's number, parts searched."""

    router: Router
    first: int
    probes: int


def shares(
    every: DataFrame, wanted: DataFrame, k: int, parts: int | None, probes: int | None, sample: int
) -> dict[int, Share]:
    """By length of vectors: its share, if both tables hold such. One row per length reaches the driver, a
    sample of the lengths with more than one part, and their inner routers, some 70 kB each."""
    size = F.size("vector")
    asked = {r.size for r in wanted.select(size.alias("size")).distinct().collect()}
    counts = every.groupBy(size.alias("size")).count().collect()
    out, first = {}, 0
    for length, total in sorted((r.size, r["count"]) for r in counts if r.size in asked):
        number = parts or min(MOST_PARTS**2, math.ceil(math.sqrt(total) / ROOT_SHARE))
        router = _learned(every.where(size == length), length, number, k, sample)
        out[length] = Share(router, first, min(probes or router.probes, router.parts))
        first += router.parts
    return out


def _learned(own: DataFrame, length: int, number: int, k: int, sample: int) -> Router:
    """The router of the vectors of one length, in two levels if there are more parts than a sample tells apart."""
    chosen = []
    if number > 1:
        chosen = own.orderBy(F.xxhash64("key"), "key").limit(sample).select("vector").collect()
    vectors = np.array([row.vector for row in chosen], np.float64).reshape(-1, length)
    if number <= MOST_PARTS:
        return learn(vectors, number, k)
    outer = learn(vectors, math.ceil(math.sqrt(number)), k)
    inner_parts = math.ceil(number / outer.parts)

    def inner(rows: pd.DataFrame) -> pd.DataFrame:
        router = learn(np.stack(rows["vector"].to_numpy()).astype(np.float64), inner_parts, k)
        return pd.DataFrame({"part": [rows["part"].iat[0]], "router": [pickle.dumps(router)]})

    # At most ``sample`` vectors of each first part meet in a task; the cut is made before the shuffle.
    order = Window.partitionBy("part").orderBy(F.xxhash64("key"), "key")
    routed = _routed(own, {length: Share(outer, 0, 1)}, True).withColumn("n", F.row_number().over(order))
    learnt = routed.where(F.col("n") <= sample).select("part", "vector").groupBy("part")
    found = {r.part: pickle.loads(r.router) for r in learnt.applyInPandas(inner, "part int, router binary").collect()}
    outer.inner = [found.get(part) or learn(vectors[:0], 1) for part in range(len(outer.layers[3]))]
    outer.probes = needed_probes(outer, _unit(vectors), k, WANTED)
    return outer


def _routed(rows: DataFrame, found: dict[int, Share], home: bool) -> DataFrame:
    """``rows`` with a share, once for their most probable part or for each that is searched, as column
    ``part``. Vectors of unlike lengths are in unlike parts."""
    sent = rows.sparkSession.sparkContext.broadcast(found)

    @F.pandas_udf("array<int>")
    def parts(vectors: pd.Series) -> pd.Series:
        lengths, rows = vectors.map(len).to_numpy(), vectors.to_numpy()
        out = [None] * len(rows)
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            if length in sent.value:
                share = sent.value[length]
                unit = _unit(np.stack(rows[own]).astype(np.float64))
                best = share.first + share.router.ranked(unit, 1 if home else share.probes)
                for k, ranked in zip(own, best.astype(np.int32)):
                    out[k] = ranked
        return pd.Series(out, dtype=object)

    return rows.withColumn("part", F.explode(parts("vector")))


def _sizes(rows: DataFrame, block: int) -> dict[int, int]:
    """Blocks of each part: one row per part reaches the driver."""
    return {r.part: max(1, math.ceil(r["count"] / block)) for r in rows.groupBy("part").count().collect()}


def _by_part(counts: dict[int, int]) -> Column:
    """The number of blocks of a row's part."""
    pairs = [F.lit(x) for pair in sorted(counts.items()) for x in pair]
    return F.coalesce(F.create_map(*pairs)[F.col("part")], F.lit(1)) if pairs else F.lit(1)


def _numbers(count: Column) -> Column:
    return F.sequence(F.lit(0), count - 1)


def compared(found: pd.DataFrame, asked: pd.DataFrame, keep: int) -> pd.DataFrame:
    """The ``keep`` nearest vectors of a block for each query: cosine, then smallest id."""
    out = {"query": [], "score": [], "ids": []}
    if len(found) and len(asked):
        vectors = np.stack(found["vector"].to_numpy()).astype(np.float64)
        queries = np.stack(asked["vector"].to_numpy()).astype(np.float64)
        norms, own = np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), np.sqrt(np.einsum("ij,ij->i", queries, queries))
        first = np.array([ids[0] for ids in found["ids"]])
        for at in range(0, len(queries), 256):
            near = (queries[at : at + 256] @ vectors.T) / norms / own[at : at + 256, None]
            some = min(keep + 8, len(vectors))
            least = np.partition(near, len(vectors) - some, axis=1)[:, len(vectors) - some]
            for k, row in enumerate(near):
                # All within rounding of the last one; then scored one pair like another, wherever it is.
                chosen = np.flatnonzero(row >= least[k] - 1e-12)
                score = np.einsum("ij,j->i", vectors[chosen], queries[at + k]) / (norms[chosen] * own[at + k])
                best = np.lexsort((first[chosen], -score))[:keep]
                out["query"] += [asked["key"].iat[at + k]] * len(best)
                out["score"] += score[best].tolist()
                out["ids"] += [list(found["ids"].iat[int(j)]) for j in chosen[best]]
    kinds = {"query": object, "score": np.float64, "ids": object}
    return pd.DataFrame({name: pd.Series(out[name], dtype=kind) for name, kind in kinds.items()})


def _compared(home: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query, score, ids): the nearest of each block of each searched part."""
    out = common.written(asked, "routed_queries")
    blocks, lots = _sizes(home, BLOCK_ROWS), _sizes(out, BLOCK_QUERIES)
    dealt = lambda counts: F.pmod(F.xxhash64("key"), _by_part(counts)).cast("int")
    found = home.withColumn("block", dealt(blocks)).withColumn("lot", F.explode(_numbers(_by_part(lots))))
    asked = out.withColumn("lot", dealt(lots)).withColumn("block", F.explode(_numbers(_by_part(blocks))))

    def compare(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return compared(found, asked, k + 1)

    return (
        found.groupBy("part", "block", "lot")
        .cogroup(asked.groupBy("part", "block", "lot"))
        .applyInPandas(compare, "query string, score double, ids array<long>")
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    parts: int | None = None,
    probes: int | None = None,
    sample: int = SAMPLE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found ``k`` rows of ``vectors`` for each of ``queries``.

    Nearness is the cosine in double precision, ties go to the smaller id; a row with the query's own
    id is no candidate. Both tables have the columns ``id_col`` and ``vector_col``. What ``usable``
    leaves out takes no part, rows equal in both columns are one, rows of one id with different vectors
    are candidates and queries each. Vectors of each length are searched for themselves; a query has no
    rows if no candidate has its length. ``parts`` and ``probes``, for each length, default to what the data's size and the
    sample's recall ask for; with one part the result is exact. Other columns are left out, whatever they
    are called. No rows give no rows.
    """
    rows = usable(vectors, id_col, vector_col)
    every = common.written(distinct_vectors(rows, k + 1), "vectors")
    wanted = usable(queries, id_col, vector_col).withColumn("key", F.sha2(F.to_json("vector"), 256))
    wanted = common.written(wanted, "queries")
    asked = wanted.groupBy("key").agg(F.first("vector").alias("vector"))
    searched = shares(every, wanted, k, parts, probes, sample)

    home = common.written(_routed(every, searched, True), "routed_vectors")
    near = common.written(_compared(home, _routed(asked, searched, False), k), "near")
    # Of a query with fewer than k others in its parts, all parts are searched. Each id counts, its own not.
    held = near.groupBy("query").agg(F.sum(F.size("ids")).alias("n"))
    short = asked.join(held.where(F.col("n") > k), F.col("key") == F.col("query"), "left_anti")
    whole = {length: replace(share, probes=share.router.parts) for length, share in searched.items()}
    if any(share.probes < share.router.parts for share in searched.values()):
        short = common.written(short, "short")
        if not short.isEmpty():
            known = near.join(short.select(F.col("key").alias("query")), "query", "left_anti")
            near = known.unionByName(_compared(home, _routed(short, whole, False), k))
    each = near.select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    # One more than asked for, as one may be the query itself.
    best = common.written(each.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n"), "nearest")
    pairs = wanted.select(F.col("id").alias("query_id"), "key").join(best, F.col("key") == F.col("query"))
    last = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.where("vec_id <> query_id").withColumn("rank", F.row_number().over(last))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
