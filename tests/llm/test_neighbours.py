"""Nearest neighbours: recall and scores against brute force, balance, ties, edge cases."""

import numpy as np
import pytest

from streambed.llm import neighbours as n
from streambed.llm.queries import op9_neighbours
from tests.llm.fixtures import TINY


def clustered(rng, count, size=16, centres=30):
    middle = rng.normal(size=(centres, size))
    return (middle[rng.integers(0, centres, count)] + 0.3 * rng.normal(size=(count, size))).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<float>, score double, part string")


def plain(rows, queries, k):
    """(query, [(score, id)]) by comparing all; rows of usable vectors, once each."""
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows))
    matrix = np.array([v for _, v in rows], np.float32).astype(np.float64)
    norms = np.sqrt((matrix * matrix).sum(1))
    out = []
    for i, v in dict.fromkeys((i, tuple(v)) for i, v in queries):
        q = np.array(v, np.float32).astype(np.float64)
        scores = np.einsum("ij,j->i", matrix, q) / (norms * np.sqrt((q * q).sum()))
        found = sorted((-s, other) for s, (other, _) in zip(scores.tolist(), rows) if other != i)[:k]
        out.append((i, [(-s, other) for s, other in found]))
    return out


def ranked(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in found.values())
    return {k: [x[1:] for x in sorted(v)] for k, v in found.items()}


def test_parts_are_balanced_and_follow_the_graph():
    vectors = n._unit(clustered(np.random.default_rng(1), 1200).astype(float))
    near = n.neighbour_graph(vectors, 10)
    label = n.balanced_parts(near, 6)
    sizes = np.bincount(label, minlength=6)
    assert sizes.max() <= 1.05 * 200 + 1 and (label[near] == label[:, None]).mean() > 0.6
    true = np.argsort(-(vectors @ vectors.T - 9 * np.eye(1200)), axis=1)[:, :10]
    assert all(set(a) == set(b) for a, b in zip(near.tolist(), true.tolist()))


def test_recall_with_learned_parts_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(n, "BLOCK_ROWS", 200)
    monkeypatch.setattr(n, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(2)
    rows = [(k, v.tolist()) for k, v in enumerate(clustered(rng, 3000))]
    queries = [r for r in rows if r[0] % 50 == 0]
    router = n.learn(np.array([v for _, v in rows]), 12)
    assert router.probes < 8
    found = ranked(n.nearest(frame(spark, rows), frame(spark, queries), parts=12))
    want = dict(plain(rows, queries, 5))
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    for q, pairs in found.items():
        exact = {i: s for s, i in dict(plain(rows, [rows[q]], 3000))[q]}
        assert all(abs(exact[i] - s) < 1e-14 for s, i in pairs)


def test_frequent_vectors_ties_nulls_and_repeats(spark):
    same, zero = [1.0, 2.0, 0.0], [0.0, 0.0, 0.0]
    rows = [(k, same) for k in range(300, 0, -1)] + [(k, [2.0, 4.0, 0.0]) for k in range(400, 404)]
    rows += [(500, [0.0, 1.0, 1.0]), (501, [0.0, 1.0, 1.0]), (500, [0.0, 1.0, 1.0]), (500, [1.0, 0.0, 0.0])]
    bad = [(600, None), (601, zero), (602, [1.0, None, 0.0]), (603, [float("nan"), 0.0, 1.0]), (604, [float("inf"), 0.0, 1.0]),
           (605, [1.0]), (None, same), (606, [])]
    asked = [(1, same), (300, same), (400, [2.0, 4.0, 0.0]), (500, [0.0, 1.0, 1.0]), (601, zero), (602, [1.0, None, 0.0])]
    found = ranked(n.nearest(frame(spark, rows + bad), frame(spark, asked)))
    want = dict(plain(rows, asked[:4], 5))
    assert {k: [i for _, i in v] for k, v in found.items()} == {k: [i for _, i in v] for k, v in want.items()}
    assert [i for _, i in found[1]] == [2, 3, 4, 5, 6] and [i for _, i in found[300]] == [1, 2, 3, 4, 5]


def test_each_length_is_searched_for_itself(spark):
    rng = np.random.default_rng(3)
    rows = [(k, v.tolist()) for k, v in enumerate(clustered(rng, 1500))]
    rows += [(5000 + k, v.tolist()) for k, v in enumerate(clustered(rng, 700, size=8))]
    rows += [(9000, [1.0, 2.0]), (9001, [2.0, 1.0]), (9002, [1.0]), (9003, [1.0, 2.0, 3.0])]
    asked = [r for r in rows if 5000 <= r[0] < 5040 or r[0] in (7, 9000, 9001, 9002)] + [(9999, [1.0, 2.0, 2.0, 2.0])]
    same = lambda v: [r for r in rows if len(r[1]) == len(v)]
    want = {i: plain(same(v), [(i, v)], 5)[0][1] for i, v in asked if len(same(v)) > 1}
    found = ranked(n.nearest(frame(spark, rows), frame(spark, asked), parts=1))
    assert {i: [other for _, other in v] for i, v in found.items()} == {i: [other for _, other in v] for i, v in want.items()}
    for options in ({}, {"parts": 6}):
        several = ranked(n.nearest(frame(spark, rows), frame(spark, asked), **options))
        hits = sum(len({j for _, j in several[i]} & {j for _, j in pairs}) for i, pairs in want.items())
        assert set(several) == set(want) and hits / sum(map(len, want.values())) >= 0.9
        assert all(len(several[i]) == len(pairs) for i, pairs in want.items())


def test_parts_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(n, "MOST_PARTS", 6)
    rng = np.random.default_rng(7)
    rows = [(k, v.tolist()) for k, v in enumerate(clustered(rng, 4000))]
    vectors = frame(spark, rows)
    every = n.distinct_vectors(n.usable(vectors), 6)
    share = n.shares(every, n.usable(vectors), 5, None, None, n.SAMPLE)[16]
    assert len(share.router.inner) == 4 and share.router.parts == 16 and share.probes < 8
    odds = share.router.log_odds(n._unit(np.array([v for _, v in rows[:50]])))
    assert np.allclose(np.exp(odds).sum(1), 1)
    asked = [r for r in rows if r[0] % 50 == 0]
    found, want = ranked(n.nearest(vectors, frame(spark, asked))), dict(plain(rows, asked, 5))
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9


def test_a_query_whose_parts_hold_too_few_is_compared_with_all(spark):
    """Parts of few vectors and one probe: every query still gets its five."""
    rng = np.random.default_rng(4)
    rows = [(k, v.tolist()) for k, v in enumerate(clustered(rng, 600))]
    found = ranked(n.nearest(frame(spark, rows), frame(spark, rows[::20]), parts=64, probes=1))
    assert len(found) == 30 and all(len(v) == 5 for v in found.values())


def test_the_index_spares_half_of_the_work_on_clustered_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(k, v.tolist()) for k, v in enumerate(clustered(rng, 3000))]
    every = n.distinct_vectors(n.usable(frame(spark, rows)), 6)
    share = n.shares(every, n.usable(frame(spark, rows)), 5, None, None, n.SAMPLE)[16]
    assert share.router.parts == 14 and share.probes <= share.router.parts / 2


@pytest.mark.parametrize("count", [0, 1, 3])
def test_few_rows(spark, count):
    rows = [(50 * k, [1.0, float(k)]) for k in range(count)]
    found = ranked(n.nearest(frame(spark, rows), frame(spark, rows)))
    assert {k: len(v) for k, v in found.items()} == ({} if count < 2 else {50 * k: count - 1 for k in range(count)})


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{TINY}/embeddings.parquet").collect()]
    found, want = ranked(op9_neighbours(spark, TINY)), plain(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert len(found) == len(want)
    hits = sum(len({i for _, i in found[q]} & {i for _, i in pairs}) for q, pairs in want)
    assert hits / (5 * len(want)) >= 0.9
