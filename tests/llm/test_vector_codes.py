"""Vector codes: against plain k-means in Python integers, the bounds' promises, SQL, edge cases."""

import math

import numpy as np
import pytest

from streambed.llm import vector_codes as vc
from streambed.llm.queries import OP12_SQL, op12_vector_codes
from tests.compare import difference, duck
from tests.llm.fixtures import CLASHING, SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{(vec_id, label, code, error): times} of vectors of one length."""
    usable = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(scale * float(np.float32(x))) for x in r[1]] + [0] * (-len(r[1]) % parts) for r in usable]
    width = len(ints[0]) // parts if ints else 0
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in ints]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, book: min(range(len(book)), key=lambda k: (apart(x, book[k]), k))
    for _ in range(rounds):
        for p in range(parts):
            mine = [nearest(v[p], books[p]) for v in cut]
            for k in range(len(books[p])):
                own = [v[p] for v, m in zip(cut, mine) if m == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = []
    for r, v in zip(usable, cut):
        code = [nearest(v[p], books[p]) for p in range(parts)]
        error = sum(apart(v[p], books[p][k]) for p, k in enumerate(code))
        found.append((r[0], None if r[2] is None else str(r[2]), "".join(f"{k:02x}" for k in code), error))
    return sorted(found, key=repr), books


def coded(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found, books = vc.compress(df, **options)
    return sorted(((r.vec_id, r.label, r.code, r.error) for r in found.collect()), key=repr), books


def clustered(n, width=16, groups=10, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, width))
    rows = centres[draw.integers(groups, size=n)] + draw.normal(scale=0.05, size=(n, width))
    return [(k, row.astype(np.float32).tolist(), int(k % 3)) for k, row in enumerate(rows)]


@pytest.mark.parametrize("rows", [
    clustered(300),
    [(k, [float((k * 7 + p) % 5) / 8 for p in range(16)], None) for k in range(200)],  # many ties and repeats
    [(k, [0.25] * 8, 1) for k in range(50)],  # one vector only
    clustered(5, width=8),  # fewer than the entries
    [(k, v, label) for k, v, label in clustered(60, width=13)],  # not a multiple of the parts
])
def test_against_plain_k_means(spark, rows):
    found, books = coded(spark, rows)
    want, want_books = by_hand(rows)
    assert found == want
    assert next(iter(books.entries.values())).tolist() == want_books


def test_nulls_repeats_and_values_that_are_no_numbers(spark):
    rows = clustered(120) + [
        (None, [0.5] * 16, None), (3, [0.1] * 16, 2), (3, [0.1] * 16, 2), (3, [-0.1] * 16, 2), (900, None, 1),
        (901, [None] + [0.0] * 15, 1), (902, [float("nan")] * 16, 1), (903, [0.0] * 15 + [float("-inf")], None),
    ]
    assert coded(spark, rows)[0] == by_hand(rows)[0]


def test_other_parts_entries_and_rounds(spark):
    rows = clustered(150, width=12)
    for options in ({"parts": 3, "entries": 40, "rounds": 2}, {"entries": 1}, {"entries": 2, "rounds": 0}, {"scale": 100}):
        assert coded(spark, rows, **options)[0] == by_hand(rows, **options)[0]
    with pytest.raises(ValueError):
        coded(spark, rows, entries=300)


def test_each_length_has_its_own_codebooks(spark):
    short = clustered(40, width=8, seed=1)
    long = [(k + 1000, v, label) for k, v, label in clustered(70, width=24, seed=2)]
    empty = [(5000, [], 7), (5001, [], None)]
    found, books = coded(spark, short + long + empty)
    want = by_hand(short)[0] + by_hand(long)[0] + [(5000, "7", "00" * 8, 0), (5001, None, "00" * 8, 0)]
    assert found == sorted(want, key=repr) and set(books.entries) == {0, 8, 24}


def test_large_components(spark):
    rows = [(k, [x * 5000 for x in v], label) for k, v, label in clustered(80)]
    assert coded(spark, rows)[0] == by_hand(rows)[0]
    with pytest.raises(Exception, match="no distances in 64 bits"):
        coded(spark, [(1, [1e30] * 8, 1)])


def test_bounds_hold_and_spare_work():
    """Every bound holds against the real distances; few parts look at more than their own entry."""
    x = np.array([row[1] for row in clustered(4000, width=8, groups=12)])
    x = np.floor(x * 4096).astype(np.int64)
    part = np.zeros(len(x), np.int64)
    books = x[:16][None].copy()
    found, b, looked = vc.assign_fully(x, part, books, 4), 4, []
    for _ in range(8):
        new = books.copy()
        for k in range(16):
            own = x[found.nearest[:, 0] == k]
            new[0, k] = own.sum(0) // len(own) if len(own) else books[0, k]
        moves = np.sqrt(np.square(new - books).sum(-1)) * (1 + vc.ROUNDING)
        books = new
        found = vc.assign_by_bounds(x, part, books, moves, found, b)
        real = np.sqrt(vc.distances(x, np.broadcast_to(books[0], (len(x), *books[0].shape))))
        assert (found.nearest[:, 0] == real.argmin(1)).all()
        assert (found.upper >= real[np.arange(len(x)), found.nearest[:, 0]] * (1 - 1e-9)).all()
        assert (np.diff(found.lower, axis=1) >= 0).all()
        listed = np.zeros_like(real, bool)
        np.put_along_axis(listed, found.nearest, True, 1)
        assert (found.lower[:, -1:] <= np.where(listed, np.inf, real)).all()
        for z in range(b):
            rest = np.take_along_axis(real, found.nearest[:, z + 1 :], 1)
            assert (found.lower[:, z : z + 1] <= rest).all()
        looked.append((found.needed > 0).mean())
        b = vc._fewer(b, np.bincount(found.needed, minlength=128), 2)
    assert b == 2 and looked[-1] < 0.2


def test_b_shrinks_only_where_it_was_not_needed():
    needed = np.zeros(128, np.int64)
    needed[[0, 1, 2, 5]] = 900, 80, 15, 5
    assert vc._fewer(4, needed, 2) == 2 and vc._fewer(4, needed, 1) == 1
    needed[4] = 100
    assert vc._fewer(4, needed, 2) == 4


def test_states_between_rounds_show_less_and_less_work(spark, monkeypatch):
    stats = []

    def kept(tables, df, written=vc._Tables.written):
        out = written(tables, df)
        if "needed" in out.columns:
            rows = out.select("needed", "bounds").collect()
            needed = [z for r in rows for z in r.needed]
            stats.append((sum(z > 0 for z in needed) / len(needed), len(rows[0].bounds)))
        return out

    monkeypatch.setattr(vc._Tables, "written", kept)
    coded(spark, clustered(600))
    shares, lists = zip(*stats)
    assert len(stats) == 6 and shares[0] == 1 and shares[-1] < 0.4 and lists[-1] < lists[0]


def test_label_errors_put_nulls_together(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 7), (3, "a", 1), (4, None, 1)], "vec_id long, label string, error long")
    found = {r.vec_id: r.label_error for r in vc.label_errors(df).collect()}
    assert found == {1: 6, 2: 8, 3: 6, 4: 8}


def test_extra_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = clustered(40)
    df = spark.createDataFrame(rows, SCHEMA)
    names = set(CLASHING) | {"code", "width", "ints", "nearest", "bounds", "needed", "error", "vector"}
    wide = df.select("*", *[F.lit("x").alias(name) for name in sorted(names)])
    found, _ = vc.compress(wide)
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in found.collect()), key=repr) == by_hand(rows)[0]


def test_empty_table(spark):
    found, books = vc.compress(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and books.entries == {}
    assert vc.label_errors(found).count() == 0


def test_query_matches_sql(spark):
    assert difference(spark, duck(SMALL), SMALL, op12_vector_codes, OP12_SQL) is None
