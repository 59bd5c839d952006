"""SimHash: fingerprints and components against brute force, edge cases."""

import random
import re

import pytest
import xxhash

from streambed.llm import simhash
from streambed.llm.components import components
from streambed.llm.queries import op3_simhash
from tests.llm.fixtures import SMALL, documents, same_columns


def plain_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, bits):
    """Smallest id that each (id, fingerprint) reaches."""
    roots = list(range(len(prints)))

    def root(a):
        while roots[a] != a:
            a = roots[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= bits:
                roots[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return [least.get(root(k)) for k in range(len(prints))]


@pytest.mark.parametrize(
    "text", ["", " \t", "One", "a B", "a b c", "É a b ÉA ß\x0bq", "x y z " * 50, "A\x00b c d", None]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_counts_in_chunks(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=500))
    want = plain_fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == want


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_components_of_a_ball_against_all_pairs(spark, bits):
    rng = random.Random(bits)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = []
    for k in range(150):
        value = rng.choice(seeds)
        for _ in range(rng.randint(0, 4)):
            value ^= 1 << rng.randrange(64)
        prints.append((rng.choice([None, k, k, k]), value))
    signed = [(i, 0, v - (1 << 64) if v >> 63 else v) for i, v in prints]
    df = spark.createDataFrame(signed, "doc_id long, text_hash long, fingerprint long")
    found = {r.fingerprint: r.component_id for r in simhash.groups(df, bits).collect()}
    assert [found[v] for _, _, v in signed] == plain_groups(prints, bits)


def test_query_against_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    prints = [(i, plain_fingerprint(t)) for i, t in texts]
    want = {(i, f"{p:016x}", c) for (i, p), c in zip(prints, plain_groups(prints, 2))}
    assert {tuple(r) for r in op3_simhash(spark, SMALL).collect()} == want


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 300)] + [(5, 5), (9, 8), (8, 9)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[k] == 100 for k in range(100, 161)) and all(found[k] == 7 for k in range(200, 300))
    assert found[8] == found[9] == 8 and 5 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


LONG = " ".join(random.Random(3).choices(["alpha", "beta", "gamma", "delta", "eps", "zeta"], k=900))
ROWS = [
    (4, LONG), (2, LONG.upper()), (2, LONG), (None, LONG), (9, None), (8, ""), (7, "  \n"), (None, ""), (11, "One"),
    (12, "one"), (13, "other text here that is alone"), (13, "other text here that is alone"),
]


def test_nulls_empty_texts_and_repeated_rows(spark):
    found = simhash.near_duplicates(documents(spark, ROWS)).collect()
    assert len(found) == len(ROWS)
    by_print = {}
    for r in found:
        by_print.setdefault(r.root, set()).add(r.component_id)
    assert {frozenset(v) for v in by_print.values()} == {frozenset(x) for x in ({2}, {7}, {11}, {13})}


def test_deduplicate_keeps_one_row_of_each_group_whole(spark):
    docs = documents(spark, ROWS)
    kept = simhash.deduplicate(docs)
    same_columns(docs, kept)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 11, 13]
    only_null = simhash.deduplicate(documents(spark, [(None, LONG), (None, LONG), (None, "x y z")]))
    assert only_null.count() == 2
    assert simhash.deduplicate(documents(spark, [])).count() == 0
