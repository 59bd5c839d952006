"""Decontamination: masks over all cases, overlaps against brute force, edge cases."""

import random
from itertools import combinations

import numpy as np

from streambed.llm import decontaminate as d
from streambed.llm.queries import op4_decontaminate
from tests.llm.fixtures import TINY, documents, same_columns


def test_masks_find_every_window_whichever_words_differ():
    for differ in combinations(range(d.WINDOW), d.WINDOW - d.MATCHES):
        assert any(
            not {at + offset for offset in mask} & set(differ)
            for mask in d.MASKS
            for at in range(d.WINDOW - mask[-1])
        )


def plain_overlaps(docs, items):
    """(document, item) pairs that overlap, by comparing all words, and every window at each distance at which
    enough words are equal."""
    hashed = {}
    for item_id, text in items:
        words = d.word_hashes(text)
        if len(words) >= d.LEAST_WORDS:
            key = words.tobytes()
            hashed[key] = min(hashed.get(key, item_id), item_id)
    out = set()
    for k, text in docs:
        words = d.word_hashes(text)
        for key, item_id in hashed.items():
            item = np.frombuffer(key, np.uint64)
            size, least = (d.WINDOW, d.MATCHES) if len(item) >= d.WINDOW else (len(item), len(item))
            at, item_at = np.nonzero(words[:, None] == item[None, :])
            shifts, equal = np.unique(at - item_at, return_counts=True)
            for shift in shifts[equal >= least].tolist():
                a, b = words[max(0, shift) :], item[max(0, -shift) :]
                n = min(len(a), len(b))
                if n >= size and np.convolve(a[:n] == b[:n], np.ones(size), "valid").max() >= least:
                    out.add((k, item_id))
                    break
    return out


def test_random_passages_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("xyz")
    items = [(k, " ".join(word() for _ in range(rng.choice([5, 8, 11, 14, 15, 16, 30, 59])))) for k in range(25)]
    items += [(90, items[3][1].upper() + "!"), (91, None), (92, "")]
    docs = []
    for k in range(120):
        words = [word() for _ in range(rng.randint(0, 80))]
        if k % 3:
            passage = rng.choice(items[:25])[1].split()
            cut = rng.randint(0, len(passage) // 2) if k % 2 else 0
            passage = passage[cut : len(passage) - rng.randint(0, 3)]
            for _ in range(rng.randint(0, len(passage) // 3)):
                passage[rng.randrange(len(passage))] = word()
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((k, " ".join(words)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = d.overlaps(documents(spark, docs), benchmark).collect()
    want = plain_overlaps(docs, items)
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want) > 20
    kept = d.drop_contaminated(documents(spark, docs), benchmark)
    assert {r.doc_id for r in kept.collect()} == set(range(120)) - {k for k, _ in want}


def test_query_against_brute_force(spark):
    read = lambda name: [tuple(r) for r in spark.read.parquet(f"{TINY}/{name}.parquet").collect()]
    docs = [(r[0], r[1]) for r in read("documents")]
    found = {(r.doc_id, r.item_id) for r in op4_decontaminate(spark, TINY).collect()}
    assert found == plain_overlaps(docs, read("benchmark")) and found


ITEM = "the quick brown fox jumps over a lazy dog while seven wizards box with five jugs"


def test_spans_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "start here " + ITEM.upper() + ", end"), (None, ITEM), (2, None), (3, ""), (4, "clean"), (1, "clean"), (5, ITEM), (5, ITEM)]
    docs, benchmark = documents(spark, rows), spark.createDataFrame([(7, ITEM), (6, ITEM + "."), (None, "x")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.start, r.stop) for r in d.overlaps(docs, benchmark).collect()}
    assert found == {(1, 6): (2, 18), (None, 6): (0, 16), (5, 6): (0, 16)}
    kept = d.drop_contaminated(docs, benchmark)
    same_columns(docs, kept)
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text is not None) == [(1, "clean"), (3, ""), (4, "clean")]
    assert kept.where("doc_id = 2").count() == 1


def test_empty_tables(spark):
    docs, none = documents(spark, [(1, ITEM)]), spark.createDataFrame([], "item_id long, text string")
    assert d.overlaps(docs, none).count() == 0 and d.drop_contaminated(docs, none).count() == 1
    assert d.overlaps(documents(spark, []), spark.createDataFrame([(1, ITEM)], "item_id long, text string")).count() == 0


def test_long_texts_in_chunks(monkeypatch):
    words = d.word_hashes(" ".join(map(str, range(200))))
    whole = [d.seeds(words, mask, k).tolist() for k, mask in enumerate(d.MASKS)]
    for k, mask in enumerate(d.MASKS):
        parts = [d.seeds(words[at : at + 7 + mask[-1]], mask, k).tolist() for at in range(0, 200 - mask[-1], 7)]
        assert sum(parts, []) == whole[k]


def test_a_long_item_is_written_in_proportion_to_its_words(spark):
    text = " ".join(map(str, range(20_000)))
    items = d.benchmark_seeds(spark.createDataFrame([(1, text)], "item_id long, text string"))
    row = items.selectExpr("count(*) AS n", "max(length(item_around)) AS most", "sum(length(item_around)) AS whole").first()
    assert row.n < 60_000 and row.most <= 8 * (2 * d.WINDOW + d.LEAST_WORDS) and row.whole < 20_000_000
    docs = documents(spark, [(5, "x y z " + " ".join(map(str, range(9_000, 9_020))) + " end"), (6, "1 2 3 4 5 6 7 8")])
    found = d.overlaps(docs, spark.createDataFrame([(1, text)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(5, 1)] and found[0].start <= 3 and found[0].stop >= 23
