"""Line dedup: against brute force over all runs, edge cases."""

import random

import pytest

from streambed.llm import line_dedup
from streambed.llm.queries import op5_line_dedup
from tests.llm.fixtures import TINY, documents, same_columns


def plain_lines(text):
    return [line.strip() for line in (text or "").split("\n") if line.strip()]


def plain_kept(rows, min_words):
    """Per row (id, text) in order of id: its lines that are in no run of ``min_words`` that occurs earlier."""
    seen, out = {}, []
    for number, (_, text) in enumerate(rows):
        lines = plain_lines(text)
        words = [len(line.split()) for line in lines]
        gone = set()
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += words[b]
                if total >= min_words:
                    run = tuple(lines[a : b + 1])
                    if seen.setdefault(run, (number, a)) < (number, a):
                        gone.update(range(a, b + 1))
                    if total >= 2 * min_words + max(words):
                        break  # longer runs are unions of these
        out.append([line for k, line in enumerate(lines) if k not in gone])
    return out


def test_selected_lines_are_the_windows_minima():
    rng = random.Random(5)
    for _ in range(500):
        n = rng.randint(1, 12)
        words, prints, least = [rng.randint(1, 6) for _ in range(n)], [rng.randint(0, 5) for _ in range(n)], rng.randint(1, 15)
        want = set()
        for a, b in line_dedup.windows(words, least):
            low = min(prints[a : b + 1])
            want.add(max(k for k in range(a, b + 1) if prints[k] == low))
        assert line_dedup.selected(prints, words, least) == sorted(want)


@pytest.mark.parametrize("least", [3, 6])
def test_random_documents_against_brute_force(spark, least):
    rng = random.Random(least)
    lines = ["a", "b b", "c c c", "d d d d", "e  ", "  ", ""]
    rows = [(k, "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for k in range(60)]
    found = line_dedup.remove_repeated(documents(spark, rows), least).collect()
    got = {r.doc_id: plain_lines(r.text) for r in found}
    assert [got[k] for k in range(60)] == plain_kept(rows, least)


def test_query_against_brute_force(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect())
    found = {r.doc_id: r for r in op5_line_dedup(spark, TINY).collect()}
    want = plain_kept(rows, line_dedup.MIN_WORDS)
    assert [plain_lines(found[k].text) for k, _ in rows] == want
    assert sum(r.removed_lines for r in found.values()) == sum(len(plain_lines(t)) - len(w) for (_, t), w in zip(rows, want)) > 0
    assert all(r.n_chars == len(r.text) for r in found.values() if r.removed_lines)


PASSAGE = "\n".join(["one two three four five six"] * 1 + [f"line {k} of a passage that repeats" for k in range(9)])


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [
        (1, "head\n" + PASSAGE + "\ntail"), (2, PASSAGE + "\n\nown end"), (None, PASSAGE), (3, None), (4, ""),
        (2, "other"), (5, PASSAGE), (5, PASSAGE), (6, "short\nshort"),
    ]
    docs = documents(spark, rows)
    found = line_dedup.remove_repeated(docs)
    same_columns(docs, found)
    got = sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)
    assert got == sorted(
        [
            (1, rows[0][1]), (2, "\n\nown end".removeprefix("\n")), (None, ""), (3, None), (4, ""), (2, "other"),
            (5, ""), (5, ""), (6, "short\nshort"),
        ],
        key=repr,
    )


def test_equal_rows_are_one_document_and_empty_tables_stay_empty(spark):
    twice = line_dedup.remove_repeated(documents(spark, [(5, PASSAGE), (5, PASSAGE)]))
    assert [r.text for r in twice.collect()] == [PASSAGE] * 2
    assert line_dedup.remove_repeated(documents(spark, [])).count() == 0
