"""Fill-in-middle: against a plain loop and SQL, exact round trip, edge cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from streambed.llm import fill_middle
from streambed.llm.queries import OP13_SQL, op13_fill_middle
from tests.compare import difference, duck
from tests.llm.fixtures import SMALL, documents

TEXTS = [
    "", "\n", "\n\n\n", "one", "one\n", "one\ntwo", "a\n\nb\n", "tail <", "<S", "a <P> b\nc", "x\n<M>", "é\r\nü\n日本\n👩‍👩‍👧",
    "line\n" * 3000, "x" * 50_000, "\x00\n\t\n ", "P>\n<\nS>\n<", "same\nsame\nsame\n",
]


def by_hand(doc_id, text, seed=7, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows():
    return [(k, t) for k, t in enumerate(TEXTS * 4)] + [(None, "no id\nhere\n"), (5, None), (6, TEXTS[6]), (6, TEXTS[6])]


@pytest.mark.parametrize("options", [{}, {"seed": 11, "fim_percent": 60, "spm_percent": 20}, {"fim_percent": 0}])
def test_against_a_plain_loop(spark, options):
    found = [tuple(r) for r in fill_middle.transform(documents(spark, rows()), **options).collect()]
    named = {"seed": "seed", "fim_percent": "fim", "spm_percent": "spm"}
    want = [by_hand(k, t, **{named[o]: v for o, v in options.items()}) for k, t in rows()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_every_text_is_restored(spark):
    found = fill_middle.transform(documents(spark, rows()))
    back = found.withColumn("text", fill_middle.restore(F.col("output"), F.col("form"))).select("doc_id", "text")
    want = [(k, t or "") for k, t in rows()]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(want, key=repr)
    assert {r.form for r in found.collect()} == {"plain", "psm", "spm"}


def test_batches_of_any_size_agree(spark, monkeypatch):
    want = sorted(map(tuple, fill_middle.transform(documents(spark, rows())).collect()), key=repr)
    monkeypatch.setattr(fill_middle.common, "OUT_BYTES", 10)
    assert sorted(map(tuple, fill_middle.transform(documents(spark, rows())).collect()), key=repr) == want


def test_no_marker_begins_inside_another():
    assert all(m.count(m[0]) == 1 and m[0] not in other[1:] for m in fill_middle.MARKERS for other in fill_middle.MARKERS)


def test_query_matches_sql(spark):
    assert difference(spark, duck(SMALL), SMALL, op13_fill_middle, OP13_SQL) is None


def test_empty_table(spark):
    assert fill_middle.transform(documents(spark, [])).count() == 0
