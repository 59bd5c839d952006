"""Packing: pieces against the tokenizer's own ids, exact round trip, edge cases."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from streambed.llm import common, packing
from streambed.llm.queries import op1_packing
from tests.llm.fixtures import SMALL, documents

ODD = [
    "", " ", "a  b", " x  y ", "a\n b\n\n c", "tail  ", "\x1c a \x85 b", "日本語 テキスト です", "👩‍👩‍👧 ok",
    "don't I'LL we've", "1234 5678 ½", "<|endoftext|> a <|endoftext|>", "é é", "x" * 5000, "word " * 4000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("text", ODD)
def test_encoder_gives_the_tokenizers_ids(tokenizer, text):
    got = np.frombuffer(packing.encoder(None)(text), "<u4").tolist()
    assert got == plain(tokenizer, text)[:-1]


def test_long_texts_are_cut_where_ids_do_not_change(tokenizer, monkeypatch):
    text = ("ab  cd\n ef gh-ij " * 300).strip()
    monkeypatch.setattr(common.pieces, "__defaults__", (50,))
    assert len(list(common.pieces(text))) > 20 and "".join(common.pieces(text)) == text
    assert np.frombuffer(packing.encoder(None)(text), "<u4").tolist() == plain(tokenizer, text)[:-1]


@pytest.mark.parametrize("tokens", [1, 2, 3, 1023, 1024, 1025, 5000])
def test_cuts_cover_a_document_in_powers_of_two(tokens):
    cuts = list(packing.cuts(tokens, 1024))
    assert [s for s, _ in cuts] == [sum(n for _, n in cuts[:k]) for k in range(len(cuts))]
    assert sum(n for _, n in cuts) == tokens and all(n & (n - 1) == 0 and n <= 1024 for _, n in cuts)
    assert [n for _, n in cuts] == sorted((n for _, n in cuts), reverse=True)
    assert len({n for _, n in cuts if n < 1024}) == len([n for _, n in cuts if n < 1024])


def test_round_trip_with_nulls_repeats_and_clashing_columns(spark, tokenizer):
    rows = [(k, text) for k, text in enumerate(ODD)] + [(None, "no id"), (3, None), (4, ODD[4]), (4, ODD[4])]
    found = packing.pack(documents(spark, rows)).collect()
    assert len({r.sequence_id for r in found}) == len(found) and {r.offset for r in found} == {0}
    docs, current = [], b""
    for r in found:
        if r.start == 0:
            docs.append((r.doc_id, []))
        docs[-1][1].append(r)
        assert len(r.ids) == 4 * r.length == 4 * r.bucket
    want = sorted(((k, plain(tokenizer, t)) for k, t in rows), key=repr)
    got = [(k, np.frombuffer(b"".join(p.ids for p in ps), "<u4").tolist()) for k, ps in docs]
    assert sorted(got, key=repr) == want and current == b""
    assert all(p.doc_tokens == sum(q.length for q in ps) for _, ps in docs for p in ps)


def test_query_against_the_tokenizer(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = op1_packing(spark, SMALL).collect()
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        ids = plain(tokenizer, texts[r.doc_id])
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in found) == sum(len(plain(tokenizer, t)) for t in texts.values())


def test_buckets_hold_one_length_each(spark, tmp_path):
    docs = documents(spark, [(k, "some words here " * k) for k in range(9)])
    packing.write_buckets(packing.pack(docs), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.where("bucket <> length").count() == 0 and back.count() == packing.pack(docs).count()


def test_empty_table_and_bad_length(spark):
    assert packing.pack(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        packing.pack(documents(spark, []), max_length=1000)
