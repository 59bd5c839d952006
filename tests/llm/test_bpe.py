"""Byte-pair encoding by proposals: against the tokenizers library, pair by pair and text by text."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from streambed.llm import bpe
from streambed.llm.queries import op11_bpe
from tests.llm.fixtures import SMALL, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a  b", " x  y ", "a\n b\n\n c", "tail  ", "\x1c a \x85 b", "日本語 テキスト です", "👩‍👩‍👧 ok", "é é",
    "don't I'LL we've", "1234 5678 ½", "<|endoftext|> a <|endoftext|>", "a<|endoftext|>b <|endofte", "x" * 5000,
    "word " * 4000, "ab" * 3000 + " " * 300 + "!", "࢏՘ \U00010940 z", "\x00\t\r\n", "İstanbul ǆ ſt",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    return bpe.encoder(None)


def ids(packed):
    return np.frombuffer(packed, "<i4").tolist()


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_ids_are_the_librarys(tokenizer, model, text):
    assert ids(model([text])[0]) == plain(tokenizer, text)


def test_random_texts_of_all_of_unicode(tokenizer, model):
    draw = random.Random(3)
    pick = lambda: chr(draw.choice([draw.randrange(0x250), draw.randrange(0xD800), draw.randrange(0x10000, 0x30000)]))
    texts = ["".join(pick() if draw.random() < 0.3 else draw.choice("aeinorst  \n'.E") for _ in range(400)) for _ in range(60)]
    assert [ids(found) for found in model(texts)] == [plain(tokenizer, text) for text in texts]


def test_latin_classes_are_those_of_the_pre_tokenizer(tokenizer):
    for c in map(chr, range(ord(bpe.LATIN_END))):
        text = f"a{c}{c}1{c}!{c} {c}\n{c}"
        spans = [span for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        assert spans == [m.span() for m in regex.finditer(bpe._WORDS, text)]


def test_compatible_pairs_are_those_that_stay(model):
    vocabulary, draw = model.vocabulary, random.Random(5)
    # Halves of words cut anywhere, so that joined and unjoined pairs both come up.
    pairs = []
    while len(pairs) < 3000:
        word = vocabulary.spelled[draw.randrange(256, vocabulary.size)] + vocabulary.spelled[draw.randrange(vocabulary.size)]
        cut = draw.randrange(1, len(word))
        a, b = vocabulary.merge(word[:cut]), vocabulary.merge(word[cut:])
        pairs.append((a[-1], b[0]))
    a, b = np.array(pairs, np.int64).T
    found = vocabulary.compatible(a, b, np.full(len(a), vocabulary.size))
    want = [vocabulary.merge(vocabulary.spelled[x] + vocabulary.spelled[y]) == [x, y] for x, y in pairs]
    assert found.tolist() == want and 0.05 < np.mean(want) < 0.95


def test_short_and_long_merging_agree(model):
    draw = random.Random(9)
    for n in (1, 2, 3, 10, 63, 64):
        for _ in range(20):
            word = bytes(draw.choice(b"aabbeinst\xc3\xa9") for _ in range(n))
            assert model.vocabulary.merge(word) == model.vocabulary._merge_long(word)


def test_words_merged_together_are_merged_as_each_by_itself(model, monkeypatch):
    draw = random.Random(13)
    words = [bytes(draw.choice(b"aabbeinst \xc3\xa9\x00") for _ in range(draw.randint(1, 64))) for _ in range(2000)]
    monkeypatch.setattr(bpe, "MERGED_TOGETHER", 300)
    assert [ids(found) for found in model.vocabulary.merge_all(words)] == [model.vocabulary.merge(w) for w in words]


def test_proposals_are_verified_and_only_failing_words_merged(model, monkeypatch):
    words = [w.encode() for w in "the quick brown fox outrageously unhappiness zwxqjk".split()]
    calls = []
    monkeypatch.setattr(model.vocabulary, "merge_all", lambda some, f=model.vocabulary.merge_all: calls.extend(some) or f(some))
    found, merged = model.vocabulary.encode_words(words)
    assert merged == len(calls) < len(words)
    assert [ids(x) for x in found] == [bpe.Vocabulary.merge(model.vocabulary, w) for w in words]


def test_cut_texts_and_cleared_chunks_change_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe.common.pieces, "__defaults__", (50,))
    monkeypatch.setattr(bpe, "GROUP_CHARS", 200)
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 20)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 20)
    monkeypatch.setattr(bpe, "KEPT_LENGTH", 6)
    model = bpe.Encoder(PATH)
    texts = [("ab  cd\n ef gh-ij some longerwords here " * 40).strip(), *ODD]
    assert [ids(found) for found in model(texts)] == [plain(tokenizer, text) for text in texts]


def test_nulls_repeats_and_clashing_columns(spark, tokenizer):
    rows = [(k, text) for k, text in enumerate(ODD)] + [(None, "no id"), (3, None), (4, ODD[4]), (4, ODD[4])]
    found = bpe.encode(documents(spark, rows)).withColumn("decoded", bpe.decode(F.col("ids"))).collect()
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    want = sorted(((k, plain(tokenizer, t), t or "") for k, t in rows), key=key)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in found), key=key) == want


def test_decoding_any_ids(spark, tokenizer):
    draw = random.Random(2)
    lists = [[draw.randrange(50257) for _ in range(200)] for _ in range(20)] + [[], [50256, 50256], [70000, 220, -1]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate([*lists, None, [262, None]])], "k int, ids array<int>")
    found = dict(df.select("k", bpe.decode(F.col("ids"))).collect())
    for k, listed in enumerate(lists):
        assert found[k] == tokenizer.decode([i for i in listed if 0 <= i < 50257], skip_special_tokens=False)
    assert found[len(lists)] is None and found[len(lists) + 1] == tokenizer.decode([262])


def test_query_against_the_library(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = op11_bpe(spark, SMALL).collect()
    assert {r.doc_id for r in found} == set(texts) and len(found) == len(texts)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for r in found:
        want = plain(tokenizer, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(want), sha(",".join(map(str, want))))
        assert r.decoded_sha256 == sha(tokenizer.decode(want, skip_special_tokens=False))


def test_empty_table_and_other_tokenizers(spark, tmp_path):
    assert bpe.encode(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["model"]["merges"][:2] = spec["model"]["merges"][1::-1]
    (tmp_path / "swapped.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(tmp_path / "swapped.json"))
