"""Packing by power-of-two decomposition.

A document of n tokens (its ids and an end id) is cut into floor(n / max_length) pieces of
max_length and one piece for each set bit of the rest, longest first. Every piece is a sequence of
its own: its length is a power of two, so nothing is padded and no sequence crosses documents.
Sequences of equal length form a bucket, from which a trainer draws its batches.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streambed.llm import common

SCHEMA = "doc_id long, start long, length long, doc_tokens long, offset long, ids binary"
_ARROW = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "doc_tokens", "offset")] + [("ids", pa.binary())]
)

# Words kept with their ids in each Python worker, and the longest word kept.
KEPT_WORDS = 250_000
KEPT_LENGTH = 48

_BLANKS = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit integers.

    A byte-level BPE never joins characters across a blank that follows a non-blank, so a text's ids
    are the ids of its blank-separated words one after the other; words repeat and are kept. If the
    file's ids follow its merge order (checked), words are encoded from the ids as ranks, which gives
    the same ids with less work for short strings. Texts that hold an added token's string go through
    the tokenizer as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.encode = self._ranked(path) or self._plain
        self.split = self._byte_level(path)
        self.words = _Words(lambda word: self.encode(" " + word))

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _byte_level(path: str) -> bool:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        step = spec.get("pre_tokenizer") or {}
        return step.get("type") == "ByteLevel" and not step.get("add_prefix_space") and not spec.get("normalizer")

    def _ranked(self, path: str):
        """An encoder by ranks, if the file's ids are in merge order; else None."""
        import public_tokenizers
        import tiktoken

        if not self._byte_level(path):
            return None
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if model.get("type") != "BPE" or any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(merges)):
            return None
        # The printable stand-ins for bytes: Latin characters for themselves, the others from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in word): i for word, i in vocab.items() if i < 256 + len(merges)}
        return tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.split or any(token in text for token in self.added):
            return array("I", self._plain(text)).tobytes()
        return b"".join(self._part(part) for part in common.pieces(text))

    def _part(self, text: str) -> bytes:
        first, *words = _CUT.split(text) if _BLANKS.search(text) else text.split(" ")
        return array("I", self.encode(first)).tobytes() + b"".join(map(self.words.__getitem__, words))


class _Words(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(word)).tobytes()
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def encoder(path: str | None) -> Encoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Encoder(path)


def cuts(tokens: int, max_length: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    start = 0
    for _ in range(tokens // max_length):
        yield start, max_length
        start += max_length
    rest, bit = tokens % max_length, max_length >> 1
    while bit:
        if rest & bit:
            yield start, bit
            start += bit
        bit >>= 1


def pack(
    docs: DataFrame,
    max_length: int = 1024,
    tokenizer: str | None = None,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per sequence: its piece's place in the document, its ids, its number and bucket.

    ``max_length`` must be a power of two. Columns: doc_id, start, length, doc_tokens (with the end
    id), offset (0: a sequence is one piece), ids (little-endian unsigned 32-bit), sequence_id
    (unique in the result), bucket (the sequence's length).

    A null or empty text is a document of the end id alone. A null id stays null; rows with equal ids
    or texts are packed each for itself. Other columns are left out. No rows give no rows. A text is
    encoded whole, in parts of about a million characters.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encode = encoder(tokenizer)
        rows, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                tokens = len(ids) // 4
                for start, length in cuts(tokens, max_length):
                    rows.append((doc_id, start, length, tokens, 0, ids[4 * start : 4 * (start + length)]))
                size += len(ids)
                if len(rows) >= common.OUT_ROWS or size >= common.OUT_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    found = common.small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return found.mapInArrow(run, SCHEMA).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.col("length").alias("bucket")
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def write_buckets(sequences: DataFrame, folder: str) -> None:
    """One folder per length, so that a batch of one length reads that folder alone."""
    sequences.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
