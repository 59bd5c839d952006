"""Byte-pair encoding and decoding: speculate, verify, merge only where the guess fails.

For every word not seen before, greedy longest match proposes tokens. A sequence of tokens is what
merging in rank order gives exactly if each token merges to itself and every two adjacent tokens are
compatible: no merge across their border comes before the merges that build them. The proposals'
adjacent pairs are tested all at once in numpy; words with an incompatible pair are merged one by one.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streambed.llm import common

_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

# Chunks of text, and words, kept with their ids in each Python worker, and the longest ones kept.
KEPT_CHUNKS, KEPT_WORDS = 250_000, 500_000
KEPT_LENGTH = 48
# Bytes up to which a word's pairs are looked through for each merge; a heap holds those of longer ones.
SHORT = 64
# Words that are merged together in one array.
MERGED_TOGETHER = 1 << 16
# Characters of text whose new words are proposed and verified together.
GROUP_CHARS = 4 << 20

# A byte-level pre-tokenizer never joins characters across a blank that follows a non-blank.
_CUT = re.compile(r"(?<=\S)(?= )")
# The byte-level pre-tokenizer's words. Before this character all versions of Unicode agree about the
# classes (tested); chunks with others go to the pre-tokenizer itself.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LATIN_END = "\u0250"
_LATIN_CHUNK = re.compile(rf" [^{LATIN_END}-\U0010ffff]*(?<=\S)")


class Vocabulary:
    """The tables of a byte-level BPE file whose ids stand in merge order."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, step = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab = model["vocab"]
        added = spec.get("added_tokens") or []
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if (
            model.get("type") != "BPE"
            or step.get("type") != "ByteLevel"
            or step.get("add_prefix_space")
            or spec.get("normalizer")
            or any(model.get(name) for name in options)
            or any(token.get(name) for token in added for name in ("single_word", "lstrip", "rstrip"))
            or any(vocab.get(a + b) != 256 + k or max(vocab[a], vocab[b]) >= 256 + k for k, (a, b) in enumerate(merges))
        ):
            raise ValueError("not a plain byte-level BPE with ids in merge order")
        # The printable stand-ins for bytes: Latin characters for themselves, the others from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        stand_ins = own + [256 + k for k in range(256 - len(own))]
        byte = dict(zip(stand_ins, own + [b for b in range(256) if b not in set(own)]))
        self.pre_tokenize = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.to_bytes = {c: chr(b) for c, b in byte.items()}

        self.size = 256 + len(merges)
        spelled = [b""] * self.size
        for word, i in vocab.items():
            if i < self.size:
                spelled[i] = word.translate(self.to_bytes).encode("latin-1")
        self.byte_ids = [0] * 256
        for i in range(256):
            self.byte_ids[spelled[i][0]] = i
        self.left = np.arange(self.size, dtype=np.int64)
        self.right = self.left.copy()
        self.left[256:] = [vocab[a] for a, _ in merges]
        self.right[256:] = [vocab[b] for _, b in merges]
        keys = self.left[256:] * self.size + self.right[256:]
        order = np.argsort(keys)
        self._pairs, self._merged = keys[order], order + 256
        self.merges = dict(zip(zip(self.left[256:].tolist(), self.right[256:].tolist()), range(256, self.size)))
        self._trie(spelled)

        self.added = {token["content"]: token["id"] for token in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None
        self.spelled = spelled + [b""] * (max(self.added.values(), default=-1) + 1 - self.size)
        for content, i in self.added.items():
            # The decoder maps an added token's characters to bytes where all of them are stand-ins.
            plain = all(ord(c) in byte for c in content)
            self.spelled[i] = content.translate(self.to_bytes).encode("latin-1") if plain else content.encode()

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether no merge below rank ``limit`` joins a and b or anything inside them at their border.

        Walks back in time: of the two tokens at the border the later one is taken apart, and a merge
        over the border counts only if it comes before that. Of equal merges the leftmost is first.
        """
        a, b, limit = a.copy(), b.copy(), limit.copy()
        fine = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            keys = x * self.size + y
            at = np.minimum(np.searchsorted(self._pairs, keys), len(self._pairs) - 1)
            joined = (self._pairs[at] == keys) & (self._merged[at] < limit[live])
            fine[live[joined]] = False
            on = ~joined & (np.maximum(x, y) >= 256)
            live, x, y = live[on], x[on], y[on]
            first = x > y
            limit[live] = np.where(first, x, y + 1)
            a[live] = np.where(first, self.right[x], x)
            b[live] = np.where(first, y, self.left[y])
        return fine

    def _trie(self, spelled: list[bytes]) -> None:
        """Steps of the tree of all tokens that merge to themselves, as sorted keys."""
        made = np.arange(256, self.size)
        stable = [True] * 256 + self.compatible(self.left[made], self.right[made], made).tolist()
        for i, (x, y) in enumerate(zip(self.left[256:].tolist(), self.right[256:].tolist()), 256):
            stable[i] = stable[i] and stable[x] and stable[y]
        steps, accepts = {}, [-1]
        for i, text in enumerate(spelled):
            if stable[i]:
                node = 0
                for c in text:
                    key = node << 8 | c
                    node = steps.get(key)
                    if node is None:
                        node = steps[key] = len(accepts)
                        accepts.append(-1)
                accepts[node] = i
        keys = np.fromiter(steps, np.int64, len(steps))
        order = np.argsort(keys)
        self._steps = keys[order]
        self._nodes = np.fromiter(steps.values(), np.int64, len(steps))[order]
        self._accepts = np.array(accepts)
        # Most matches go two steps at least: these are looked up in tables, 0 where no token begins so.
        self._first = np.array([steps[c] for c in range(256)])
        second = [steps.get(int(node) << 8 | c, 0) for node in self._first for c in range(256)]
        self._second = np.array(second)

    def propose(self, data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ids of greedy longest matches; ``room`` is the distance of each byte to its word's end.

        The longest token is sought from every byte at once, one step of the tree a time.
        """
        token = self._accepts[self._first[data]]
        length = np.ones(len(data), np.int64)
        live = np.flatnonzero(room > 1)
        node, depth = self._second[data[live] << 8 | data[live + 1]], 2
        live, node = live[node > 0], node[node > 0]
        found = self._accepts[node]
        token[live[found >= 0]], length[live[found >= 0]] = found[found >= 0], depth
        live, node = live[room[live] > depth], node[room[live] > depth]
        while len(live):
            keys = node << 8 | data[live + depth]
            at = np.minimum(np.searchsorted(self._steps, keys), len(self._steps) - 1)
            hit = self._steps[at] == keys
            live, node, depth = live[hit], self._nodes[at[hit]], depth + 1
            found = self._accepts[node]
            ends = found >= 0
            token[live[ends]], length[live[ends]] = found[ends], depth
            more = room[live] > depth
            live, node = live[more], node[more]
        starts, jumps, place = [], length.tolist(), 0
        while place < len(jumps):
            starts.append(place)
            place += jumps[place]
        starts = np.array(starts, np.int64)
        return starts, token[starts]

    def merge(self, word: bytes) -> list[int]:
        """Merging in rank order, leftmost first."""
        if len(word) > SHORT:
            return self._merge_long(word)
        ids, get, none = [self.byte_ids[c] for c in word], self.merges.get, self.size
        ranks = [get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (merged := min(ranks)) < none:
            k = ranks.index(merged)
            ids[k : k + 2] = [merged]
            del ranks[k]
            if k:
                ranks[k - 1] = get((ids[k - 1], merged), none)
            if k < len(ranks):
                ranks[k] = get((merged, ids[k + 1]), none)
        return ids

    def _merge_long(self, word: bytes) -> list[int]:
        ids = [self.byte_ids[c] for c in word]
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        get = self.merges.get
        heap = [(m, k) for k, pair in enumerate(zip(ids, ids[1:])) if (m := get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            merged, k = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] < 0 or nxt >= len(ids) or get((ids[k], ids[nxt])) != merged:
                continue
            ids[k], ids[nxt], after[k] = merged, -1, after[nxt]
            if after[k] < len(ids):
                before[after[k]] = k
                if (m := get((merged, ids[after[k]]))) is not None:
                    heapq.heappush(heap, (m, k))
            if before[k] >= 0 and (m := get((ids[before[k]], merged))) is not None:
                heapq.heappush(heap, (m, before[k]))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[list[bytes], int]:
        """Each word's ids as little-endian 32-bit integers, and the number of words that had to be merged."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts, tokens = self.propose(data, np.repeat(ends, lengths) - np.arange(len(data)))
        owner = np.searchsorted(ends, starts, "right")
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(tokens[inner] * self.size + tokens[inner + 1], return_inverse=True)
        fine = self.compatible(pairs // self.size, pairs % self.size, np.full(len(pairs), self.size))
        failing = np.unique(owner[inner[~fine[which]]])
        bounds = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        ids = tokens.astype("<i4")
        out = [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
        short = [k for k in failing.tolist() if len(words[k]) <= SHORT]
        for k, merged in zip(short, self.merge_all([words[k] for k in short])):
            out[k] = merged
        for k in failing.tolist():
            if len(words[k]) > SHORT:
                out[k] = np.array(self.merge(words[k]), "<i4").tobytes()
        return out, len(failing)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What adjacent tokens merge to; ``size`` where they do not."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self._pairs, keys), len(self._pairs) - 1)
        return np.where(self._pairs[at] == keys, self._merged[at], self.size)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of many short words at once, those of similar length together, as 32-bit ids."""
        out = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for low in range(0, SHORT, 8):
            group = np.flatnonzero((lengths > low) & (lengths <= low + 8))
            for at in range(0, len(group), MERGED_TOGETHER):
                some = group[at : at + MERGED_TOGETHER].tolist()
                for k, merged in zip(some, self._merge_rows([words[k] for k in some])):
                    out[k] = merged
        return out

    def _merge_rows(self, words: list[bytes]) -> list[bytes]:
        """In each step every word's first pair of least rank is merged; -1 fills the rows' ends."""
        width = max(map(len, words))
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        left = np.fromiter(map(len, words), np.int64, len(words))
        places = np.arange(width)
        ids = np.where(places < left[:, None], np.array(self.byte_ids)[data], -1)
        ranks = np.where(ids[:, 1:] >= 0, self.ranks(ids[:, :-1], ids[:, 1:]), self.size)
        live = np.arange(len(words))
        while len(live) and ranks.shape[1]:
            at = ranks[live].argmin(1)
            merged = ranks[live, at]
            live, at, merged = live[merged < self.size], at[merged < self.size], merged[merged < self.size]
            rows, k = ids[live], at[:, None]
            rows[np.arange(len(live)), at] = merged
            closed = np.concatenate([rows, np.full((len(live), 1), -1)], axis=1)
            rows = np.take_along_axis(closed, places + (places > k), 1)
            pairs = np.concatenate([ranks[live], np.full((len(live), 1), self.size)], axis=1)
            pairs = np.take_along_axis(pairs, places[:-1] + (places[:-1] >= k), 1)
            for beside in (at - 1, at):
                some = np.flatnonzero((beside >= 0) & (beside < width - 1))
                a, b = rows[some, beside[some]], rows[some, beside[some] + 1]
                pairs[some, beside[some]] = np.where(b >= 0, self.ranks(a, b), self.size)
            ids[live], ranks[live] = rows, pairs
            left[live] -= 1
        packed = ids.astype("<i4")
        return [row[:n].tobytes() for row, n in zip(packed, left.tolist())]


class Encoder:
    """Ids of whole texts. Chunks between blanks repeat, so each worker keeps their ids."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}
        self.words = self.merged = 0

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = [[] for _ in texts]
        group, size = [], 0
        for k, text in enumerate(texts):
            for part in self._parts(text):
                if isinstance(part, bytes):
                    group.append((k, part))
                    continue
                group.append((k, _CUT.split(part)))
                size += len(part)
                if size >= GROUP_CHARS:
                    self._resolve(group, out)
                    group, size = [], 0
        self._resolve(group, out)
        return [b"".join(ids) for ids in out]

    def _parts(self, text: str):
        """Stretches of ordinary text, and added tokens as their ids."""
        cut, added = self.vocabulary.added_cut, self.vocabulary.added
        for stretch in cut.split(text) if cut else [text]:
            if stretch in added:
                yield added[stretch].to_bytes(4, "little")
            elif stretch:
                yield from common.pieces(stretch)

    def _resolve(self, group: list, out: list) -> None:
        new = {chunk for _, part in group if not isinstance(part, bytes) for chunk in part if chunk not in self.known}
        if len(self.known) + len(new) > KEPT_CHUNKS:
            new |= {chunk for _, part in group if not isinstance(part, bytes) for chunk in part}
            self.known.clear()
        found = self._encode(list(new))
        self.known.update(found)
        for k, part in group:
            out[k].append(part if isinstance(part, bytes) else b"".join(map(self.known.__getitem__, part)))
        for chunk in found:
            if len(chunk) > KEPT_LENGTH:
                del self.known[chunk]

    def _encode(self, chunks: list[str]) -> dict[str, bytes]:
        """The chunks' ids. Chunks of Latin text are split into words together, others one by one."""
        together = [chunk for chunk in chunks if _LATIN_CHUNK.fullmatch(chunk)]
        alone = set(chunks).difference(together)
        words = _WORDS.findall("".join(together))
        ids = self._word_ids(words)
        out, word = {}, iter(words)
        for chunk in together:
            parts, left = [], len(chunk)
            while left:
                part = next(word)
                left -= len(part)
                parts.append(ids[part])
            out[chunk] = parts[0] if len(parts) == 1 else b"".join(parts)
        for long in [w for w in words if len(w) > KEPT_LENGTH]:
            ids.pop(long, None)
        split = [
            (chunk, [w.translate(self.vocabulary.to_bytes).encode("latin-1") for w, _ in self.vocabulary.pre_tokenize(chunk)])
            for chunk in alone
        ]
        words = list({word for _, spelled in split for word in spelled})
        if words:
            ids = dict(zip(words, self._new(words)))
            out.update((chunk, b"".join(map(ids.__getitem__, spelled))) for chunk, spelled in split)
        return out

    def _new(self, words: list[bytes]) -> list[bytes]:
        ids, merged = self.vocabulary.encode_words(words)
        self.words += len(words)
        self.merged += merged
        return ids

    def _word_ids(self, words: list[str]) -> dict[str, bytes]:
        """Ids by word, of at least the given ones; new words are proposed and verified together."""
        if len(self.known_words) > KEPT_WORDS:
            self.known_words = {}
        known = self.known_words
        new = list({word for word in words if word not in known})
        if new:
            known.update(zip(new, self._new([word.encode() for word in new])))
        return known


@lru_cache(maxsize=2)
def encoder(path: str | None) -> Encoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Encoder(path)


def encode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and ids (array of int), as the tokenizer file prescribes, without
    special tokens being added; an added token's string in a text is that token.

    ``tokenizer`` is the path of a byte-level BPE file whose ids stand in merge order, without
    normalizer; another kind is refused. A null or empty text has no ids. A null id stays null; rows with
    equal ids or texts are encoded each for itself. Other columns are left out. No rows give no rows.
    A text is encoded whole, in parts of about a million characters.
    """

    def run(batches):
        model = encoder(tokenizer)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, size = at + 1, len(texts[at])
                while end < len(texts) and size < GROUP_CHARS:
                    size += len(texts[end])
                    end += 1
                ids = model(texts[at:end])
                offsets = np.cumsum([0, *map(len, ids)]) // 4
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), lists], schema=_ARROW)
                at = end

    found = common.small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return found.mapInArrow(run, "doc_id long, ids array<int>")


@lru_cache(maxsize=2)
def _spellings(path: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes, and by id where they start and how many they are; past the last id an empty one."""
    spelled = [*encoder(path).vocabulary.spelled, b""]
    lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
    return np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(lengths) - lengths, lengths


def _decoded(ids: pa.ListArray, tables) -> pa.Array:
    data, place, length = tables
    flat = np.asarray(ids.values.fill_null(-1)).astype(np.int64)
    flat = np.where((flat < 0) | (flat >= len(length)), len(length) - 1, flat)
    sizes = length[flat]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    spelled = data[np.arange(ends[-1]) + np.repeat(place[flat] - ends[:-1], sizes)].tobytes()
    bounds = ends[np.asarray(ids.offsets)].tolist()
    texts = [spelled[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
    return pa.array([t if ok else None for t, ok in zip(texts, ids.is_valid().to_pylist())], pa.string())


def decode(ids: Column, tokenizer: str | None = None) -> Column:
    """The text that an array of ids spells, added tokens included.

    Bytes that are no UTF-8 become U+FFFD. Ids that the vocabulary lacks, and null ones, spell nothing;
    a null array stays null.
    """

    @F.arrow_udf("string")
    def spell(values: pa.Array) -> pa.Array:
        return _decoded(values, _spellings(tokenizer))

    return spell(ids)
