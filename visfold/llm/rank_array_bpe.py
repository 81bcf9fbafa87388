"""Byte-pair encoding with contiguous rank arrays, and decoding.

Every short word is a row of adjacent arrays: its parts, and the merge rank of
each pair of neighbours. The lowest rank of the row is found by a scan, the
boundary inside that pair is deleted (the parts behind it move one place to
the left), and the ranks of the two neighbouring pairs are looked up anew, until
no pair has a rank. Rows of equal width are stacked, so that one step scans
and merges thousands of words with numpy. Words longer than ``LONG`` parts would
make the repeated scan quadratic; they merge through a heap over a linked list
instead, with the same order (lowest rank first, leftmost on ties).

Documents are split at white space; each distinct chunk is normalised, split
into words and encoded once per worker, and its ids and decoded text are kept in
a bounded table; so are those of each word, which many chunks share. Row-local: no shuffle.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial
from hashlib import sha256
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import map_texts

#: Parts beyond which a word merges through a heap.
LONG = 64
#: Chunks that a worker keeps; when full, the table starts anew.
KEPT_CHUNKS = 800_000
#: Words that a worker keeps, as many chunks hold the same word; bytes and texts that are encoded together.
KEPT_WORDS = 400_000
TOGETHER = 4_000_000, 4096
NO_RANK = np.int32(2 ** 31 - 1)
#: A part that has merged into the one before it. (No id is so low: a letter without one is -1.)
_GONE = -2
#: ASCII separators that ``str.split()`` cuts at although they are no Unicode white space.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {}, 256
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b], spare = chr(spare), spare + 1
    return [letters[b] for b in range(256)]


class PairRanks:
    """(left id, right id) -> (rank, merged id), as an open-addressing table in numpy."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        self.merged = np.zeros(1 << bits, np.int32)
        left = np.array([p[0] for p in pairs], np.int64)
        right = np.array([p[1] for p in pairs], np.int64)
        keys, slots = left << 32 | right, self._slot(left << 32 | right)
        self.probes = 1
        for key, slot, (rank, merged) in zip(keys.tolist(), slots.tolist(), pairs.values()):
            tried = 1
            while self.keys[slot] >= 0:
                slot, tried = (slot + 1) & self.mask, tried + 1
            self.keys[slot], self.ranks[slot], self.merged[slot] = key, rank, merged
            self.probes = max(self.probes, tried)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of each pair; NO_RANK where it doesn't merge."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slots = self._slot(keys)
        rank, merged = np.full(keys.shape, NO_RANK, np.int32), np.zeros(keys.shape, np.int32)
        todo = np.flatnonzero(np.ones(keys.shape, bool).ravel())
        flat_rank, flat_merged, keys, slots = rank.ravel(), merged.ravel(), keys.ravel(), slots.ravel()
        for _ in range(self.probes):
            there = self.keys[slots[todo]]
            hit = there == keys[todo]
            at = todo[hit]
            flat_rank[at], flat_merged[at] = self.ranks[slots[at]], self.merged[slots[at]]
            todo = todo[~hit & (there >= 0)]
            if not len(todo):
                break
            slots[todo] = (slots[todo] + 1) & self.mask
        return flat_rank.reshape(rank.shape), flat_merged.reshape(rank.shape)


def merge_rows(parts: np.ndarray, table: PairRanks) -> tuple[np.ndarray, np.ndarray]:
    """Encode words of one width: ``parts`` [words, width] of ids -> (parts, lengths).

    Each step deletes one boundary in every word that still has a pair with a rank.
    """
    n, width = parts.shape
    lengths = np.full(n, width)
    if width < 2:
        return parts, lengths
    parts = parts.copy()
    ranks, _ = table.find(parts[:, :-1], parts[:, 1:])
    live = np.flatnonzero(ranks.min(axis=1) < NO_RANK)
    while len(live):
        at = ranks[live].argmin(axis=1)  # the leftmost of the lowest
        _, merged = table.find(parts[live, at], parts[live, at + 1])
        # delete the boundary: what stands behind it moves one place to the left
        columns = np.arange(width)
        take = np.minimum(columns + (columns > at[:, None]), width - 1)
        rows = np.take_along_axis(parts[live], take, 1)
        rows[np.arange(len(live)), at] = merged
        columns = np.arange(width - 1)
        take = np.minimum(columns + (columns > at[:, None]), width - 2)
        near = np.take_along_axis(ranks[live], take, 1)
        lengths[live] -= 1
        size = lengths[live]
        near[columns >= (size - 1)[:, None]] = NO_RANK
        # refresh the two neighbouring ranks
        for side in (-1, 0):
            j = at + side
            ok = np.flatnonzero((j >= 0) & (j + 1 < size))
            if len(ok):
                near[ok, j[ok]] = table.find(rows[ok, j[ok]], rows[ok, j[ok] + 1])[0]
        parts[live], ranks[live] = rows, near
        live = live[near.min(axis=1) < NO_RANK]
    return parts, lengths


def merge_long(parts: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same merges for one long word: a heap of (rank, place), as one number, over a list linked by arrays."""
    n = len(parts)
    parts, before, after = array("i", parts), array("i", range(-1, n - 1)), array("i", range(1, n + 1))
    heap = [pairs[p][0] << 32 | i for i in range(n - 1) if (p := (parts[i], parts[i + 1])) in pairs]
    heapq.heapify(heap)
    while heap:
        at = heapq.heappop(heap)
        rank, i = at >> 32, at & 0xFFFFFFFF
        j = after[i]
        if j >= n or (found := pairs.get((parts[i], parts[j]))) is None or found[0] != rank:
            continue  # one of the two has merged since
        parts[i], parts[j], after[i] = found[1], _GONE, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (p := (parts[a], parts[b])) in pairs:
                heapq.heappush(heap, pairs[p][0] << 32 | a)
    return [p for p in parts if p != _GONE]


class WordBpe:
    """The encoder of a tokenizers JSON file of this kind: NFC, lower case, white space dropped,
    words by pattern, byte letters, word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.plain_words = regex.compile(split)
        # beyond Latin, which letters there are is a matter of the library's Unicode version
        self.any_words = pre_tokenizers.Split(Regex(split), "removed", invert=True)
        self.any_normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # pieces without an id drop out of the ids, as there is no unknown token
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.first = np.array([vocab.get(c, -1) for c in letters], np.int32)
        self.last = np.array([vocab.get(c + self.end, -1) for c in letters], np.int32)
        self.pairs = {}
        for rank, (a, b) in enumerate(model["merges"]):
            if a in vocab and b in vocab and a + b in vocab:
                self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.table = PairRanks(self.pairs)
        self.words: dict[str, tuple[bytes, str]] = {}
        # of each chunk: its ids, and their decoding with a space after each token
        self.chunk_ids: dict[str, bytes] = {}
        self.chunk_text: dict[str, str] = {}

    def words_of(self, chunk: str) -> list[str]:
        """The normalised words of a chunk without white space."""
        if max(chunk) < "\u0300":  # below the combining marks nothing composes and no letter is in doubt
            return self.plain_words.findall(chunk.lower())
        return [w for w, _ in self.any_words.pre_tokenize_str(self.any_normal.normalize_str(chunk))]

    def encode_words(self, words: list[str]) -> dict[str, tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each distinct word."""
        out: dict[str, tuple[bytes, str]] = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            data = word.encode()
            by_width.setdefault(len(data), []).append((word, data))
        for width, group in by_width.items():
            data = np.frombuffer(b"".join(d for _, d in group), np.uint8).reshape(-1, width)
            parts = self.first[data]
            parts[:, -1] = self.last[data[:, -1]]
            if width > LONG:
                rows = [merge_long(row, self.pairs) for row in parts.tolist()]
            else:
                merged, lengths = merge_rows(parts, self.table)
                rows = [row[:n] for row, n in zip(merged.tolist(), lengths.tolist())]
            for (word, _), row in zip(group, rows):
                ids = [i for i in row if i >= 0]
                out[word] = (array("I", ids).tobytes(), "".join([self.tokens[i] + " " for i in ids]))
        return out

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks that the tables lack."""
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        split = {c: self.words_of(c) for c in chunks}
        self.words.update(self.encode_words(list(set(chain.from_iterable(split.values())) - self.words.keys())))
        for chunk, words in split.items():
            found = [self.words[w] for w in words]
            self.chunk_ids[chunk] = b"".join([f[0] for f in found])
            self.chunk_text[chunk] = "".join([f[1] for f in found])

    def chunks(self, text: str) -> list[str]:
        if any(c in text for c in _NOT_SPACE):
            return regex.findall(r"\S+", text)
        return text.split()

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each whole text. The decoding of a
        file without a decoder: the tokens, a space between them."""
        cut: list[list[str]] = []
        special: dict[int, list[str]] = {}  # texts with special strings: every second piece is one
        for n, text in enumerate(texts):
            if any(t in text for t in self.special):
                special[n] = self.at_special.split(text)
                cut.append([c for piece in special[n][::2] for c in self.chunks(piece)])
            else:
                cut.append(self.chunks(text))
        if len(self.chunk_ids) > KEPT_CHUNKS:
            self.chunk_ids.clear()
            self.chunk_text.clear()
        self.learn(list(set(chain.from_iterable(cut)) - self.chunk_ids.keys()))
        out = []
        for n, chunks in enumerate(cut):
            if n not in special:
                out.append((b"".join(map(self.chunk_ids.__getitem__, chunks)), "".join(map(self.chunk_text.__getitem__, chunks))[:-1]))
                continue
            ids, text = b"", ""
            for i, piece in enumerate(special[n]):
                if i % 2:
                    ids, text = ids + array("I", [self.special[piece]]).tobytes(), text + piece + " "
                else:
                    own = self.chunks(piece)
                    ids, text = ids + b"".join(map(self.chunk_ids.__getitem__, own)), text + "".join(map(self.chunk_text.__getitem__, own))
            out.append((ids, text[:-1]))
        return out


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def parts_of(texts: list[str | None]) -> Iterator[list[str]]:
    """Bounded parts of a batch; a longer text is one by itself."""
    held, size = [], 0
    for text in texts:
        if held and (size + len(text or "") > TOGETHER[0] or len(held) >= TOGETHER[1]):
            yield held
            held, size = [], 0
        held.append(text or "")
        size += len(text or "")
    if held:
        yield held


def _make(path: str):
    bpe = word_bpe(path)

    def rows(texts: list[str | None]):
        n_tokens, ids_hash, text_hash = [], [], []
        for part in parts_of(texts):
            for ids, text in bpe.encode(part):
                n_tokens.append(len(ids) // 4)
                ids_hash.append(sha256(ids).hexdigest())
                text_hash.append(sha256(text.encode()).hexdigest())
        return n_tokens, ids_hash, text_hash
    return rows


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: n_tokens, ids_sha256 and decoded_sha256 of its whole text.

    ``path``: a tokenizers JSON file that every executor can read. A null text counts as empty
    (no ids); null doc_ids and repeated rows keep their rows; other columns are not read.
    """
    return map_texts(docs, partial(_make, path), "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
