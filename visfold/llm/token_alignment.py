"""Alignment of two tokenizers over the same texts.

A byte-level vocabulary (A) and a piece vocabulary (B) cut the same bytes (a space and the text)
into tokens. Where both cut, a group ends. The sorted end offsets are intersected by galloping: each
end of the shorter list probes the longer one at distances 1, 2, 4, .. and then halves the last
stride. Common places slice both lists into groups, and the differences of their ranks say how many
tokens of each side a group holds. All A-B pairs within a group are links.

Ends of many documents are searched at once: their bytes are numbered through, so that both end lists
stay sorted, and numpy takes each probing step for all ends together, starting where an earlier
end of the same document (every 64th first, then every 16th, ..) was found.

Scale: a task turns documents into blocks of about ``BLOCK_BYTES`` of text and counts each block's
distinct id pairs, so what Spark shuffles are pairs per block, not per token. Counts are summed per pair,
joined back to the blocks and dealt by block; a block's links never leave its row. Pairs that
every document holds are one row per block.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import scratch_path, ship_package
from .common import doc_columns, map_texts

#: Bytes of text whose documents form a block; a longer document is a block by itself.
BLOCK_BYTES = 4_000_000
#: One end in so many is searched from its document's start; the next ones from there, ever closer.
STRIDES = (64, 16, 4, 1)
#: Letters of the words whose ids are kept.
KEPT_LETTERS = 3_000_000
#: Links that are spelled out at once.
LINKS = 2_000_000
#: Blocks of a partition start at its number times this.
PER_PARTITION = 1 << 33
#: A space between two letters or signs: neither vocabulary has a token across its left side.
_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Letters that both regular expression libraries of the byte vocabulary surely class alike.
_UNSURE = re.compile("[^\x00-˿‐-‧€]")

_DOC_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCKS = "block bigint, payload binary, keys array<bigint>, held array<int>"
COLUMNS = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
           "groups_sha256 string")


def byte_alphabet() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Both vocabularies: ids of a text, and the bytes of each id."""

    def __init__(self, bytes_path: str, ranks: str | None, pattern: str | None, pieces_path: str):
        self.exact = Tokenizer.from_file(bytes_path)
        self.exact.no_padding()
        self.exact.no_truncation()
        self.exact.encode_special_tokens = True
        self.fast = None
        if ranks:
            from tiktoken.load import load_tiktoken_bpe

            self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=load_tiktoken_bpe(ranks), special_tokens={})
        alphabet = byte_alphabet()
        vocabulary = self.exact.get_vocab(with_added_tokens=True)
        special = {t.content for t in self.exact.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                        for p in (self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size()))]
        self.a_size = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_size = np.array([len(b) for b in self.b_bytes], np.int64)
        self.split = self.fast is not None and not any(re.search("[^▁]▁", self.pieces.id_to_piece(i)) for i in range(len(self.b_bytes)))
        self.forget()
        # decimal ids followed by each separator of the groups' spelling
        self.spelled = [str(i) + s for s in (",", "|", ";", "") for i in range(max(len(self.a_bytes), len(self.b_bytes)))]

    def encode_a(self, text: str) -> list[int]:
        if self.fast is not None and not _UNSURE.search(text):
            try:
                return self.fast.encode_ordinary(text)
            except ValueError:  # its pattern gives up on very long runs of white space
                pass
        return self.exact.encode(text, add_special_tokens=False).ids

    def forget(self) -> None:
        """Of each known word: its number; ids of A and of B, one after another; how many; are they its bytes?"""
        self.number: dict[str, int] = {}
        self.ids, self.sizes, self.alike = (array("q"), array("q")), (array("q"), array("q")), array("b")
        self.letters = 0

    def learn(self, words: list[str]) -> None:
        """Keep the ids of these words, with a space before each."""
        for word, b in zip(words, self.pieces.encode(words, num_threads=1)):
            a, want = self.encode_a(" " + word), b" " + word.encode()
            self.number[word] = len(self.number)
            self.alike.append(b"".join(map(self.b_bytes.__getitem__, b)) == want == b"".join(map(self.a_bytes.__getitem__, a)))
            for side, found in enumerate((a, b)):
                self.ids[side].extend(found)
                self.sizes[side].append(len(found))
            self.letters += len(word)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: ids of all texts, and how many each text has; none if the ids of either do
        not spell the bytes of a space and the text."""
        if self.letters > KEPT_LETTERS:
            self.forget()
        cut = [(_SPACE.split(t) if self.split else [t]) if t else [] for t in texts]
        self.learn([w for w in set(chain.from_iterable(cut)) if w not in self.number])
        words = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        strange = np.bincount(doc[np.array(self.alike, bool)[words] == 0], minlength=len(texts)) > 0
        words, doc = words[~strange[doc]], doc[~strange[doc]]
        out = []
        for ids, sizes in zip(self.ids, self.sizes):
            size = np.array(sizes, np.int64)
            begin = np.cumsum(size) - size
            here = size[words]
            at = np.arange(int(here.sum())) + np.repeat(begin[words] - (np.cumsum(here) - here), here)
            out.append((np.array(ids, np.int64)[at], _sums(here, doc, len(texts))))
        return out


@lru_cache(maxsize=2)
def tokens_of(bytes_path: str, ranks: str | None, pattern: str | None, pieces_path: str) -> Tokens:
    return Tokens(bytes_path, ranks, pattern, pieces_path)


# --------------------------------------------------------------------- galloping

def gallop(ends: np.ndarray, longer: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The first place at or after ``start`` where ``longer`` (sorted) is not below each end.

    No end may lie above the last of ``longer``.
    """
    low, last = start.copy(), len(longer) - 1  # all before low are below the end
    high, stride = np.minimum(low, last), 1
    going = np.flatnonzero(longer[high] < ends)
    while len(going):
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + stride, last)
        stride *= 2
        going = going[longer[high[going]] < ends[going]]
    while len(going := np.flatnonzero(low < high)):
        middle = (low[going] + high[going]) >> 1
        below = longer[middle] < ends[going]
        low[going] = np.where(below, middle + 1, low[going])
        high[going] = np.where(below, high[going], middle)
    return low


def _found(shorter: np.ndarray, first: np.ndarray, count: np.ndarray, longer: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``shorter`` and ``longer`` with equal ends, for documents whose ends in ``shorter`` are
    ``count`` from ``first``, and begin at ``start`` in ``longer``."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    at, begin = np.repeat(first, count) + rank, np.repeat(start, count)
    place = begin
    for wide, stride in zip((None, *STRIDES), STRIDES):
        now = np.flatnonzero(rank % stride == 0)
        if wide:  # from where the last end of the wider stride was found
            begin = place[now - rank[now] % wide]
        place[now] = gallop(shorter[at[now]], longer, begin[now] if wide is None else begin)
    same = longer[place] == shorter[at]
    return at[same], place[same]


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray, a_count: np.ndarray, b_count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in A and in B of the ends that both have. The ends of all documents are numbered through;
    a document's shorter list drives the search."""
    a_first, b_first = np.cumsum(a_count) - a_count, np.cumsum(b_count) - b_count
    by_a = a_count <= b_count
    ia, ib = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    at, place = _found(a_ends, a_first[by_a], a_count[by_a], b_ends, b_first[by_a])
    ia[at], ib[place] = True, True
    at, place = _found(b_ends, b_first[~by_a], b_count[~by_a], a_ends, a_first[~by_a])
    ib[at], ia[place] = True, True
    return np.flatnonzero(ia), np.flatnonzero(ib)


class Aligned:
    """Groups and links of some documents' tokens."""

    def __init__(self, tokens: Tokens, texts: list[str | None]):
        self.tokens, self.width = tokens, len(tokens.b_bytes)
        (self.a, self.a_count), (self.b, self.b_count) = tokens.encode(texts)
        ia, ib = common_ends(np.cumsum(tokens.a_size[self.a]), np.cumsum(tokens.b_size[self.b]), self.a_count, self.b_count)
        self.a_from, self.b_from = np.append(0, ia + 1), np.append(0, ib + 1)
        self.na, self.nb = np.diff(self.a_from), np.diff(self.b_from)  # tokens of each group
        self.doc = np.repeat(np.arange(len(texts)), self.a_count)[ia] if len(ia) else np.zeros(0, np.int64)
        self.groups = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.links = _sums(self.na * self.nb, self.doc, len(texts))

    def spelled(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per document."""
        n = len(self.tokens.spelled) // 4
        size = self.na + self.nb
        begin = np.cumsum(size) - size
        ids = np.empty(int(size.sum()), np.int64)
        ids[np.arange(len(self.a)) + np.repeat(begin - self.a_from[:-1], self.na)] = self.a
        ids[np.arange(len(self.b)) + np.repeat(begin + self.na - self.b_from[:-1], self.nb)] = self.b
        ids[begin + self.na - 1] += n
        ids[begin + size - 1] += 2 * n
        ends = np.cumsum(self.a_count + self.b_count)
        ids[ends[self.groups > 0] - 1] += n
        words = list(map(self.tokens.spelled.__getitem__, ids.tolist()))
        return ["".join(words[e - c:e]) for e, c in zip(ends.tolist(), (self.a_count + self.b_count).tolist())]

    def linked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, id pair, links) of every id pair that a document links; a pair is a * (ids of B) + b."""
        parts, links = [], self.na * self.nb
        upto = np.cumsum(links)
        first = 0
        while first < len(links):
            # as many groups as have LINKS links, and one at least
            last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + LINKS, "right")))
            parts += self._slice(first, last) if last > first + 1 else self._single(first)
            first = last
        if not parts:
            return (np.zeros(0, np.int64),) * 3
        codes, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        if len(parts) > 1:
            codes, where = np.unique(codes, return_inverse=True)
            counts = _sums(counts, where, len(codes))
        pairs = len(self.tokens.a_bytes) * self.width
        return codes // pairs, codes % pairs, counts

    def _code(self, doc, a, b):
        return (doc * len(self.tokens.a_bytes) + a) * self.width + b

    def _slice(self, first: int, last: int):
        links = (self.na * self.nb)[first:last]
        group = np.repeat(np.arange(first, last), links)
        k = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        a, b = self.a[self.a_from[group] + k // self.nb[group]], self.b[self.b_from[group] + k % self.nb[group]]
        return [np.unique(self._code(self.doc[group], a, b), return_counts=True)]

    def _single(self, g: int):
        """A group by itself, from its distinct ids; some of A at a time."""
        a, a_times = np.unique(self.a[self.a_from[g]:self.a_from[g + 1]], return_counts=True)
        b, b_times = np.unique(self.b[self.b_from[g]:self.b_from[g + 1]], return_counts=True)
        step = max(1, LINKS // len(b))
        return [(self._code(self.doc[g], a[at:at + step, None], b).ravel(), (a_times[at:at + step, None] * b_times).ravel())
                for at in range(0, len(a), step)]


def _sums(values: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers per place."""
    out = np.zeros(n, np.int64)
    np.add.at(out, where, values)
    return out


# ------------------------------------------------------------------------ Spark

def _groups(tokens: dict):
    spell = tokens_of(**tokens)

    def rows(texts):
        return [Aligned(spell, [t]).spelled()[0] for t in texts],
    return rows


def aligned_groups(docs: DataFrame, bytes_path: str, pieces_path: str, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, groups (``a1,a2|b1;a3|b2,b3``: ids of A and B in order, '' without tokens) per document."""
    tokens = {"bytes_path": bytes_path, "ranks": ranks, "pattern": pattern, "pieces_path": pieces_path}
    return map_texts(docs, partial(_groups, tokens), "groups string")


def _blocks(batches: Iterator[pa.RecordBatch], tokens: dict, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """One row per block: its documents' numbers, digests and links (payload), its distinct pairs, and
    how many of its documents hold each."""
    vocabulary = tokens_of(**tokens)
    block = TaskContext.get().partitionId() * PER_PARTITION
    ids: list[int | None] = []
    texts: list[str | None] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal ids, texts, held, block
        found = Aligned(vocabulary, texts)
        doc, pair, links = found.linked()
        keys, place, docs_with = np.unique(pair, return_inverse=True, return_counts=True)
        head = {"ids": ids, "sha256": [sha256(s.encode()).hexdigest() if s else "" for s in found.spelled()],
                "n_a": found.a_count.tolist(), "n_b": found.b_count.tolist(), "n_groups": found.groups.tolist(),
                "n_links": found.links.tolist(), "pairs": np.bincount(doc, minlength=len(ids)).tolist()}
        # within a document pairs ascend: differences are short numbers
        step = np.diff(place, prepend=0).astype("<i4")
        raw = json.dumps(head).encode()
        raw = len(raw).to_bytes(8, "little") + raw + step.tobytes() + links.astype("<u4").tobytes()
        out = pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([zstandard.ZstdCompressor(level=1).compress(raw)], pa.binary()),
             pa.array([keys], pa.list_(pa.int64())), pa.array([docs_with.astype(np.int32)], pa.list_(pa.int32()))],
            names=["block", "payload", "keys", "held"])
        block, ids, texts, held = block + 1, [], [], 0
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            size = len(text) if text else 0
            if ids and held + size > block_bytes:
                yield flush()
            ids.append(doc_id)
            texts.append(text)
            held += size + 16
    if ids:
        yield flush()


def _scored(block: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one block, from its row and the corpus-wide count of each of its pairs."""
    types = [("doc_id", pa.int64()), *[(n, pa.int64()) for n in (*_DOC_NUMBERS, "n_best", "count_sum")], ("groups_sha256", pa.string())]
    if not block.num_rows:
        return pa.schema(types).empty_table()
    raw = zstandard.ZstdDecompressor().decompress(block.column("payload")[0].as_py())
    size = int.from_bytes(raw[:8], "little")
    head = json.loads(raw[8:8 + size])
    per_doc = np.array(head["pairs"], np.int64)
    n = int(per_doc.sum())
    place = np.cumsum(np.frombuffer(raw, "<i4", n, 8 + size).astype(np.int64))
    links = np.frombuffer(raw, "<u4", n, 8 + size + 4 * n).astype(np.int64)
    order = np.argsort(counts.column("key").to_numpy())  # the block's pairs were numbered in this order
    count, best = (counts.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    head["count_sum"] = _sums(links * count[place], doc, len(per_doc))
    head["n_best"] = _sums(links * best[place], doc, len(per_doc))
    head["doc_id"], head["groups_sha256"] = head["ids"], head["sha256"]
    return pa.table([pa.array(head[name], t) for name, t in types], names=[name for name, _ in types])


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """key, count (documents that link the pair), best (1: the highest count of its A id, ties included)."""
    pairs = blocks.select(F.explode(F.arrays_zip("keys", "held")).alias("p"))
    counts = pairs.groupBy(F.col("p.keys").alias("key")).agg(F.sum("p.held").alias("count")).withColumn("a", F.expr(f"key DIV {width}"))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return counts.join(highest, "a").select("key", "count", (F.col("count") == F.col("highest")).cast("int").alias("best"))


def align_documents(docs: DataFrame, bytes_path: str, pieces_path: str, ranks: str | None = None, pattern: str | None = None,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per document.

    ``bytes_path``: a byte-level tokenizers JSON file (A); ``ranks`` and ``pattern``: optionally the same
    vocabulary as a rank file; ``pieces_path``: a sentencepiece model that adds a space (B). Special
    strings in texts are plain text. A null or empty text, and one whose tokens do not spell its bytes,
    has no tokens: zeros and ''. Repeated rows are documents of their own, also in the counts; null
    doc_ids stay; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    tokens = {"bytes_path": bytes_path, "ranks": ranks, "pattern": pattern, "pieces_path": pieces_path}
    width = sentencepiece.SentencePieceProcessor(model_file=pieces_path).get_piece_size()
    path = scratch_path(spark, "alignment")
    doc_columns(docs).mapInArrow(partial(_blocks, tokens=tokens, block_bytes=block_bytes), _BLOCKS).write.parquet(path)
    blocks, again = spark.read.schema(_BLOCKS).parquet(path), spark.read.schema(_BLOCKS).parquet(path)
    asked = again.select("block", F.explode("keys").alias("key")).join(pair_counts(again, width), "key")
    return (blocks.select("block", "payload").groupBy("block")
            .cogroup(asked.select("block", "key", "count", "best").groupBy("block"))
            .applyInArrow(_scored, COLUMNS))
