"""Cost-balanced packing of documents into fixed-length token sequences.

A sequence of pieces with lengths l costs ``LINEAR * sum(l) + QUADRATIC * sum(l * l)``:
every token passes the feed-forward layers once, and attends within its own piece.
Pieces are dealt in descending order, each to the sequence that costs least
so far among those with enough token capacity left; a piece that fits nowhere is
cut to fill the emptiest sequences. Documents longer than a sequence are first cut
into full sequences and a rest.

Row-local and streaming: a task gathers documents up to ``GROUP_TOKENS`` tokens,
packs them and lets them go, so memory doesn't depend on the partition, and there
is no shuffle. Within a group all sequences are full but for the last tokens, which
form sequences of power-of-two lengths that need no padding either. A sequence's id
holds its partition's number, and a repeated task gives the same rows again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from ..session import ship_package
from .common import doc_columns

SEQUENCE = 1024
#: Relative cost of a token by itself and of a pair of tokens that attend to one another.
LINEAR, QUADRATIC = 1.0, 1.0 / 512
#: Tokens of the documents that are packed together.
GROUP_TOKENS = 2_000_000
#: The id that ends each document.
END = 0
#: Sequence ids of a partition start at its number times this.
PER_PARTITION = 1 << 33

COLUMNS = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
           "offset bigint")


class DocumentIds:
    """ids of a byte-level BPE file; ``ranks`` is the same vocabulary for the faster library,
    which is used wherever a text holds none of the file's special strings."""

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        self.exact = Tokenizer.from_file(path)
        self.exact.no_padding()
        self.exact.no_truncation()
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            from tiktoken.load import load_tiktoken_bpe

            self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=load_tiktoken_bpe(ranks), special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        ids = None
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                ids = self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # its pattern gives up on very long runs of white space
                pass
        if ids is None:
            ids = self.exact.encode(text, add_special_tokens=False).ids
        return np.append(np.asarray(ids, "<u4"), np.uint32(END)).astype("<u4")


@lru_cache(maxsize=2)
def document_ids(path: str, ranks: str | None, pattern: str | None) -> DocumentIds:
    return DocumentIds(path, ranks, pattern)


def powers(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack(lengths: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths.

    The sequences are full, and the last ones have power-of-two lengths.
    """
    total = sum(lengths)
    rest = [(n % SEQUENCE, d) for d, n in enumerate(lengths) if n % SEQUENCE]
    whole = [(d, k * SEQUENCE) for d, n in enumerate(lengths) for k in range(n // SEQUENCE)]
    out = [(d, start, SEQUENCE, s, 0) for s, (d, start) in enumerate(whole)]
    sizes = [SEQUENCE] * (total // SEQUENCE - len(whole)) + powers(total % SEQUENCE)
    room, cost = np.array(sizes, np.int64), np.zeros(len(sizes))
    used = np.zeros(len(sizes), np.int64)

    def put(d: int, start: int, n: int, s: int) -> None:
        out.append((d, start, n, len(whole) + s, int(used[s])))
        used[s] += n
        room[s] -= n
        cost[s] += LINEAR * n + QUADRATIC * n * n

    for n, d in sorted(rest, key=lambda x: (-x[0], x[1])):
        start = lengths[d] - n
        while n:
            fits = np.flatnonzero(room >= n)
            s = fits[cost[fits].argmin()] if len(fits) else room.argmax()
            take = min(n, int(room[s]))
            put(d, start, take, int(s))
            start, n = start + take, n - take
    return out


def _packed(batches: Iterator[pa.RecordBatch], path: str, ranks: str | None, pattern: str | None,
            schema: StructType, group_tokens: int) -> Iterator[pa.RecordBatch]:
    encode, arrow = document_ids(path, ranks, pattern), to_arrow_schema(schema)
    sequence = TaskContext.get().partitionId() * PER_PARTITION
    ids: list[int | None] = []
    tokens: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal sequence, ids, tokens, held
        pieces = pack([len(t) for t in tokens])
        columns = zip(*[(ids[d], start, n, crc32(tokens[d][start:start + n].tobytes()), len(tokens[d]), sequence + s, offset)
                        for d, start, n, s, offset in pieces])
        sequence += max(p[3] for p in pieces) + 1
        ids, tokens, held = [], [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(doc_id)
            tokens.append(encode(text or ""))
            held += len(tokens[-1])
            if held >= group_tokens:
                yield flush()
    if ids:
        yield flush()


def pack_documents(docs: DataFrame, path: str, ranks: str | None = None, pattern: str | None = None,
                   group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path``: a byte-level tokenizers JSON file; ``ranks`` and ``pattern``: optionally the same
    vocabulary as a rank file. A null or empty text is its end id alone; null doc_ids and repeated
    rows are packed like any other; an empty table gives no pieces; other columns are not read.
    """
    ship_package(docs.sparkSession)
    schema = StructType.fromDDL(COLUMNS)
    return doc_columns(docs).mapInArrow(
        partial(_packed, path=path, ranks=ranks, pattern=pattern, schema=schema, group_tokens=group_tokens), schema)
