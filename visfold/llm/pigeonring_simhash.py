"""Near-duplicate documents by SimHash, with candidates from pigeonring filtering.

A 64-bit fingerprint is a ring of ``SEGMENTS`` segments. If two fingerprints differ in at most
t bits, then from some segment on every chain of l consecutive segments differs in at
most l * t / SEGMENTS bits altogether. While that budget is below one the chain must be equal,
and while it is below two it holds one difference at most, so that one half of that
part is equal too. Those equal bits are the key of an equi-join: fingerprints meet only
where a chain can begin, and are then held to all budgets of the chain, and at last
to the full distance.

Scale: exact copies collapse to one fingerprint first. Keys are dealt and sorted by
Spark; a task reads its sorted keys as a stream and holds one group at a time. Within a group
only the links of a spanning forest are returned, never all pairs. A group of more than
``GROUP`` fingerprints is dealt anew by further equal bits (of the open bits cut into t + 1
parts one must be equal), which ends after a few rounds: with 14 open bits a group can't be
larger than that, and one with no more open bits than t is compared as it is. No candidate is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import checkpointed, fresh_name, map_texts
from .components import connected_components

SHINGLE_WORDS, MAX_DISTANCE, SEED = 3, 3, 42
BITS, SEGMENTS = 64, 16
#: Fingerprints of one key that a task compares at once.
GROUP = 8192
_ROWS = "key bigint, mask bigint, fp bigint"


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: str, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of a whole text as an unsigned integer; 0 without words."""
    words = text.encode().lower().split()  # of bytes: only A-Z, and only ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[min(words_per_shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        ones += np.unpackbits(hashes[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _make(words_per_shingle: int):
    def rows(texts: list[str | None]):
        found = np.array([fingerprint(t or "", words_per_shingle) for t in texts], np.uint64)
        return [pa.array(found.view(np.int64))]
    return rows


# -------------------------------------------------------------------- pigeonring

def chain_budgets(distance: int) -> list[tuple[int, int]]:
    """(bits of the longest chain with this budget, budget), for budgets 0 to distance."""
    width = BITS // SEGMENTS
    return [(max([l for l in range(SEGMENTS + 1) if l * distance // SEGMENTS <= b]) * width, b) for b in range(distance + 1)]


def _ring_mask(first: int, last: int, start: int) -> int:
    """Bits first to last (from the top) of the ring as read from segment ``start``."""
    out = 0
    for k in range(first, last):
        out |= 1 << (BITS - 1 - (k + start * (BITS // SEGMENTS)) % BITS)
    return out


def chain_masks(distance: int) -> list[tuple[int, int]]:
    """(start, mask of the bits that must be equal): two per start, one for each half of
    the part in which a single difference is allowed."""
    budgets = chain_budgets(distance)
    equal = budgets[0][0]
    if distance == 0:
        return [(0, (1 << BITS) - 1)]
    longer = budgets[1][0]
    half = (equal + longer) // 2
    return [(s, _ring_mask(0, equal, s) | part) for s in range(SEGMENTS)
            for part in (_ring_mask(equal, half, s), _ring_mask(half, longer, s))]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def _key(fps: np.ndarray, mask: np.ndarray | np.uint64, start: np.ndarray | np.uint64) -> np.ndarray:
    """64 bits from the masked bits; the lowest four are the chain's first segment."""
    return _mix(_mix(fps & mask) ^ mask) & ~np.uint64(15) | start


def _batch(key, mask, fp) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key, mask, fp)], names=["key", "mask", "fp"])


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _first_keys(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    masks = chain_masks(distance)
    for batch in batches:
        fps = _unsigned(batch.column(0))
        for start, mask in masks:
            m = np.full(len(fps), mask, np.uint64)
            yield _batch(_key(fps, m, np.uint64(start)), m, fps)


def _finer_keys(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Keys with more equal bits, for groups that were too large."""
    for batch in batches:
        keys, masks, fps = (_unsigned(c) for c in batch.columns)
        for mask in np.unique(masks):
            own = masks == mask
            open_bits = [b for b in range(BITS) if not int(mask) >> b & 1]
            for part in np.array_split(open_bits, distance + 1):
                finer = int(mask)
                for b in part.tolist():
                    finer |= 1 << b
                m = np.full(int(own.sum()), finer, np.uint64)
                yield _batch(_key(fps[own], m, keys[own] & np.uint64(15)), m, fps[own])


def linked(x: np.ndarray, start: np.ndarray | np.uint64, budgets: list[tuple[int, int]]) -> np.ndarray:
    """Do differences ``x`` keep to all budgets of the chain from ``start``, the last being the full
    distance? A cumulative count only grows, so the longest chain of each budget tells for the others."""
    turn = np.uint64(BITS // SEGMENTS) * np.asarray(start, np.uint64)
    x = np.where(turn > 0, x << turn | x >> (np.uint64(BITS) - turn) % np.uint64(BITS), x)
    ok = np.ones(x.shape, bool)
    for bits, budget in budgets:
        head = x >> np.uint64(BITS - bits) if bits else np.zeros_like(x)
        ok &= np.bitwise_count(head) <= budget
    return ok


def spanning_links(fps: np.ndarray, start: np.uint64, budgets) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest of one group: each newly reached fingerprint is compared
    with those not reached so far."""
    left, out = fps, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            near = linked(left ^ one, start, budgets)
            if near.any():
                found, left = left[near], left[~near]
                out.append((np.full(len(found), one, np.uint64), found))
                queue.extend(found)
    return out


def _links(batches: Iterator[pa.RecordBatch], distance: int, group: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: links (mask 0: key and fp are the two ends), and the rows of
    groups that are too large, as they came."""
    budgets = chain_budgets(distance)
    none = np.zeros(0, np.uint64)
    held = (none, none, none)
    large: np.uint64 | None = None  # the key whose rows are passed on

    def link_rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return _batch(a, np.zeros(len(a), np.uint64), b)

    def compare(keys, fps):
        edge = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        firsts, lasts = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
        two = firsts[lasts - firsts == 2]
        if len(two):
            a, b = fps[two], fps[two + 1]
            ok = linked(a ^ b, keys[two] & np.uint64(15), budgets)
            yield a[ok], b[ok]
        for i in np.flatnonzero(lasts - firsts > 2):
            yield from spanning_links(fps[firsts[i]:lasts[i]], keys[firsts[i]] & np.uint64(15), budgets)

    def links_of(keys, fps):
        found = list(compare(keys, fps)) if len(keys) > 1 else []
        if found:
            a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            if len(a):
                yield link_rows(a, b)

    for batch in batches:
        new = tuple(_unsigned(c) for c in batch.columns)
        if not len(new[0]):
            continue
        if large is not None:
            more = int(np.searchsorted((new[0] != large).astype(np.int8), 1))
            if more:
                yield _batch(*(x[:more] for x in new))
            new = tuple(x[more:] for x in new)
            if not len(new[0]):
                continue
            large = None
        rows = tuple(np.concatenate([h, n]) for h, n in zip(held, new))
        # the last group may go on in the next batch
        tail = len(rows[0]) - int(np.searchsorted((rows[0][::-1] != rows[0][-1]).astype(np.int8), 1))
        keys = rows[0][:tail]
        edge = np.flatnonzero(keys[1:] != keys[:-1]) + 1 if len(keys) else np.zeros(0, np.int64)
        sizes = np.diff(np.concatenate([[0], edge, [tail]])) if tail else np.zeros(0, np.int64)
        over = np.repeat(sizes > group, sizes) & (BITS - np.bitwise_count(rows[1][:tail]) > distance)
        if over.any():
            yield _batch(*(x[:tail][over] for x in rows))
        yield from links_of(keys[~over], rows[2][:tail][~over])
        held = tuple(x[tail:] for x in rows)
        if len(held[0]) > group and BITS - int(held[1][0]).bit_count() > distance:
            yield _batch(*held)
            large, held = held[0][0], (none, none, none)
    yield from links_of(held[0], held[2])


def fingerprint_links(fps: DataFrame, distance: int = MAX_DISTANCE, group: int = GROUP) -> DataFrame:
    """Links (a, b) that join distinct fingerprints (column ``fp``) within the distance, enough of them
    to connect all that are connected."""
    ship_package(fps.sparkSession)
    rows = fps.select("fp").mapInArrow(partial(_first_keys, distance=distance), _ROWS)
    links = None
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key", "fp")
        out = checkpointed(dealt.mapInArrow(partial(_links, distance=distance, group=group), _ROWS))
        found = out.filter("mask = 0").select(F.col("key").alias("a"), F.col("fp").alias("b"))
        links = found if links is None else links.union(found)
        rest = out.filter("mask <> 0")
        if rest.isEmpty():
            return links
        rows = rest.mapInArrow(partial(_finer_keys, distance=distance), _ROWS)


def _members(sketch: DataFrame, distance: int) -> DataFrame:
    """fp, component (one of its fingerprints) of every distinct fingerprint."""
    fps = sketch.select(F.col("fingerprint").alias("fp")).distinct()
    labels = connected_components(fingerprint_links(fps, distance))
    found = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    return found.select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (signed 64-bit), component_id (smallest doc_id reachable) per document.

    Null and empty texts, and those without a word, have fingerprint 0 and are linked like any
    other. A null doc_id is no candidate for the smallest; a component of such ids alone has a null
    component_id. Repeated rows each give a row; other columns are not read.
    """
    sketch = checkpointed(map_texts(docs, partial(_make, words_per_shingle), "fingerprint bigint"))
    fps = sketch.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first_id"))
    members = fps.join(_members(sketch, distance), "fp")
    ids = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = members.join(ids, "component").select(F.col("fp").alias("fingerprint"), "component_id")
    return sketch.join(by_fp, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _make_named(words_per_shingle: int):
    sketch = _make(words_per_shingle)

    def rows(texts: list[str | None]):
        # as Spark's xxhash64 of the text
        digests = np.array([SEED if t is None else xxhash.xxh64_intdigest(t, SEED) for t in texts], np.uint64)
        return [*sketch(texts), pa.array(digests.view(np.int64))]
    return rows


def one_per_group(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """One document of every group of near duplicates, with all its columns: that with the smallest
    doc_id, ties to the smaller hash of the text; a row without a doc_id only where none has one.

    Every row belongs to its own text's group, whatever other rows share its doc_id. Rows that repeat
    both doc_id and text are one document, of which one row stays. An empty table gives no rows.
    """
    sketch = checkpointed(map_texts(docs, partial(_make_named, words_per_shingle), "fingerprint bigint, digest bigint"))
    unnamed, number = F.col("doc_id").isNull(), F.coalesce(F.col("doc_id"), F.lit(0)).cast("bigint")
    first = F.min(F.struct(unnamed.alias("unnamed"), number.alias("number"), F.col("digest").alias("digest")))
    grouped = sketch.join(_members(sketch, distance).withColumnRenamed("fp", "fingerprint"), "fingerprint")
    chosen = grouped.groupBy("component").agg(first.alias("first")).select("first.*").distinct()
    names = [fresh_name(docs, n) for n in ("unnamed", "number", "digest")]
    keyed = docs.withColumns(dict(zip(names, [unnamed, number, F.xxhash64(F.col("text").cast("string"))])))
    kept = keyed.join(checkpointed(chosen.toDF(*names)), names, "left_semi")
    return kept.dropDuplicates(names).select(*docs.columns)
