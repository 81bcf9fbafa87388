"""Spelling variants: words one edit apart, found with variable-length grams.

A word gets one gram per position. It starts with ``QMIN`` letters and grows while it is frequent
among the distinct words, up to ``QMAX``; an end mark follows the last letter. The frequent grams are
the dictionary: everything below an infrequent one is pruned, so it never has more than
``NODES`` entries, whatever the vocabulary.

An edit only changes the grams that cover its place. The most grams that any single edit of a
word can change is the word's own bound, and two words one edit apart share all others, at the same
place or one further. So of each word's ``bound + 1`` rarest grams at least one is in both words' choice:
only those short lists are merged, by an equi-join on (gram, length of the word, place), and each
meeting of two words is verified by their edit distance. A list with more than ``LIST`` words is not
paired off; its words are dealt by what is left of them without one letter, which words
one edit apart always have in common and few other words share. No candidate is dropped.

Scale: texts become pre-aggregated word counts within tasks; all else works on distinct words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import checkpointed, doc_columns

MIN_CHARS, MIN_COUNT = 6, 5
#: A form is at least this many times as frequent as its variant.
RATIO = 5
#: Runs whose checksum this divides lose a letter.
TYPO_RATE = 199
#: Lengths of a gram; an edit changes QMAX grams at most, so every word of MIN_CHARS letters keeps one.
QMIN, QMAX = 2, 5
#: Most entries of the gram dictionary, and the least count of one.
NODES, FREQUENT = 200_000, 64
#: Longest list of words that are paired off.
LIST = 128
#: Distinct strings that a task counts before it passes them on.
HELD = 300_000
_RUNS = re.compile(r"[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_END = "$"
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


# ------------------------------------------------------------------- word counts

def document_words(doc_id: int | None, text: str | None, min_chars: int = MIN_CHARS) -> Counter:
    """Words of one document and how often each occurs, after the checksum has deleted letters."""
    runs = Counter(r for r in _RUNS.findall(text or "") if len(r) >= min_chars)
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        run = run.lower() if run.isascii() else run.translate(_LOWER)
        h = crc32(run.encode(), start)
        if h % TYPO_RATE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= min_chars:
            out[run] += n
    return out


def _counted(batches: Iterator[pa.RecordBatch], counts_of, name: str) -> Iterator[pa.RecordBatch]:
    """(name, n) rows from ``counts_of(row)``, added up within the task."""
    held: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=[name, "n"])
        held.clear()
        return out

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            for key, n in counts_of(*row).items():
                held[key] += n
            if len(held) >= HELD:
                yield flush()
    if held:
        yield flush()


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: distinct words of at least so many letters and occurrences."""
    ship_package(docs.sparkSession)
    counts = partial(document_words, min_chars=min_chars)
    rows = doc_columns(docs).mapInArrow(partial(_counted, counts_of=counts, name="word"), "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ------------------------------------------------------------------------- grams

def _prefixes(word: str) -> Counter:
    """The gram prefixes that may be extended, at every position."""
    padded = word + _END
    return Counter(padded[p:p + q] for p in range(len(word)) for q in range(QMIN, QMAX) if p + q <= len(padded))


def gram_dictionary(words: DataFrame, nodes: int = NODES, frequent: int = FREQUENT) -> dict[str, int]:
    """Frequent grams and their counts: fewer than ``nodes`` by construction, since all counts together
    are at most (QMAX - QMIN) per letter."""
    letters = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    least = max(frequent, -(-(QMAX - QMIN) * letters // nodes))
    rows = words.select("word").mapInArrow(partial(_counted, counts_of=_prefixes, name="gram"), "gram string, n bigint")
    found = rows.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > least)
    return {r["gram"]: r["n"] for r in found.collect()}


def decompose(word: str, dictionary: dict[str, int]) -> list[str]:
    """The word's gram at each position."""
    padded, out = word + _END, []
    for p in range(len(word)):
        gram = padded[p:p + QMIN]
        while len(gram) < QMAX and gram in dictionary and p + len(gram) < len(padded):
            gram = padded[p:p + len(gram) + 1]
        out.append(gram)
    return out


def affected(grams: list[str]) -> int:
    """The most grams that one edit can change: those that cover its place."""
    cover = [0] * (len(grams) + 2)
    for p, gram in enumerate(grams):
        cover[p] += 1
        cover[p + len(gram)] -= 1
    most = now = 0
    for step in cover:
        now += step
        most = max(most, now)
    return most


def rarest(word: str, dictionary: dict[str, int]) -> list[tuple[str, int]]:
    """(gram, position) of the word's ``affected + 1`` rarest grams, in an order common to all words.
    A gram that is no entry is infrequent; the less frequent what it extends, the rarer."""
    grams = decompose(word, dictionary)

    def order(p: int):
        return dictionary.get(grams[p], 0), dictionary.get(grams[p][:-1], 0), grams[p], p

    chosen = sorted(range(len(grams)), key=order)[:affected(grams) + 1]
    return [(grams[p], p) for p in chosen]


def _key(gram: str, chars: int, place: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{gram}\n{chars}\n{place}") - (1 << 63)


def _postings(batches: Iterator[pa.RecordBatch], dictionary: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """(key, probe, word, n): a word in the lists of its own length, and as a probe in those of words
    one letter longer."""
    for batch in batches:
        keys, probes, words, counts = [], [], [], []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            chars = len(word)
            for gram, p in rarest(word, dictionary):
                keys += [_key(gram, chars, p), _key(gram, chars + 1, p), _key(gram, chars + 1, p + 1)]
                probes += [False, True, True]
                words += [word] * 3
                counts += [n] * 3
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(probes, pa.bool_()), pa.array(words, pa.string()),
                                          pa.array(counts, pa.int64())], names=["key", "probe", "word", "n"])


def _without_letter(word: str) -> set[int]:
    """Hashes of the word without each of its letters, in time linear in its length."""
    suffix, power, out = [0] * (len(word) + 1), 1, set()
    for i in range(len(word) - 1, -1, -1):
        suffix[i] = (suffix[i + 1] + ord(word[i]) * power) % _PRIME
        power = power * _BASE % _PRIME
    head, inverse = 0, pow(_BASE, -1, _PRIME)
    for i in range(len(word)):
        power = power * inverse % _PRIME  # BASE to the number of letters behind i
        out.add((head * power + suffix[i + 1]) % _PRIME)
        head = (head * _BASE + ord(word[i])) % _PRIME
    return out


def _whole(word: str) -> int:
    out = 0
    for c in word:
        out = (out * _BASE + ord(c)) % _PRIME
    return out


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of too long lists, dealt anew: own words without each letter, probes as they are."""
    for batch in batches:
        rows = [(xxhash.xxh3_64_intdigest(f"{key}\n{left}") - (1 << 63), probe, word, n)
                for key, probe, word, n in zip(*(c.to_pylist() for c in batch.columns))
                for left in ([_whole(word)] if probe else _without_letter(word))]
        columns = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, batch.schema)], schema=batch.schema)


def _verified(rows: DataFrame) -> DataFrame:
    """Pairs of a list's own word and another word of the list that are one edit apart."""
    own = rows.filter("NOT probe").select("key", F.col("word").alias("a"), F.col("n").alias("na"))
    other = rows.select("key", "probe", F.col("word").alias("b"), F.col("n").alias("nb"))
    met = own.join(other, "key").filter((F.col("probe") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "na", "b", "nb")


def near_words(words: DataFrame, nodes: int = NODES, frequent: int = FREQUENT, longest: int = LIST) -> DataFrame:
    """a, na, b, nb: each two words (columns word, n) one inserted, deleted or replaced letter apart, once."""
    ship_package(words.sparkSession)
    dictionary = gram_dictionary(words, nodes, frequent)
    schema = "key bigint, probe boolean, word string, n bigint"
    rows = words.select("word", "n").mapInArrow(partial(_postings, dictionary=dictionary), schema)
    long = checkpointed(rows.groupBy("key").count().filter(F.col("count") > longest).select("key"))
    pairs = _verified(rows.join(long, "key", "left_anti").select("key", "probe", "word", "n"))
    dealt = rows.join(long, "key", "left_semi").select("key", "probe", "word", "n").mapInArrow(_finer, schema)
    both = pairs.union(_verified(dealt))
    ordered = both.select(F.when(F.col("a") < F.col("b"), F.struct("a", "na", "b", "nb"))
                          .otherwise(F.struct(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
                          .alias("p"))
    return ordered.select("p.*").distinct()


def spelling_variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      nodes: int = NODES, frequent: int = FREQUENT, longest: int = LIST) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the documents.

    ``form`` is the near word of largest n (ties: smallest in code-point order) if that is at least
    ``ratio`` times the word's n; ``root`` follows forms to the last one. Null and empty texts
    have no words; a null doc_id counts as an empty one in the checksum; repeated rows count again; an
    empty table gives no rows; other columns are not read. Words of any length are whole.
    """
    if min_chars <= QMAX:
        raise ValueError(f"min_chars must be more than {QMAX}, the most grams that an edit changes")
    words = checkpointed(count_words(docs, min_chars, min_count))
    pairs = near_words(words, nodes, frequent, longest)
    ends = F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b"), F.col("nb").alias("nb")),
                   F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("na").alias("nb")))
    both = pairs.select(F.explode(ends).alias("p")).select("p.*")
    best = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"),
                                                      F.min(F.struct((-F.col("nb")).alias("less"), F.col("b").alias("form"))).alias("best"))
    found = checkpointed(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                                                 F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(
                                                                     F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("f")))
    found = found.select("word", "n", "n_near", F.col("f.form").alias("form"), F.col("f.form_n").alias("form_n"))
    roots = follow(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return (found.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def follow(steps: DataFrame) -> DataFrame:
    """(word, root) from steps without a circle: each round doubles how far all have gone. A step
    multiplies the count, so chains are as long as the logarithm of the largest count."""
    gone = checkpointed(steps)
    while True:
        further = gone.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = checkpointed(gone.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                      F.col("next").isNotNull().alias("moved")))
        if gone.filter("moved").isEmpty():
            return gone.select("word", "root")
        gone = gone.select("word", "root")
