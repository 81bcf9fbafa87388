"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams (1 to 3 letters,
a blank standing for each word edge) in order of frequency. A document gets such
a list of its own, and its distance to a language is the sum, over the document's
list, of how far each n-gram is out of place in the language's list; one that
the list lacks counts as far as a list is long. The nearest language wins.

Learning: a sample of labelled documents (about ``SAMPLE`` per language, chosen by a
hash of the id) is counted in one distributed pass; only the profiles reach the
driver (``PROFILE`` rows per language). Prediction is row-local over whole
texts, with no shuffle.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ship_package
from .common import map_texts

#: Length of every profile.
PROFILE = 400
#: Labelled documents per language that a profile is learnt from, about (the classifier's bound).
SAMPLE = 3000
#: More label values than this are no language labels.
MAX_LANGUAGES = 4096
UNDETERMINED = "und"
_BLANK = 32
_BITS = 21  # of a code point


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: does it belong to a word (a letter or a mark); is it a letter."""
    kinds = np.array([unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)])
    return (kinds == "L") | (kinds == "M"), kinds == "L"


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram codes in ascending order, counts) of a whole text; empty if it has no letter.

    A code packs up to three code points, 21 bits each.
    """
    in_word, letter = _letters()
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    if not letter[points].any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.full(len(points) + 2, _BLANK, np.int64)
    row[1:-1] = np.where(in_word[points], points, _BLANK)
    blank = row == _BLANK
    keep = np.ones(len(row), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    row, blank = row[keep], blank[keep]
    two = row[:-1] << _BITS | row[1:]
    three = (two[:-1] << _BITS | row[2:])[~blank[1:-1]]
    codes = np.sort(np.concatenate([row[~blank], two, three]))
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.diff(np.append(first, len(codes)))


def most_frequent(codes: np.ndarray, counts: np.ndarray, n: int = PROFILE) -> np.ndarray:
    """The n most frequent codes in order; ties go to the smaller code."""
    if len(codes) > n:
        least = np.partition(counts, len(counts) - n)[len(counts) - n]
        near = counts >= least
        codes, counts = codes[near], counts[near]
    return codes[np.argsort(-counts, kind="stable")[:n]]


class Profiles:
    """Rank of each n-gram in each language's list; ``PROFILE`` where the list lacks it."""

    def __init__(self, lists: dict[str, list[int]]):
        self.languages = sorted(lists)
        self.codes = np.unique(np.array([c for l in lists.values() for c in l], np.int64))
        self.ranks = np.full((len(self.languages), len(self.codes) + 1), -1, np.int64)
        for i, language in enumerate(self.languages):
            self.ranks[i, np.searchsorted(self.codes, np.array(lists[language], np.int64))] = np.arange(len(lists[language]))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """(language, 1 - out-of-place distance / the largest possible); ties to the smaller name."""
        codes, counts = ngrams(text) if text else (np.zeros(0, np.int64),) * 2
        if not len(codes) or not self.languages:
            return UNDETERMINED, 0.0
        own = most_frequent(codes, counts)
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = -1
        at = np.where(self.codes[at] == own, at, len(self.codes))
        ranks = self.ranks[:, at]
        away = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own)))).sum(axis=1)
        best = int(away.argmin())
        return self.languages[best], float(1 - away[best] / (PROFILE * len(own)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[str, list] = {}
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes, counts = ngrams(text)
            if len(codes):
                found.setdefault(language, []).append((codes, counts))
        for language, lists in found.items():
            codes, at = np.unique(np.concatenate([x[0] for x in lists]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([x[1] for x in lists])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(codes)), pa.array(codes), pa.array(sums)],
                                             names=["lang", "code", "n"])


def learn_profiles(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> Profiles:
    """Profiles of the languages named by ``lang`` in the rows where ``learn`` holds."""
    ship_package(docs.sparkSession)
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} values")
    if not sizes:
        return Profiles({})
    # a row-local draw: the share that leaves about ``sample`` rows of each language
    shares = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, sample / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.select("lang", F.col("text").cast("string"), "doc_id").filter(draw < shares[F.col("lang")]).select("lang", "text")
    counts = chosen.mapInArrow(_counted, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    lists: dict[str, list] = {}
    for r in counts.withColumn("place", place).filter(F.col("place") <= PROFILE).orderBy("lang", "place").collect():
        lists.setdefault(r["lang"], []).append(r["code"])
    return Profiles(lists)


def _make(profiles: Profiles):
    def rows(texts: list[str | None]):
        found = [profiles.nearest(t) for t in texts]
        return [f[0] for f in found], [f[1] for f in found]
    return rows


def predict_languages(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred, score per document.

    A null text, or one without a letter, gets ``und`` and 0; so does every document when
    no language was learnt. Null ids and repeated rows keep their rows; lang, source and other
    columns are not read.
    """
    return map_texts(docs, partial(_make, profiles), "lang_pred string, score double")
