"""Quality rules by compression bands.

Repetitive text compresses far better than prose, and random or encoded text
hardly at all. Every whole text is compressed with zstandard, once as a
whole and once in fixed chunks, and the ratios (bytes before / after) must lie
in a band that depends on the length: longer inputs compress better, and short
ones are dominated by the frame header, so very short texts have no lower limit.

Row-local: one Arrow-batched pass, no shuffle. Also counts the base figures
of the rule set (words, symbols, repeated lines, repeated three-word windows).
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from .common import filter_texts, map_texts

#: zstandard level of all ratios.
LEVEL = 3
#: (bytes below, lowest ratio, highest ratio) of a whole document, or of a last chunk that is not full. The lowest
#: ratios lie between what encoded text reaches at the band's longest (base64: 1.14, 1.19, 1.23, 1.25, 1.29, 1.31,
#: then up to 4/3; random letters and digits in words: 1.30, 1.32, 1.36, 1.38, 1.40 from 512 bytes on) and what prose
#: reaches at its shortest (smallest of sf0.1's texts cut there: 1.23, 1.31, 1.38, 1.54, 1.66, 1.89, 2.07).
DOCUMENT_BANDS = [(256, 0.0, 3.0), (384, 1.15, 3.0), (512, 1.2, 3.0), (768, 1.3, 3.0), (1024, 1.33, 3.0), (2048, 1.37, 3.2),
                  (4096, 1.4, 3.2), (16384, 1.42, 3.6), (65536, 1.42, 4.2), (float("inf"), 1.42, 5.0)]
#: Fixed chunks: their size in bytes, and the band of a full chunk.
CHUNK_BYTES = 4096
CHUNK_BAND = (1.42, 3.5)
#: A document goes if more than this share of its bytes is in chunks outside their band.
CHUNK_SHARE = 0.3
SYMBOLS = "#*$%&|<>"
#: The separators of words: space and U+0009 to U+000D, the same as ``bytes.split()``.
_SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COLUMNS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "base_failed boolean, kept boolean, ratio double, bad_chunk_share double, verdict string")


def repeated_window_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice (its first place included)."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    if len(index) == n:
        return 0
    base = len(index)
    if base < 2 ** 21:
        codes = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:  # three ids no longer fit 63 bits: number the pairs first
        pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
        codes = pairs[:-1] * base + ids[2:]
    ordered = np.sort(codes)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    again = np.unique(again)
    at = np.searchsorted(again, codes).clip(max=len(again) - 1)
    hit = again[at] == codes
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def base_counts(text: str, data: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = data.split()
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (len(words), len(text) - sum(text.count(c) for c in _SPACES), sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)), repeated_window_words(words))


def band(size: int) -> tuple[float, float]:
    """(lowest, highest ratio) of a text of ``size`` bytes."""
    return next((a, b) for below, a, b in DOCUMENT_BANDS if size < below)


def band_verdict(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float | None, float, str]:
    """(ratio, share of the bytes in chunks outside their band, verdict) of one document; the last chunk may be
    shorter and has the band of its length."""
    if not data:
        return None, 0.0, "empty"
    ratio = len(data) / len(compressor.compress(data))
    low, high = band(len(data))
    incompressible = repetitive = 0
    for i in range(0, len(data), CHUNK_BYTES):
        chunk = data[i:i + CHUNK_BYTES]
        least, most = CHUNK_BAND if len(chunk) == CHUNK_BYTES else band(len(chunk))
        r = ratio if len(chunk) == len(data) else len(chunk) / len(compressor.compress(chunk))
        incompressible += len(chunk) * (r < least)
        repetitive += len(chunk) * (r > most)
    share = (incompressible + repetitive) / len(data)
    if ratio > high:
        return ratio, share, "repetitive"
    if ratio < low:
        return ratio, share, "incompressible"
    if share > CHUNK_SHARE:
        return ratio, share, "repetitive chunks" if repetitive >= incompressible else "incompressible chunks"
    return ratio, share, "kept"


def _make():
    compressor = zstandard.ZstdCompressor(level=LEVEL)

    def rows(texts: list[str | None]):
        out = []
        for text in texts:
            text = text or ""
            data = text.encode()
            counts = base_counts(text, data)
            base_failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
            ratio, share, verdict = band_verdict(data, compressor)
            out.append((*counts, base_failed, not base_failed and verdict == "kept", ratio, share, verdict))
        return zip(*out) if out else [[]] * 10
    return rows


def compression_quality(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, ``base_failed``, ``kept``, ``ratio``,
    ``bad_chunk_share`` and the bands' own ``verdict``.

    A null text counts as empty: no words, verdict ``empty``, not kept. A null doc_id stays null.
    Repeated rows each give a row; an empty table gives none; other columns are not read.
    """
    return map_texts(docs, _make, COLUMNS)


def _verdicts(columns):
    return list(columns)[6]


def keep_quality(docs: DataFrame) -> DataFrame:
    """The documents that all rules keep, with all their columns; texts that are null or empty go."""
    return filter_texts(docs, _make, _verdicts)
