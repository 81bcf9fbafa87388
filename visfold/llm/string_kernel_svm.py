"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Two strings are alike when they share subsequences of ``ORDER`` letters; a
subsequence that spans s letters counts ``DECAY ** s``, so letters in between weaken a match
and don't break it: ``idxiot``, ``i-d-i-o-t`` and ``i d i o t`` stay close to the plain word.
A sentence is the set of its units (words, long words in overlapping windows,
spelt-out letters joined), and is as toxic as its most toxic unit; a document is as
toxic as its most toxic sentence.

The kernel is approximated by ``LANDMARKS`` strings: a unit maps to K(mm)^-1/2 k(unit, landmarks),
and a linear machine with squared hinge loss is trained on those vectors. As k is
an inner product of explicit subsequence weights, landmarks, root and machine
collapse into one weight per subsequence, which is all that scoring needs.

Labels belong to whole texts. Their sentences inherit them, each distinct sentence counting once (as
clean, if it stands in a clean text too), so that copies and boilerplate prove nothing. Units that
are far commoner in toxic sentences (log-likelihood ratio and odds) are the positive
examples, together with variants that have a letter or dashes inserted; units of
clean sentences are the negative ones, and clean texts' most toxic units are added in rounds.
The labelled rows are a sample of about ``SAMPLE`` texts per label (chosen by a hash of the id);
each pass over it is a Spark job whose counts are cut to ``UNITS`` rows before they reach
the driver. Scoring is row-local over whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import checkpointed, filter_texts, map_texts

ORDER, DECAY, SPAN = 3, 0.6, 6
LANDMARKS = 256
#: Labelled texts per label that the machine is trained on, about (the classifier's bound).
SAMPLE = 4000
#: Units that a training pass brings to the driver, and toxic ones among them.
UNITS, TOXIC_UNITS = 20_000, 2_000
#: A unit is a positive example from this log-likelihood ratio and this ratio of odds on.
LEAST_RATIO, LEAST_ODDS = 20.0, 30.0
#: Rounds in which clean texts' most toxic units (so many per text) are added.
ROUNDS, HARD = 3, 5
#: Letters of a unit; longer words count as windows that overlap by half.
WIDTH = 16
#: Predicted toxic from this score on.
THRESHOLD = 0.7
#: Decision value of a text without any unit.
EMPTY = -2.0
#: Units whose decision values a worker keeps; when full, the table starts anew.
KEPT_UNITS = 500_000
#: Digits and signs that stand for letters inside words.
_STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def _symbol(c: str) -> int:
    """1 to 26 for a to z, 27 to 31 for other letters, 0 (only a gap) for anything else."""
    c = _STAND_INS.get(c, c)
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 5 if c.isalpha() else 0


def units(text: str) -> set[str]:
    """The distinct units of a text."""
    out: set[str] = set()
    spelt: list[str] = []
    for token in set(text.lower().split()) if not _has_spelt(text) else [*text.lower().split(), ""]:
        word = token if token.isalnum() else _EDGES.sub("", token)
        if len(word) == 1:
            spelt.append(word)
            continue
        if len(spelt) >= ORDER:
            _add(out, "".join(spelt))
        spelt.clear()
        if len(word) >= ORDER:
            _add(out, word)
    return out


_SPELT = re.compile(r"(?:(?<=\s)|^)[^\W_]\W*\s+[^\W_]\W*\s+[^\W_]\W*(?=\s|$)")


def _has_spelt(text: str) -> bool:
    return _SPELT.search(text) is not None


def _add(out: set[str], word: str) -> None:
    if len(word) <= WIDTH:
        out.add(word)
    else:
        for at in range(0, len(word) - WIDTH // 2, WIDTH // 2):
            out.add(word[at:at + WIDTH])


# -------------------------------------------------------------------- the kernel

_SHIFTS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_WEIGHTS = np.array([DECAY ** (b + 1) for _, b in _SHIFTS], np.float32)
_SPAN_WEIGHT = np.array([DECAY ** (k + ORDER) for k in range(4)])
N_CODES = 32 ** ORDER


class Symbols(dict):
    """Symbol of each character, worked out once."""
    def __missing__(self, c):
        self[c] = _symbol(c)
        return self[c]


_SYMBOLS = Symbols()


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes [words, places, shifts] of subsequences, 0 where there is none; their weights per shift;
    norm of each word's vector of summed weights)."""
    width = max(map(len, words))
    rows = np.zeros((len(words), width + SPAN - 1), np.int32)
    lengths = np.array([len(w) for w in words])
    flat = np.array([_SYMBOLS[c] for c in "".join(words)], np.int32)
    rows[:, :width][np.arange(width) < lengths[:, None]] = flat
    codes = np.empty((len(words), width, len(_SHIFTS)), np.int32)
    for k, (a, b) in enumerate(_SHIFTS):
        one, two, three = rows[:, :width], rows[:, a:a + width], rows[:, b:b + width]
        codes[:, :, k] = np.where((one > 0) & (two > 0) & (three > 0), (one * 32 + two) * 32 + three, 0)
    # equal subsequences of one word add up before they are squared
    at = np.flatnonzero(codes.reshape(-1))
    per = codes.shape[1] * codes.shape[2]
    spans = np.array([b - 2 for _, b in _SHIFTS], np.int64)
    keys = (at // per) << 17 | codes.reshape(-1)[at].astype(np.int64) << 2 | spans[at % len(_SHIFTS)]
    keys.sort()
    square = np.zeros(len(words))
    if len(keys):
        same = np.flatnonzero(np.concatenate([[True], keys[1:] >> 2 != keys[:-1] >> 2]))
        sums = np.add.reduceat(_SPAN_WEIGHT[keys & 3], same)
        square = np.bincount(keys[same] >> 17, sums * sums, len(words))
    return codes, _WEIGHTS, np.sqrt(square)


def decision(words: list[str], beta: np.ndarray, bias: float) -> np.ndarray:
    """Decision value of each unit: <beta, phi(unit)> / |phi(unit)| + bias."""
    out = np.full(len(words), EMPTY)
    order = np.argsort([len(w) for w in words], kind="stable")
    for at in range(0, len(words), 4096):  # of about equal lengths
        some = order[at:at + 4096]
        codes, weights, norm = subsequences([words[i] for i in some])
        sums = (beta[codes].sum(axis=1) * weights).sum(axis=1)  # beta[0] is 0
        has = norm > 0
        out[some[has]] = sums[has] / norm[has] + bias
    return out


def _vectors(words: list[str]) -> np.ndarray:
    """Explicit normalised subsequence vectors [words, N_CODES] (landmarks only)."""
    codes, weights, norm = subsequences(words)
    out = np.zeros((len(words), N_CODES), np.float32)
    np.add.at(out, (np.arange(len(words))[:, None, None], codes), np.broadcast_to(weights, codes.shape))
    out[:, 0] = 0
    return out / np.maximum(norm, 1e-12)[:, None]


def _against(words: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Kernel of each word with each landmark."""
    out = np.zeros((len(words), len(landmarks)), np.float32)
    columns = np.ascontiguousarray(landmarks.T)
    for at in range(0, len(words), 512):
        codes, weights, norm = subsequences(words[at:at + 512])
        for i, (c, n) in enumerate(zip(codes, norm)):
            if n > 0:
                place, shift = np.nonzero(c)
                out[at + i] = weights[shift] @ columns[c[place, shift]] / n
    return out


# ---------------------------------------------------------------------- training

def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 3.0) -> np.ndarray:
    """Linear machine (last entry: bias) by Newton steps on the squared hinge loss."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6

    def loss(w):
        return 0.5 * w @ ridge @ w + cost * (weight * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    now = loss(w)
    for _ in range(30):
        active = y * (x @ w) < 1
        xa = x[active] * weight[active, None]
        step = np.linalg.solve(ridge + 2 * cost * xa.T @ x[active], ridge @ w - 2 * cost * xa.T @ (y[active] - x[active] @ w))
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w, before, now = w - size * step, now, loss(w - size * step)
        if before - now < 1e-6 * before:
            break
    return w


def train_machine(toxic: dict[str, float], clean: dict[str, float], landmarks: list[str]) -> tuple[np.ndarray, float]:
    """(weight of each subsequence, bias) from weighted toxic and clean units."""
    marks = _vectors(landmarks)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-4
    root = vectors[:, keep] / np.sqrt(values[keep])
    words = [*toxic, *clean]
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    weight = np.array([*toxic.values(), *clean.values()], float)
    w = _squared_hinge(_against(words, marks) @ root, y, weight / weight.sum() * len(words))
    beta = (marks.T @ (root @ w[:-1])).astype(np.float32)
    beta[0] = 0
    return beta, float(w[-1])


def variants(unit: str) -> list[str]:
    """The unit with one letter inserted, and spelt with dashes."""
    rare = "xqzkvj"
    out = [unit[:i] + rare[i % len(rare)] + unit[i:] for i in range(1, len(unit))]
    return [v for v in [*out, "-".join(unit)] if len(v) <= WIDTH]


def fit(toxic: dict[str, float], clean: dict[str, float], hard: Counter) -> tuple[np.ndarray, float]:
    """A machine from counts of positive units (most typical first), clean units and hard clean ones."""
    negative = {u: n ** 0.5 for u, n in clean.items() if u not in toxic}
    for u, n in hard.items():
        if u not in toxic:
            negative[u] = negative.get(u, 0.0) + 2 * n ** 0.5
    positive = {u: n ** 0.5 for u, n in toxic.items()}
    for u in list(toxic)[:LANDMARKS // 2]:
        for v in (own := variants(u)):
            positive.setdefault(v, toxic[u] ** 0.5 / len(own))
    scale = sum(negative.values()) / sum(positive.values()) / 2
    landmarks = dict.fromkeys(list(toxic)[:LANDMARKS // 2])
    landmarks |= dict.fromkeys([u for u, _ in hard.most_common(LANDMARKS // 4) if u not in toxic])
    for u in sorted(clean, key=lambda u: (-clean[u], u)):
        if len(landmarks) >= LANDMARKS:
            break
        landmarks.setdefault(u)
    return train_machine({u: w * scale for u, w in positive.items()},
                         {u: w for u, w in negative.items() if u not in positive}, list(landmarks))


def _sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(s, toxic) for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for s in _SENTENCE_END.split(text)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())],
                                         names=["sentence", "toxic"])


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, toxic, sentences that hold it)."""
    for batch in batches:
        counts: Counter = Counter()
        for sentence, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update([(u, toxic) for u in units(sentence)])
        rows = [(u, t, n) for (u, t), n in counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["unit", "toxic", "n"])


def _most_toxic(batches: Iterator[pa.RecordBatch], beta: np.ndarray, bias: float) -> Iterator[pa.RecordBatch]:
    """(label, highest decision value, most toxic units) of each text; the units of clean texts only."""
    for batch in batches:
        found = []
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = sorted(units(text))
            values = decision(own, beta, bias) if own else np.full(1, EMPTY)
            hard = [] if toxic or not own else [own[i] for i in np.argsort(-values, kind="stable")[:HARD]]
            found.append((toxic, float(values.max()), hard))
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.float64()),
                                          pa.array([f[2] for f in found], pa.list_(pa.string()))], names=["toxic", "value", "units"])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(toxic | decision value), slightly regularised. What lies far on the right
    side says nothing about where the kinds part, so values are clipped."""
    a = np.stack([np.clip(x, EMPTY, -EMPTY), np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(2), a.T @ (weight * (p - y)) + 0.05 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


class ToxicityModel:
    """Subsequence weights, bias, and slope and offset of the score; ``beta`` None: nothing learnt."""

    def __init__(self, beta: np.ndarray | None = None, bias: float = 0.0, slope: float = 1.0, offset: float = 0.0):
        self.beta, self.bias, self.slope, self.offset = beta, bias, slope, offset

    def scores(self, texts: list[str], kept: dict[str, float]) -> list[float]:
        if self.beta is None:
            return [0.0] * len(texts)
        found = [units(t) for t in texts]
        if len(kept) > KEPT_UNITS:
            kept.clear()
        new = list({u for own in found for u in own if u not in kept})
        if new:
            kept.update(zip(new, decision(new, self.beta, self.bias).tolist()))
        values = np.array([max([kept[u] for u in own], default=EMPTY) for own in found])
        return (1 / (1 + np.exp(-np.clip(self.slope * values + self.offset, -60, 60)))).tolist()


def train_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Train on ``docs`` (doc_id, text) joined with ``labels`` (doc_id, toxic 0 or 1; null: no label)."""
    spark = docs.sparkSession
    ship_package(spark)
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return ToxicityModel()
    share = F.when(F.col("toxic") == 1, min(1.0, sample / sizes[1])).otherwise(min(1.0, sample / sizes[0]))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = marked.filter(draw < share)  # about 2 * sample rows by construction, so it may be broadcast
    texts = docs.filter("text IS NOT NULL").select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id").select("text", "toxic")
    texts = checkpointed(texts)
    sentences = texts.mapInArrow(_sentences, "sentence string, toxic int").groupBy("sentence").agg(F.min("toxic").alias("toxic"))
    sentences = checkpointed(sentences)
    sums = sentences.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first()
    if not sums["a"] or not sums["b"]:
        return ToxicityModel()
    counts = sentences.mapInArrow(_count_units, "unit string, toxic int, n bigint").groupBy("unit").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q"))
    expected = (F.col("p") + F.col("q")) * (sums["a"] / (sums["a"] + sums["b"]))
    ratio = 2 * (F.col("p") * F.log(F.col("p") / expected)
                 + F.when(F.col("q") > 0, F.col("q") * F.log(F.col("q") / (F.col("p") + F.col("q") - expected))).otherwise(0.0))
    counts = checkpointed(counts.withColumn("ratio", F.when(F.col("p") > expected, ratio).otherwise(0.0)))
    typical = counts.filter((F.col("p") >= 3) & (F.col("ratio") >= LEAST_RATIO)
                            & (F.col("p") * sums["b"] >= LEAST_ODDS * (F.col("q") + 0.5) * sums["a"]))
    toxic = {r["unit"]: float(r["p"]) for r in typical.orderBy(F.desc("ratio"), "unit").limit(TOXIC_UNITS).collect()}
    if not toxic:
        return ToxicityModel()
    # the most frequent clean units, and as many drawn by a hash for the rare ones
    clean = {r["unit"]: float(r["q"]) for order in ((F.desc("q"), "unit"), (F.xxhash64("unit"), "unit"))
             for r in counts.filter("q > 0").orderBy(*order).limit(UNITS // 2).collect()}
    hard: Counter = Counter()
    for again in range(ROUNDS + 1):
        beta, bias = fit(toxic, clean, hard)
        judged = texts.mapInArrow(partial(_most_toxic, beta=beta, bias=bias), "toxic int, value double, units array<string>")
        if again == ROUNDS:
            best = judged.select("toxic", "value").collect()
        else:
            found = judged.select(F.explode("units").alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
            hard.update({r["unit"]: r["n"] for r in found.orderBy(F.desc("n"), "unit").limit(UNITS).collect()})
    x, y = np.array([r["value"] for r in best]), np.array([float(r["toxic"]) for r in best])
    prior = np.where(y == 1, sizes[1] / max(1, (y == 1).sum()), sizes[0] / max(1, (y == 0).sum()))
    slope, offset = _logistic(x, y, prior * len(y) / prior.sum())
    return ToxicityModel(beta, bias, slope, offset)


def _make(model: ToxicityModel):
    kept: dict[str, float] = {}

    def rows(texts: list[str | None]):
        scores = [s for i in range(0, len(texts), 512) for s in model.scores([t or "" for t in texts[i:i + 512]], kept)]
        return scores, [int(s >= THRESHOLD) for s in scores]
    return rows


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from ``THRESHOLD`` on) of each whole text.

    A null or empty text, or one without a word of three letters, gets the score of ``EMPTY``. Null ids and
    repeated rows keep their rows; labels, lang, source and other columns are not read.
    """
    return map_texts(docs, partial(_make, model), "score double, predicted int")


def _clean(columns):
    return [not p for p in columns[1]]


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns; null and empty texts stay."""
    return filter_texts(docs, partial(_make, model), _clean)
