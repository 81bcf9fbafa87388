"""Dynamic interference flagging: an iterated background fit, SumThreshold and SIR.

One amplitude per sample, sqrt(mean over pols of |v|^2), so the four pol
flags move together. A round smooths the amplitudes over the (slot, channel) plane of a baseline
without the samples flagged so far, and thresholds what lies above that background; the first rounds use
high thresholds, so that strong interference is out of the background before the last one.

Decisions: background = separable Gaussian mean over -k..k rows in time, then in frequency, of
unflagged samples (sigma k/2); residual = amplitude - background, signed, and only
samples above it are interference (it adds power); noise = 1.4826 x median absolute deviation of the
unflagged residuals of an (obs, baseline) plane, taken in the first round, and residuals
are counted from the plane's median; chi_1 = sensitivity x noise, and 3 times that in the round before the last;
chi_M = chi_1 / 1.5^log2(M). A window of M samples is hit if its unflagged ones
exceed chi_M on average, M = 1, 2, 4, .. in time then in frequency, each size
seeing the flags so far. SIR (eta) extends flags in time then frequency; missing slots are skipped (frames
count rows); the result is OR-ed into the input flags, never cleared. Non-finite samples are
flagged and play no part. A plane without spread (noise 0) has no threshold.

Every window frame is an offset or grows by one row, so a row costs the same whatever the largest
size: a window's sum is the difference of two running sums, and the marks of hit windows are a running
count of their starts less that of M rows before. Time-direction series are
(obs, ant1, ant2, chan) ordered by slot; frequency-direction ones (obs, ant1, ant2, slot) ordered by
chan; both lie within a baseline, so one exchange serves all of them, and a large
observation never lands in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cplx as C
from ..functions.robust import median_and_deviation

POLS = C.POLS
TIME_SERIES = ("obs_id", "ant1", "ant2", "chan")
FREQ_SERIES = ("obs_id", "ant1", "ant2", "slot")
PLANE = ("obs_id", "ant1", "ant2")
# SumThreshold sizes, the per-doubling threshold divisor, and the standard deviation of
# normal values with a median absolute deviation of one.
DEFAULT_SIZES = (1, 2, 4, 8, 16, 32, 64)
THRESHOLD_DIVISOR = 1.5
MAD_TO_SIGMA = 1.4826
#: Threshold in units of the noise, rounds, how much lower each round's threshold is than the one before, rows
#: on each side that the background is taken from.
SENSITIVITY, ROUNDS, FALL, HALF_WIDTH = 6.0, 2, 3.0, 3
#: Rows that a task sorts at a time, about 60 MB of them.
ROWS_PER_TASK = 200_000
#: Sums closer to the threshold than this share of it are rounding errors.
CLOSE = 1e-6


def sample_amplitude(data: Column | None = None) -> Column:
    data = F.col("data") if data is None else data
    s = None
    for p in POLS:
        t = C.c_abs2(data.getField(p))
        s = t if s is None else s + t
    return F.sqrt(s / F.lit(4.0))


def any_flag(flag: Column | None = None) -> Column:
    flag = F.col("flag") if flag is None else flag
    out = None
    for p in POLS:
        out = flag.getField(p) if out is None else (out | flag.getField(p))
    return out


def _series(direction: str, reverse: bool = False):
    if direction in ("time", "freq"):
        keys, order = (TIME_SERIES, "slot") if direction == "time" else (FREQ_SERIES, "chan")
        return Window.partitionBy(*keys).orderBy(F.desc(order) if reverse else F.asc(order))
    raise ValueError(f"direction must be 'time' or 'freq', got {direction!r}")


def prepare(vis: DataFrame) -> DataFrame:
    """Add working columns ``amp`` (sample amplitude) and ``fl`` (any pol flagged, or not finite)."""
    out = vis.withColumn("amp", sample_amplitude())
    return out.withColumn("fl", F.coalesce(any_flag() | ~(F.col("amp") - F.col("amp") == 0), F.lit(True)))


def gaussian_weights(half_width: int) -> list[float]:
    """Weights at distances 0 to ``half_width``; sigma is half of it."""
    return [math.exp(-2.0 * j * j / (half_width * half_width)) if half_width else 1.0 for j in range(half_width + 1)]


def _smoothed(column: str, series, weights: list[float]) -> Column:
    out = F.lit(weights[0]) * F.col(column)
    for j, g in enumerate(weights[1:], 1):
        out = out + F.lit(g) * (F.lag(column, j, 0.0).over(series) + F.lead(column, j, 0.0).over(series))
    return out


def background_residual(df: DataFrame, half_width: int = HALF_WIDTH) -> DataFrame:
    """``resid`` = amp - Gaussian mean of the unflagged amplitudes around it; 0 where there are none."""
    weights = gaussian_weights(half_width)
    df = df.withColumns({"_v": F.when(F.col("fl"), 0.0).otherwise(F.col("amp")), "_w": F.when(F.col("fl"), 0.0).otherwise(1.0)})
    for direction in ("time", "freq"):
        series = _series(direction)
        df = df.withColumns({c: _smoothed(c, series, weights) for c in ("_v", "_w")})
    resid = F.when((F.col("_w") > 0) & (F.col("amp") - F.col("amp") == 0), F.col("amp") - F.col("_v") / F.col("_w"))
    return df.withColumn("resid", F.coalesce(resid, F.lit(0.0))).drop("_v", "_w")


def noise_scale(df: DataFrame) -> DataFrame:
    """Add ``centre`` (median) and ``noise`` (1.4826 x median absolute deviation) of the unflagged residuals of
    the sample's (obs, baseline) plane; null for a plane without any. No window: see ``functions.robust``."""
    planes = median_and_deviation(df.filter("NOT fl"), PLANE, "resid")
    planes = planes.select(*PLANE, F.col("median").alias("centre"), (F.lit(MAD_TO_SIGMA) * F.col("mad")).alias("noise"))
    return df.join(planes, list(PLANE), "left")


def sumthreshold(df: DataFrame, direction: str = "time", sensitivity: float = SENSITIVITY, sizes=DEFAULT_SIZES) -> DataFrame:
    """SumThreshold on ``resid`` above ``centre`` with chi_1 = sensitivity x ``noise``; updates ``fl``.
    Linear in the rows for any size."""
    series = _series(direction)
    chi1 = F.lit(float(sensitivity)) * F.col("noise")

    def upto(last: int):
        return series.rowsBetween(Window.unboundedPreceding, last)

    for m in sizes:
        k = m.bit_length() - 1
        if 1 << k != m:
            raise ValueError(f"window sizes must be powers of two, got {m}")
        chi = chi1 / F.lit(THRESHOLD_DIVISOR ** k)
        # a flagged sample counts as chi: it neither lifts nor lowers a window's excess
        over = F.when(~F.col("fl") & (F.col("noise") > 0), F.col("resid") - F.col("centre") - chi).otherwise(0.0)
        if m == 1:
            df = df.withColumn("fl", F.col("fl") | F.coalesce(over > F.lit(CLOSE) * chi, F.lit(False)))
            continue
        # sums to the window's last row less those to the row before it; only whole windows count
        excess = F.sum(over).over(upto(m - 1)) - F.coalesce(F.sum(over).over(upto(-1)), F.lit(0.0))
        whole = F.lead(F.lit(1), m - 1).over(series).isNotNull()
        df = df.withColumn("_hit", F.coalesce(whole & (excess > F.lit(CLOSE) * chi), F.lit(False)).cast("int"))
        marks = F.sum("_hit").over(upto(0)) - F.coalesce(F.sum("_hit").over(upto(-m)), F.lit(0))
        df = df.withColumn("fl", F.col("fl") | (marks > 0))
    return df.drop("_hit")


def sir(df: DataFrame, direction: str = "time", eta: float = 0.2) -> DataFrame:
    """Scale-invariant rank operator: flag a sample when some interval holding it has a
    flagged fraction >= 1 - eta. With w = eta (flagged) or eta - 1, and prefix sums P,
    that is max(P over later rows) - min(P over earlier prefixes, with 0) >= 0."""
    base = _series(direction)
    w = F.when(F.col("fl"), F.lit(float(eta))).otherwise(F.lit(float(eta) - 1.0))
    df = df.withColumn("_w", w)
    df = df.withColumn("_p", F.sum("_w").over(base.rowsBetween(Window.unboundedPreceding, 0)))
    lo = F.least(F.lit(0.0), F.coalesce(F.min("_p").over(base.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    # in reverse order, so that this frame grows by a row as well instead of being recomputed
    hi = F.max("_p").over(_series(direction, reverse=True).rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("fl", F.col("fl") | (F.round(hi - lo, 9) >= 0))
    return df.drop("_w", "_p")


def merge_flags(df: DataFrame, columns) -> DataFrame:
    """OR the working flag ``fl`` into all four polarisations, drop working columns."""
    flag = F.struct(*[(F.col("flag").getField(p) | F.col("fl")).alias(p) for p in POLS])
    return df.withColumn("flag", flag).select(*columns)


def _tasks(vis: DataFrame) -> int:
    """Partitions of about ``ROWS_PER_TASK`` rows, at least the session's number."""
    return max(int(vis.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-vis.count() // ROWS_PER_TASK))


def dynamic_flag(vis: DataFrame, sensitivity: float = SENSITIVITY, half_width: int = HALF_WIDTH, sizes=DEFAULT_SIZES,
                 eta: float = 0.2, rounds: int = ROUNDS) -> DataFrame:
    """AOFlagger-like step: rounds of background -> SumThreshold time, freq with falling thresholds; then SIR time, freq.

    The rows are dealt by baseline once: series in time and in frequency both lie within a
    baseline, so every window of every step works on that one exchange. It goes to as many tasks as the rows ask for, so that
    a task's sorts stay of one size whatever the input's (a baseline is never split). The noise of a plane is a small
    table of its own, from two aggregations.
    """
    tasks = _tasks(vis)
    own = tasks == int(vis.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = prepare(vis.repartition(*PLANE) if own else vis.repartition(tasks, *PLANE))
    for r in range(rounds):
        df = background_residual(df, half_width)
        if r == 0:
            df = noise_scale(df)
        for direction in ("time", "freq"):
            df = sumthreshold(df, direction, sensitivity * FALL ** (rounds - 1 - r), sizes)
    df = sir(df, "time", eta)
    df = sir(df, "freq", eta)
    return merge_flags(df, vis.columns)
