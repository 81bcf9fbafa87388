"""Nearest / linear lookup on a solution axis (as-of join without pairs).

Spark has no as-of join, and pairing every point with every axis value is
quadratic. Instead the distinct axis values, in order of value, are cut into
consecutive intervals [lo, hi), each interval is expanded over the buckets it
touches, and each point finds its interval through equi-joins on its bucket
plus a range condition. Buckets are cut twice: the range into as many as there
are intervals, and each of those into as many as it holds, so an axis with long
gaps (solutions taken on several days) doesn't put all its intervals into
one bucket. Both tables are about as long as the axis and are broadcast when its
checked size allows; the points are then streamed and never shuffled.

Every point comes out exactly once: intervals don't overlap, the joins are left
joins with the whole condition in them, and a null coordinate gives null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.joins import DEFAULT_BROADCAST_ROWS


def axis_stats(axis: DataFrame, value: str = "value") -> tuple[float | None, float | None, int]:
    """(first, last, n) of an axis by value: three numbers reach the driver."""
    r = axis.agg(F.min(value).alias("a"), F.max(value).alias("b"), F.count_distinct(value).alias("n")).first()
    return r["a"], r["b"], int(r["n"])


#: Axis values in one range part (one window partition), and the most parts.
PART_VALUES, MAX_PARTS = 10_000, 1024


def _next_values(values: DataFrame, n: int) -> DataFrame:
    """(lo, hi): each distinct value with the one after it, without a window over the whole axis.

    Parts start at values of the axis, approximate quantiles that an aggregate returns (at most ``MAX_PARTS``
    numbers). So the value that follows a part's last one is where the next part starts.
    """
    parts = min(MAX_PARTS, -(-n // PART_VALUES))
    starts = []
    if parts > 1:
        cuts = [k / parts for k in range(1, parts)]
        starts = sorted(set(values.agg(F.percentile_approx("lo", cuts, 100 * parts).alias("q")).first()["q"]))
    bounds = F.array(*[F.lit(x) for x in starts]).cast("array<double>")
    steps = [1 << k for k in reversed(range(len(starts).bit_length()))] or [1]
    # how many parts start at or below the value, by halving
    part = F.aggregate(F.array(*[F.lit(k) for k in steps]), F.lit(0),
                       lambda at, k: F.when(F.get(bounds, at + k - 1) <= F.col("lo"), at + k).otherwise(at))
    inside = F.lead("lo").over(Window.partitionBy("_part").orderBy("lo"))
    return values.withColumn("_part", part).select("lo", F.coalesce(inside, F.get(bounds, F.col("_part"))).alias("hi"))


def _coarse(x: Column, first: float, width: float) -> Column:
    return F.floor((x - F.lit(first)) / F.lit(width)).cast("bigint")


def _fine(x: Column, first: float, width: float) -> Column:
    """The place of x among the ``_cuts`` parts of its bucket."""
    within = (x - F.lit(first)) / F.lit(width) - F.col("_bucket")
    return F.least(F.greatest(F.floor(within * F.col("_cuts")).cast("bigint"), F.lit(0).cast("bigint")), F.col("_cuts") - 1)


def interval_tables(axis: DataFrame, value: str, first: float, last: float, n: int) -> tuple[DataFrame, DataFrame, float]:
    """(bucket, cuts), (bucket, part, lo, hi) and the bucket width of an axis with two values or more."""
    width = (last - first) / (n - 1)
    values = axis.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("lo")).distinct()
    iv = _next_values(values, n).filter(F.col("hi").isNotNull())
    iv = iv.withColumn("_a", _coarse(F.col("lo"), first, width)).withColumn("_b", _coarse(F.col("hi"), first, width))
    spread = iv.withColumn("_bucket", F.explode(F.sequence("_a", "_b")))
    cuts = spread.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cuts"))
    parts = spread.join(cuts, "_bucket")
    start = F.when(F.col("_bucket") == F.col("_a"), _fine(F.col("lo"), first, width)).otherwise(F.lit(0).cast("bigint"))
    stop = F.when(F.col("_bucket") == F.col("_b"), _fine(F.col("hi"), first, width)).otherwise(F.col("_cuts") - 1)
    parts = parts.select("_bucket", F.explode(F.sequence(start, stop)).alias("_part"), "lo", "hi")
    return cuts, parts, width


def lookup_axis(points: DataFrame, x: str, axis: DataFrame, out: str, mode: str = "nearest",
                idx: str = "idx", value: str = "value", stats=None, bounded: bool = False) -> DataFrame:
    """Attach the axis value(s) for each point; one row out per row in.

    ``nearest``: column ``out`` = nearest axis value (tie -> earlier value).
    ``linear``: columns ``out``_lo, ``out``_hi, ``out``_frac with
    x = lo + frac (hi - lo); points outside the axis take the end value.
    The order of the axis' rows and gaps in its index play no part.
    ``stats`` = (first, last, n) when already known (saves one job).
    """
    if mode not in ("nearest", "linear"):
        raise ValueError(f"mode must be 'nearest' or 'linear', got {mode!r}")
    first, last, n = stats if stats is not None else axis_stats(axis, value)
    if n < 2 or first is None or last == first:
        v = F.when(F.col(x).isNotNull(), F.lit(first)).cast("double")
        if mode == "nearest":
            return points.withColumn(out, v)
        return (points.withColumn(f"{out}_lo", v).withColumn(f"{out}_hi", v)
                .withColumn(f"{out}_frac", F.when(F.col(x).isNotNull(), F.lit(0.0))))
    cuts, parts, width = interval_tables(axis, value, first, last, n)
    if bounded or n <= DEFAULT_BROADCAST_ROWS:
        cuts, parts = F.broadcast(cuts), F.broadcast(parts)
    parts = parts.select(F.col("_bucket").alias("_pb"), F.col("_part").alias("_pp"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    p = points.withColumn("_xc", F.least(F.greatest(F.col(x), F.lit(first)), F.lit(last)))
    p = p.withColumn("_xc", F.when(F.col(x).isNotNull() & ~F.isnan(x), F.col("_xc")))
    p = p.withColumn("_bucket", _coarse(F.col("_xc"), first, width)).join(cuts, "_bucket", "left")
    p = p.withColumn("_part", _fine(F.col("_xc"), first, width))
    inside = (F.col("_xc") >= F.col("_lo")) & ((F.col("_xc") < F.col("_hi")) | ((F.col("_hi") == F.lit(last)) & (F.col("_xc") == F.lit(last))))
    j = p.join(parts, (F.col("_bucket") == F.col("_pb")) & (F.col("_part") == F.col("_pp")) & inside, "left")
    if mode == "nearest":
        near = F.when(F.col("_xc") - F.col("_lo") <= F.col("_hi") - F.col("_xc"), F.col("_lo")).otherwise(F.col("_hi"))
        return j.select(*points.columns, near.alias(out))
    frac = (F.col("_xc") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    return j.select(*points.columns, F.col("_lo").alias(f"{out}_lo"), F.col("_hi").alias(f"{out}_hi"), frac.alias(f"{out}_frac"))


def phase_step(lo: Column, hi: Column) -> Column:
    """The shorter way from one phase to the next, in [-pi, pi]; from exactly opposite ones, the way as it stands.

    What unwrapping a series gives between neighbours: sums of whole turns that it adds to both don't change a gain.
    """
    turn = F.lit(2 * math.pi)
    way = F.pmod(hi - lo + F.lit(math.pi), turn) - F.lit(math.pi)
    return F.when(F.abs(hi - lo) <= F.lit(math.pi), hi - lo).otherwise(way)


def between(lo: Column, hi: Column, frac: Column) -> Column:
    return lo + (hi - lo) * frac


def phase_between(lo: Column, hi: Column, frac: Column) -> Column:
    return lo + phase_step(lo, hi) * frac


def solution_axis(sol: DataFrame, axis: str) -> DataFrame:
    """(idx, value) of a numeric solution axis, taken from the cells' positions."""
    pos_idx = F.array_position("axes", axis).cast("int")
    return (sol.filter(pos_idx > 0)
            .select(F.col("pos").getItem(pos_idx - 1).alias("idx"), F.col(axis).alias("value"))
            .distinct())
