"""Time/frequency averaging, power and closeness aggregates.

``average`` is one ``groupBy`` on (obs_id, ant1, ant2, time bin, channel bin):
Spark plans a partial HashAggregate before the exchange, so only one row per
bin and map task crosses the shuffle. A bin holds at most timestep x freqstep
samples, so no group can grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cplx as C
from ..plans.joins import per_observation

POLS = C.POLS


def _check_step(name: str, value) -> int:
    if not isinstance(value, int) or isinstance(value, bool) or value < 1:
        raise ValueError(f"{name} must be an integer >= 1, got {value!r}")
    return value


def with_relative_slot(vis: DataFrame, obs_first: DataFrame | int | None = None) -> DataFrame:
    """Add ``rel_slot`` = slot - first slot of the observation.

    ``obs_first`` (obs_id, first_slot) may come from observation metadata, or be one number for all;
    otherwise it is a one-row-per-observation aggregate over a scan of its own.
    """
    if isinstance(obs_first, int):
        return vis.withColumn("rel_slot", F.col("slot") - F.lit(obs_first))
    if obs_first is None:
        obs_first = vis.groupBy("obs_id").agg(F.min("slot").alias("first_slot"))
    return (vis.join(per_observation(obs_first.select("obs_id", "first_slot")), "obs_id")
            .withColumn("rel_slot", F.col("slot") - F.col("first_slot")).drop("first_slot"))


def usable(p: str) -> Column:
    """Is a sample of polarisation ``p`` unflagged, and are its value and weight finite?"""
    d = F.col("data").getField(p)
    finite = d.getField("re") * 0.0 + d.getField("im") * 0.0 + F.col("weight") * 0.0 == 0.0
    return ~F.col("flag").getField(p) & F.coalesce(finite, F.lit(False))


def _bin_aggs(key_cols: list[str]) -> list[Column]:
    aggs = []
    for p in POLS:
        ok = usable(p)
        wp = F.when(ok, F.col("weight")).otherwise(F.lit(0.0))
        d = F.col("data").getField(p)
        aggs += [
            F.sum(F.when(ok, wp * d.getField("re")).otherwise(F.lit(0.0))).alias(f"_swr_{p}"),
            F.sum(F.when(ok, wp * d.getField("im")).otherwise(F.lit(0.0))).alias(f"_swi_{p}"),
            F.sum(wp).alias(f"_sw_{p}"),
            F.count_if(ok).alias(f"_n_{p}"),
            F.avg(d.getField("re")).alias(f"_ar_{p}"),
            F.avg(d.getField("im")).alias(f"_ai_{p}"),
        ]
    any_ok = None
    for p in POLS:
        ok = usable(p)
        any_ok = ok if any_ok is None else (any_ok | ok)
    aggs += [
        F.sum(F.when(any_ok, F.col("weight")).otherwise(F.lit(0.0))).alias("weight"),
        F.avg("time").alias("time"), F.avg("freq").alias("freq"),
        F.avg("u").alias("u"), F.avg("v").alias("v"), F.avg("w").alias("w"),
    ]
    return aggs


def _finish(df: DataFrame, keys: list[str]) -> DataFrame:
    data, flag = [], []
    for p in POLS:
        has = F.col(f"_n_{p}") > 0
        wavg = C.cpx(F.try_divide(F.col(f"_swr_{p}"), F.col(f"_sw_{p}")),
                     F.try_divide(F.col(f"_swi_{p}"), F.col(f"_sw_{p}")))
        data.append(F.when(has, wavg).otherwise(C.cpx(F.col(f"_ar_{p}"), F.col(f"_ai_{p}"))).alias(p))
        flag.append((~has).alias(p))
    return df.select(*keys, "time", "freq", "u", "v", "w", "weight",
                     F.struct(*data).alias("data"), F.struct(*flag).alias("flag"))


def average(vis: DataFrame, timestep: int = 1, freqstep: int = 1,
            obs_first: DataFrame | int | None = None) -> DataFrame:
    """Average ``timestep`` consecutive slots and ``freqstep`` consecutive channels.

    Only unflagged samples with a finite value and weight contribute, weighted by ``weight``; the output
    weight is the sum of contributing weights. A bin without such an input
    (per polarisation) is flagged and carries the plain mean.
    time/freq/u/v/w are plain means; the last partial bin is kept. Output
    ``slot`` and ``chan`` are the bin numbers.
    """
    timestep = _check_step("timestep", timestep)
    freqstep = _check_step("freqstep", freqstep)
    v = with_relative_slot(vis, obs_first) if timestep > 1 else vis.withColumn("rel_slot", F.col("slot"))
    v = v.withColumn("_tbin", F.floor(F.col("rel_slot") / F.lit(float(timestep))).cast("bigint") if timestep > 1
                     else F.col("slot").cast("bigint"))
    v = v.withColumn("_fbin", F.floor(F.col("chan") / F.lit(float(freqstep))).cast("int"))
    keys = ["obs_id", "_tbin", "ant1", "ant2", "_fbin"]
    agg = v.groupBy(*keys).agg(*_bin_aggs(keys))
    out = _finish(agg, keys)
    return out.withColumnRenamed("_tbin", "slot").withColumnRenamed("_fbin", "chan").select(
        "obs_id", "slot", "time", "ant1", "ant2", "chan", "freq", "u", "v", "w", "weight", "data", "flag")


def average_time(vis: DataFrame, timestep: int, obs_first: DataFrame | None = None) -> DataFrame:
    return average(vis, timestep=timestep, freqstep=1, obs_first=obs_first)


def average_freq(vis: DataFrame, freqstep: int) -> DataFrame:
    return average(vis, timestep=1, freqstep=freqstep)


def rms_power(vis: DataFrame, by: tuple[str, ...] = ("obs_id",)) -> DataFrame:
    """sqrt(mean |v|^2) over samples x polarisations; flagged samples count as zero."""
    terms = [F.when(F.col("flag").getField(p), F.lit(0.0)).otherwise(C.c_abs2(F.col("data").getField(p)))
             for p in POLS]
    s = terms[0]
    for t in terms[1:]:
        s = s + t
    return vis.groupBy(*by).agg(F.sqrt(F.sum(s) / (F.count(F.lit(1)) * F.lit(float(len(POLS))))).alias("rms"))


def vis_allclose(a: DataFrame, b: DataFrame, rtol: float = 1e-5, atol: float = 1e-8,
                 key=("obs_id", "slot", "ant1", "ant2", "chan"), by=("obs_id",)) -> DataFrame:
    """numpy-style allclose of two visibility sets, one row per ``by`` group.

    |a - b| <= atol + rtol |b| for every polarisation of every matched sample;
    a sample present on one side only counts as not close.
    """
    left = a.select(*key, F.col("data").alias("_a"))
    right = b.select(*key, F.col("data").alias("_b"))
    j = left.join(right, list(key), "full_outer")
    ok = None
    diff = None
    for p in POLS:
        d = C.c_abs(C.c_sub(F.col("_a").getField(p), F.col("_b").getField(p)))
        c = d <= F.lit(float(atol)) + F.lit(float(rtol)) * C.c_abs(F.col("_b").getField(p))
        ok = c if ok is None else (ok & c)
        diff = d if diff is None else F.greatest(diff, d)
    ok = F.coalesce(ok, F.lit(False))
    return j.groupBy(*by).agg(F.bool_and(ok).alias("all_close"), F.max(diff).alias("max_abs_diff"),
                              F.count(F.lit(1)).alias("n"))
