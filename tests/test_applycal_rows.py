"""Lookup and applycal give one row out per row in, whatever the axes look like."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from visfold.operators import applycal as AC
from visfold.operators import dynamic_flagging as DF
from visfold.operators import lookup as LK
from visfold.plans.calibration_queries import two_axes_solutions
from visfold.sources import testviews as TV

AXES = {
    "ascending": [0.0, 10.0, 20.0, 30.0], "descending": [30.0, 20.0, 10.0, 0.0], "unsorted": [20.0, 0.0, 30.0, 10.0],
    "clustered": [0.0, 0.1, 0.2, 0.3, 0.4, 1e5, 1e5 + 0.1, 2e6, 2e6 + 0.01, 2e6 + 0.02], "single": [5.0], "two": [3.0, 9.0],
    "dense days": [d * 1e6 + k for d in range(4) for k in range(50)], "repeated": [1.0, 1.0, 2.0, 2.0, 7.0]}


@pytest.mark.parametrize("name", sorted(AXES))
@pytest.mark.parametrize("mode", ["nearest", "linear"])
def test_lookup_keeps_every_point(spark, name, mode):
    values = AXES[name]
    axis = spark.createDataFrame([(k * 3, v) for k, v in enumerate(values)], "idx int, value double")  # the index has gaps
    rng = np.random.default_rng(1)
    lo, hi = min(values) - 5, max(values) + 5
    xs = [*rng.uniform(lo, hi, 200).tolist(), *values, *[(a + b) / 2 for a, b in zip(values, values[1:])], None, float("nan")]
    points = spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, x double")
    got = {r["k"]: r for r in LK.lookup_axis(points, "x", axis, "y", mode=mode).collect()}
    assert len(got) == len(xs) and LK.lookup_axis(points, "x", axis, "y", mode=mode).count() == len(xs)
    ordered = np.array(sorted(set(values)))
    for k, x in enumerate(xs):
        if x is None or np.isnan(x):
            if len(ordered) > 1:
                assert got[k]["y" if mode == "nearest" else "y_lo"] is None
            continue
        if mode == "nearest":
            assert got[k]["y"] == ordered[np.abs(ordered - np.clip(x, ordered[0], ordered[-1])).argmin()]
        else:
            back = got[k]["y_lo"] + got[k]["y_frac"] * (got[k]["y_hi"] - got[k]["y_lo"])
            assert back == pytest.approx(np.clip(x, ordered[0], ordered[-1]), rel=1e-12, abs=1e-9)


def test_clustered_axis_spreads_over_buckets(spark):
    values = [d * 1e6 + k for d in range(5) for k in range(400)]
    axis = spark.createDataFrame([(v,) for v in values], "value double")
    _, parts, _ = LK.interval_tables(axis, "value", min(values), max(values), len(values))
    assert parts.groupBy("_bucket", "_part").count().agg(F.max("count")).first()[0] <= 8
    assert parts.count() <= 6 * len(values)


def counts(vis, out):
    key = ["obs_id", "slot", "ant1", "ant2", "chan"]
    return vis.count(), out.count(), out.select(*key).distinct().count()


def test_two_grids_and_directions_keep_rows(spark, vis):
    ant = TV.antenna_table(vis)
    n, m, d = counts(vis, AC.applycal(vis, two_axes_solutions(vis), ant))
    assert n == m == d
    one = TV.solution_fixture(vis, "scalar")
    many = one
    for k in range(1, 4):
        many = many.unionByName(one.withColumn("dir", F.lit(f"d{k}")))
    many = many.withColumn("dir", F.coalesce("dir", F.lit("d0")))
    with pytest.raises(ValueError, match="choose one"):
        AC.applycal(vis, many, ant)
    n, m, d = counts(vis, AC.applycal(vis, many, ant, direction="d2"))
    assert n == m == d
    with pytest.raises(ValueError, match="no direction"):
        AC.applycal(vis, many, ant, direction="nowhere")


def test_invalid_sets_are_rejected(spark, vis):
    full, ant = TV.solution_fixture(vis, "fulljones", soltypes=("phase",)), TV.antenna_table(vis)
    for sol, message in ((full, "amplitude and phase"), (TV.solution_fixture(vis, "scalar", soltypes=("amplitude", "phase", "tec")), "one soltab"),
                         (TV.solution_fixture(vis, "scalar").unionByName(TV.solution_fixture(vis, "scalar").withColumn("solset", F.lit("sol001"))), "one solution set"),
                         (TV.solution_fixture(vis, "diagonal").withColumn("pol", F.lit("ZZ")), "polarisations")):
        with pytest.raises(ValueError, match=message):
            AC.applycal(vis, sol, ant)


def test_beyond_the_broadcast_bound_the_result_is_the_same(spark, vis, monkeypatch):
    sol, ant = TV.solution_fixture(vis, "diagonal", with_freq=True), TV.antenna_table(vis)
    flat = lambda df: sorted(map(tuple, TV.flatten(df).collect()))
    small = flat(AC.applycal(vis, sol, ant))
    monkeypatch.setattr(AC, "BROADCAST_CELLS", 0)
    assert flat(AC.applycal(vis, sol, ant)) == small


@pytest.mark.parametrize("kind", ["scalar", "diagonal", "fulljones"])
def test_filter_on_flags_after_applycal(spark, vis, kind):
    out = AC.applycal(vis, TV.solution_fixture(vis, kind), TV.antenna_table(vis))
    began = time.time()
    n = out.filter("flag.xx").count()
    assert time.time() - began < 30
    assert n == out.agg(F.sum(F.col("flag.xx").cast("int"))).first()[0]


def test_long_series_in_sir(spark):
    rows = spark.range(40_000).select(F.lit(0).cast("bigint").alias("obs_id"), F.col("id").alias("slot"), F.lit(0).alias("ant1"), F.lit(1).alias("ant2"),
                                      F.lit(0).alias("chan"), ((F.col("id") * 7919) % 100 < 12).alias("fl"))
    began = time.time()
    flagged = {r["slot"] for r in DF.sir(rows, "time").filter("fl").select("slot").collect()}
    assert time.time() - began < 20
    w = np.where(np.arange(40_000) * 7919 % 100 < 12, 0.2, -0.8)
    p = np.cumsum(w)
    low = np.minimum(0, np.concatenate([[0], np.minimum.accumulate(p)[:-1]]))
    high = np.maximum.accumulate(p[::-1])[::-1]
    assert flagged == set(np.flatnonzero(np.round(high - low, 9) >= 0).tolist()) | set(np.flatnonzero(w > 0).tolist())


def test_dynamic_flag_deals_rows_once(vis):
    """All windows work on one exchange by baseline: the noise's own copies of it are the same and reused."""
    plan = DF.dynamic_flag(vis)._jdf.queryExecution().executedPlan().toString()
    dealt = {line.split("Exchange ")[1].split(", [plan_id")[0].split("#")[0] for line in plan.splitlines() if "REPARTITION_BY_COL" in line}
    assert len(dealt) == 1 and "SinglePartition" not in plan
