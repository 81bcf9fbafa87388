"""Solution axes: intervals without one task for a whole axis, phases between solutions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from visfold.operators import applycal as AC
from visfold.operators import lookup as LK
from visfold.sources import testviews as TV


@pytest.mark.parametrize("n,part", [(1, 10), (2, 1), (7, 3), (1000, 10), (1000, 999), (1000, 1000), (257, 1)])
def test_next_values_over_parts(spark, monkeypatch, n, part):
    monkeypatch.setattr(LK, "PART_VALUES", part)
    rng = np.random.default_rng(n)
    values = np.unique(np.round(rng.choice([rng.normal(), 1e6, -3.0]) + rng.exponential(size=n) ** 4, 9))
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(values)], "lo double")
    got = sorted((r["lo"], r["hi"]) for r in LK._next_values(df, len(values)).collect() if r["hi"] is not None)
    assert got == list(zip(values[:-1].tolist(), values[1:].tolist()))


def test_no_task_holds_a_long_axis(spark, monkeypatch):
    monkeypatch.setattr(LK, "PART_VALUES", 100)
    axis = spark.range(20_000).select((F.col("id") * 0.5).alias("value"))
    _, parts, _ = LK.interval_tables(axis, "value", 0.0, 9999.5, 20_000)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan
    assert parts.count() >= 19_999


def test_million_values(spark):
    n = 1_000_000
    axis = spark.range(n).select((F.col("id") * 2.0).alias("value"))
    points = spark.createDataFrame([(float(x),) for x in (-5.0, 0.0, 0.9, 1.0, 1.1, 777_777.2, 2.0 * n)], "x double")
    got = {r["x"]: r["y"] for r in LK.lookup_axis(points, "x", axis, "y", stats=(0.0, 2.0 * (n - 1), n)).collect()}
    assert got == {-5.0: 0.0, 0.0: 0.0, 0.9: 0.0, 1.0: 0.0, 1.1: 2.0, 777_777.2: 777_778.0, 2.0 * n: 2.0 * (n - 1)}


def test_phases_equal_unwrapped_interpolation(spark):
    rng = np.random.default_rng(5)
    raw = np.cumsum(rng.uniform(-3.1, 3.1, 300))
    folded = np.angle(np.exp(1j * raw))
    at = rng.uniform(0, 299, 2000)
    want = np.exp(1j * np.interp(at, np.arange(300), np.unwrap(folded)))
    lo = np.minimum(np.floor(at).astype(int), 298)
    df = spark.createDataFrame([(k, float(folded[i]), float(folded[i + 1]), float(x - i)) for k, (i, x) in enumerate(zip(lo, at))],
                               "k int, lo double, hi double, frac double")
    got = [r["p"] for r in df.select("k", LK.phase_between(F.col("lo"), F.col("hi"), F.col("frac")).alias("p")).orderBy("k").collect()]
    assert np.abs(np.exp(1j * np.array(got)) - want).max() < 1e-9


def test_amplitude_stays_between_distant_phases(spark, vis):
    sol, ant = TV.solution_fixture(vis, "scalar"), TV.antenna_table(vis)
    odd = F.col("pos")[0] % 2 == 1
    val = F.when(F.col("soltype") == "amplitude", F.lit(2.0)).otherwise(F.when(odd & (F.col("ant") == "ant1"), F.lit(3.0)).otherwise(F.lit(0.0)))
    some = vis.filter("NOT flag.xx AND ant1 <> ant2 AND (ant1 = 1 OR ant2 = 1)")
    out = AC.applycal(some, sol.withColumn("val", val), ant, mode="linear").filter("NOT flag.xx")
    power = F.sqrt(F.col("data.xx.re") ** 2 + F.col("data.xx.im") ** 2)
    before = some.select("obs_id", "slot", "ant1", "ant2", "chan", power.alias("b"))
    ratios = out.select("obs_id", "slot", "ant1", "ant2", "chan", power.alias("a")).join(before, ["obs_id", "slot", "ant1", "ant2", "chan"]).filter("b > 0")
    low, high, n = ratios.agg(F.min(F.col("a") / F.col("b")), F.max(F.col("a") / F.col("b")), F.count(F.lit(1))).first()
    assert n > 0 and low == pytest.approx(0.25, rel=1e-9) and high == pytest.approx(0.25, rel=1e-9)
