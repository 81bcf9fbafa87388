"""The flagger on pure noise and on injected interference; exact noise; windows against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from visfold.functions.robust import median_and_deviation
from visfold.operators import dynamic_flagging as DF
from visfold.schemas import VIS

SLOTS, CHANS = 120, 24


def plane(spark, amplitude, flags=None, ant2=1):
    """A baseline whose polarisations all have these amplitudes (slot x channel)."""
    flags = np.zeros(amplitude.shape, bool) if flags is None else flags
    z = {"re": 0.0, "im": 0.0}
    rows = []
    for t in range(amplitude.shape[0]):
        for c in range(amplitude.shape[1]):
            d = {p: {"re": float(amplitude[t, c]), "im": 0.0} for p in ("xx", "xy", "yx", "yy")}
            f = {p: bool(flags[t, c]) for p in d}
            rows.append((0, t, float(t), 0, ant2, c, 1e9 + c, 0.0, 0.0, 0.0, 1.0, d, f))
    return spark.createDataFrame(rows, VIS).repartition(3), z


def flagged(spark, amplitude, flags=None, **kw):
    df, _ = plane(spark, amplitude, flags)
    out = np.zeros(amplitude.shape, bool)
    for r in DF.dynamic_flag(df, **kw).select("slot", "chan", "flag.xx").collect():
        out[r[0], r[1]] = r[2]
    return out


def noise(seed, level=10.0):
    """Noise on a background that drifts over time and frequency."""
    t, c = np.mgrid[0:SLOTS, 0:CHANS]
    return level + 2 * np.sin(t / 40) + 0.05 * c + np.random.default_rng(seed).normal(size=(SLOTS, CHANS))


def bursts():
    one = {"sample": np.zeros((SLOTS, CHANS)), "four slots": np.zeros((SLOTS, CHANS)), "sixteen slots": np.zeros((SLOTS, CHANS)),
           "one channel": np.zeros((SLOTS, CHANS)), "one slot": np.zeros((SLOTS, CHANS))}
    for t, c in [(10, 3), (50, 20), (77, 11), (100, 0)]:
        one["sample"][t, c] = 12
    one["four slots"][30:34, 5] = one["four slots"][90:94, 17] = 8
    one["sixteen slots"][20:36, 9] = one["sixteen slots"][70:86, 2] = 6
    one["one channel"][:, 12] = 6
    one["one slot"][60, :] = 8
    return one


@pytest.mark.parametrize("seed", [1, 2])
def test_clean_noise_is_kept(spark, seed):
    assert flagged(spark, noise(seed)).mean() <= 0.02


@pytest.mark.parametrize("name", sorted(bursts()))
def test_injected_bursts_are_found(spark, name):
    burst = bursts()[name]
    found = flagged(spark, noise(3) + burst)
    assert found[burst > 0].mean() >= 0.95
    assert found[burst == 0].mean() <= 0.03


def test_strong_interference_leaves_its_neighbours(spark):
    """Far above the noise in all kinds at once: the first rounds take it out of the background."""
    burst = sum(bursts().values()) * 30
    found = flagged(spark, noise(4) + burst)
    assert found[burst > 0].mean() >= 0.95 and found[burst == 0].mean() <= 0.05


def test_non_finite_samples_are_flagged_and_harmless(spark):
    amplitude = noise(5)
    amplitude[7, 7], amplitude[8, 9], amplitude[50, :3] = np.nan, np.inf, np.nan
    found = flagged(spark, amplitude)
    assert found[~np.isfinite(amplitude)].all()
    assert found[np.isfinite(amplitude)].mean() <= 0.02


def test_planes_without_noise_or_samples(spark):
    assert not flagged(spark, np.full((20, 6), 5.0)).any(), "no spread, no threshold"
    assert flagged(spark, noise(6)[:20, :6], np.ones((20, 6), bool)).all(), "all flagged before: nothing changes"
    assert flagged(spark, noise(6)[:1, :1]).shape == (1, 1)
    df, _ = plane(spark, noise(6)[:5, :2])
    assert DF.dynamic_flag(df.limit(0)).count() == 0


def test_query_fixture_is_neither_clean_nor_all_flagged(spark):
    from tests.conftest import SF_SMALL
    from visfold.plans.queries import QUERIES

    share = QUERIES["dynamic_flag"](spark, SF_SMALL).agg(F.avg(F.col("flag_xx").cast("int"))).first()[0]
    assert 0.02 < share < 0.40


def brute_sumthreshold(values, flags, chi1, sizes):
    fl = list(flags)
    for m in sizes:
        chi = chi1 / 1.5 ** (m.bit_length() - 1)
        over = [0 if f else v - chi for v, f in zip(values, fl)]
        hit = [False] * len(fl)
        for i in range(len(fl) - m + 1):
            if sum(over[i:i + m]) > 1e-6 * chi:
                hit[i:i + m] = [True] * m
        fl = [a or b for a, b in zip(fl, hit)]
    return fl


@pytest.mark.parametrize("seed", range(3))
def test_sumthreshold_equals_brute_force(spark, seed):
    r = np.random.default_rng(seed)
    values, flags = r.normal(size=150), r.random(150) < 0.1
    values[40:48] += 2.0
    values[100:140] += 1.0
    rows = [(0, t, 0, 1, 0, float(v), bool(f), 0.0, 0.5) for t, (v, f) in enumerate(zip(values, flags))]
    df = spark.createDataFrame(rows, "obs_id long, slot long, ant1 int, ant2 int, chan int, resid double, fl boolean, centre double, noise double")
    got = [x["fl"] for x in DF.sumthreshold(df, "time", 4.0, (1, 2, 4, 8, 16, 32)).orderBy("slot").collect()]
    assert got == brute_sumthreshold(values.tolist(), flags.tolist(), 2.0, (1, 2, 4, 8, 16, 32))


def test_largest_size_costs_no_more_per_row(spark):
    """Every frame is an offset or grows by a row: windows of 2^14 rows over a long series end quickly."""
    import time

    n = 60_000
    rows = spark.range(n).selectExpr("0L AS obs_id", "id AS slot", "0 AS ant1", "1 AS ant2", "0 AS chan", "CAST(pmod(hash(id), 100) AS DOUBLE) / 100 AS resid",
                                     "false AS fl", "0D AS centre", "1D AS noise")
    began = time.time()
    DF.sumthreshold(rows, "time", 6.0, (1, 2, 2 ** 14)).filter("fl").count()
    assert time.time() - began < 20


def test_noise_is_exact_without_windows(spark):
    r = np.random.default_rng(1)
    groups = [r.normal(size=4001), r.normal(size=3000) * 1e3 + 7, np.full(100, 3.0), np.repeat([1.0, 2.0], 50), np.array([4.0]), np.array([1.0, 9.0]),
              r.exponential(size=5000), np.concatenate([np.zeros(3000), r.normal(size=100)]), r.integers(0, 5, 999).astype(float),
              np.concatenate([r.normal(size=3000), r.normal(size=2000) * 50 + 500])]
    rows = [(g, float(v)) for g, values in enumerate(groups) for v in values] + [(99, None), (1, None), (1, float("nan")), (2, float("inf"))]
    df = spark.createDataFrame(rows, "g int, v double").repartition(4)
    found = median_and_deviation(df, ["g"], "v")
    got = {x["g"]: (x["n"], x["median"], x["mad"]) for x in found.collect()}
    assert set(got) == set(range(len(groups)))
    for g, values in enumerate(groups):
        m = np.median(values)
        np.testing.assert_allclose(got[g], (len(values), m, np.median(np.abs(values - m))), rtol=1e-12)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_tasks_grow_with_the_rows(spark, vis, monkeypatch):
    few = DF.dynamic_flag(vis.filter("slot < 5")).select("obs_id", "slot", "ant1", "ant2", "chan", "flag")
    monkeypatch.setattr(DF, "ROWS_PER_TASK", 20)
    some = vis.filter("slot < 5")
    assert DF._tasks(some) == -(-some.count() // 20) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = DF.dynamic_flag(some).select(few.columns)
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
