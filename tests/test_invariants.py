"""Physical invariants and brute-force checks of the window and lookup operators."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from visfold.functions import cplx as C
from visfold.operators import applycal as AC
from visfold.operators import averaging as A
from visfold.operators import demix as DX
from visfold.operators import dynamic_flagging as DF
from visfold.operators import flagging as FL
from visfold.operators import lookup as LK
from visfold.operators import predict as PR
from visfold.sources import testviews as TV
from visfold.sources import visibilities as VI


def close_all(a, b, **kw):
    return all(r.all_close for r in A.vis_allclose(a, b, **kw).collect())


def test_identity_gain_tables_preserve_visibilities(vis):
    ant = TV.antenna_table(vis)
    out = vis
    for kind in ("scalar", "diagonal", "fulljones"):
        out = AC.applycal(out, TV.solution_fixture(vis, kind, identity=True), ant)
    assert close_all(vis, out)


def _inverse(sol):
    inv = F.when(F.col("soltype") == "amplitude", F.lit(1.0) / F.col("val")).otherwise(-F.col("val"))
    return sol.withColumn("val", inv)


@pytest.mark.parametrize("kind", ["scalar", "diagonal"])
def test_apply_then_inverse_is_identity(vis, kind):
    ant = TV.antenna_table(vis)
    sol = TV.solution_fixture(vis, kind)
    out = AC.applycal(AC.applycal(vis, sol, ant), _inverse(sol), ant)
    assert close_all(vis, out, rtol=1e-9, atol=1e-9)


def test_fulljones_apply_matches_diagonal_when_off_diagonal_is_zero(vis):
    ant = TV.antenna_table(vis)
    diag = TV.solution_fixture(vis, "diagonal")
    full = TV.solution_fixture(vis, "fulljones").withColumn(
        "val", F.when(F.col("pol").isin("XY", "YX") & (F.col("soltype") == "amplitude"), F.lit(0.0))
        .otherwise(F.col("val")))
    assert close_all(AC.applycal(vis, diag, ant), AC.applycal(vis, full, ant), rtol=1e-9, atol=1e-9)


def test_missing_solution_flags_and_keeps_data(vis):
    ant = TV.antenna_table(vis)
    sol = TV.solution_fixture(vis, "scalar").filter(F.col("ant") != "ant3")
    out = AC.applycal(vis, sol, ant)
    r = out.filter((F.col("ant1") == 3) | (F.col("ant2") == 3)).agg(
        F.bool_and(F.col("flag.xx")).alias("all_flagged")).collect()[0]
    assert r.all_flagged
    same = out.filter((F.col("ant1") == 3)).select("obs_id", "slot", "ant1", "ant2", "chan", "data")
    assert close_all(vis.filter(F.col("ant1") == 3), same.join(vis.select("obs_id", "slot", "ant1", "ant2", "chan", "time", "freq", "u", "v", "w", "weight", "flag"), ["obs_id", "slot", "ant1", "ant2", "chan"]))


def test_average_one_by_one_is_identity_on_unflagged(vis):
    clean = FL.clear_flags(vis)
    out = A.average(clean, 1, 1)
    assert close_all(clean, out, rtol=1e-12, atol=1e-12)


def test_average_rejects_bad_steps(vis):
    with pytest.raises(ValueError):
        A.average(vis, 0, 1)
    with pytest.raises(ValueError):
        A.average(vis, 1, 1.5)


def test_clear_after_set_leaves_no_flags(vis):
    out = FL.clear_flags(FL.flag_channels(vis, "[0..nchan]"), chan="[0..nchan]")
    assert out.filter(F.col("flag.xx") | F.col("flag.yy")).count() == 0


def test_preflagger_without_criteria_is_a_no_op(vis):
    assert FL.preflag(vis).filter(F.col("flag.xx")).count() == vis.filter(F.col("flag.xx")).count()


def test_parse_ranges():
    assert FL.parse_freq_ranges("[960..961 MHz, 1.2GHz+-5MHz]") == [(960e6, 961e6), (1.195e9, 1.205e9)]
    assert FL.parse_channel_ranges("[0..nchan, 7]") == [(0, None), (7, 7)]


def test_split_then_combine_complex(vis):
    d = F.col("data").getField("xx")
    pol = AC.complex_to_polar(d)
    back = AC.polar_to_complex(pol.getField("amplitude"), pol.getField("phase"))
    r = vis.select(F.max(C.c_abs(C.c_sub(back, d))).alias("m")).collect()[0]
    assert r.m < 1e-9


def test_per_observation_independence(spark, vis):
    both = VI.union_observations(vis, vis.withColumn("obs_id", F.col("obs_id") + 7))
    a = DF.dynamic_flag(both).filter(F.col("obs_id") < 7)
    b = DF.dynamic_flag(vis)
    key = ["obs_id", "slot", "ant1", "ant2", "chan"]
    diff = a.select(*key, F.col("flag.xx").alias("fa")).join(
        b.select(*key, F.col("flag.xx").alias("fb")), key).filter(F.col("fa") != F.col("fb")).count()
    assert diff == 0


def test_point_source_at_phase_centre_predicts_constant(spark, vis):
    comps = spark.createDataFrame([("c", "POINT", "p", 0.0, 0.0, 2.5)],
                                  "name string, type string, patch string, l double, m double, flux_i double")
    out = PR.predict(vis, comps)
    r = out.agg(F.max(F.abs(F.col("data.xx.re") - 2.5)).alias("a"), F.max(F.abs("data.xx.im")).alias("b"),
                F.max(F.abs("data.xy.re")).alias("c")).collect()[0]
    assert r.a < 1e-12 and r.b < 1e-12 and r.c == 0.0


def test_predict_of_many_components_equals_brute_force(spark, vis):
    """Spectra (both kinds), Gaussians and plain points by (ra, dec), summed in numpy."""
    from visfold.functions import sky as SK
    rng = np.random.default_rng(3)
    rows = [(f"c{k}", "GAUSSIAN" if k % 3 == 0 else "POINT", f"p{k % 3}", 0.9 + 1e-3 * rng.random(), -0.5 + 1e-3 * rng.random(),
             1.0 + k, [-0.7, 0.1 * (k % 2)] if k % 4 else None, bool(k % 2), 1.4e8 if k % 5 else None, 60.0, 30.0, 10.0 * k) for k in range(150)]
    comps = spark.createDataFrame(rows, "name string, type string, patch string, ra double, dec double, flux_i double, si array<double>, "
                                        "log_si boolean, ref_freq double, major double, minor double, orientation double")
    ra0, dec0 = 0.9, -0.5
    meta = vis.select("obs_id").distinct().withColumn("ra0", F.lit(ra0)).withColumn("dec0", F.lit(dec0))
    some = vis.filter("slot < 3")
    got = PR.predict(some, comps, meta).select("u", "v", "w", "freq", "data.xx.re", "data.xx.im").toPandas()
    want = np.zeros(len(got), complex)
    f, c = got.freq.to_numpy(), SK.SPEED_OF_LIGHT
    u, v, w = (got[k].to_numpy() * f / c for k in "uvw")
    for _, kind, _, ra, dec, flux, si, log_si, ref, major, minor, pa in rows:
        l_ = np.cos(dec) * np.sin(ra - ra0)
        m_ = np.sin(dec) * np.cos(dec0) - np.cos(dec) * np.sin(dec0) * np.cos(ra - ra0)
        n_ = np.sqrt(1 - l_ * l_ - m_ * m_)
        x, si = (f / ref if ref else np.ones_like(f)), (si or []) if ref else []
        amp = flux * x ** sum(s * np.log10(x) ** k for k, s in enumerate(si)) if log_si else flux + sum(s * (x - 1) ** (k + 1) for k, s in enumerate(si))
        if kind == "GAUSSIAN":
            p, sm, sn = np.radians(pa), major * SK.ARCSEC * SK.FWHM_TO_SIGMA, minor * SK.ARCSEC * SK.FWHM_TO_SIGMA
            amp = amp * np.exp(-2 * np.pi ** 2 * ((sm * (u * np.sin(p) + v * np.cos(p))) ** 2 + (sn * (u * np.cos(p) - v * np.sin(p))) ** 2))
        want += amp * np.exp(-2j * np.pi * (u * l_ + v * m_ + w * (n_ - 1)))
    assert np.allclose(got.re + 1j * got.im, want, rtol=1e-9, atol=1e-6)


def test_predict_by_ra_dec_needs_phase_centres(spark, vis):
    comps = spark.createDataFrame([("c", "POINT", "p", 0.1, 0.2, 1.0)], "name string, type string, patch string, ra double, dec double, flux_i double")
    with pytest.raises(ValueError, match="obs_meta"):
        PR.predict(vis, comps)


def test_demix_of_predicted_sky_leaves_noise_floor(spark, vis):
    clean = FL.clear_flags(vis)
    comps = TV.sky_components(spark)
    model = PR.predict(clean, comps).cache()
    out, gains = DX.demix(model, comps, subtract=["bright_a", "bright_b"])
    rin = A.rms_power(model, by=()).collect()[0].rms
    rout = A.rms_power(out, by=()).collect()[0].rms
    assert rout < 1e-7 * rin
    assert gains.filter(F.col("g_re").isNull()).count() == 0


def test_demix_rejects_unknown_patch(spark, vis):
    with pytest.raises(ValueError):
        DX.demix(vis, TV.sky_components(spark), subtract=["nope"])


def test_solver_recovers_gains_on_synthetic_problem():
    rng = np.random.default_rng(7)
    na, D = 8, 2
    gt = (1 + 0.2 * rng.standard_normal((na, D))) * np.exp(1j * rng.uniform(-1, 1, (na, D)))
    rows = []
    for _ in range(6):
        for a in range(na):
            for b in range(a + 1, na):
                m = rng.standard_normal(D) + 1j * rng.standard_normal(D)
                v = sum(gt[a, d] * m[d] * np.conj(gt[b, d]) for d in range(D))
                r = dict(obs_id=0, tsol=0, fsol=0, ant1=a, ant2=b, w=1.0, vxx_re=v.real, vxx_im=v.imag,
                         vyy_re=v.real, vyy_im=v.imag)
                for d in range(D):
                    r[f"m{d}_re"], r[f"m{d}_im"] = m[d].real, m[d].imag
                rows.append(r)
    pdf = pd.DataFrame(rows)
    out = DX.solve_group(pdf, D)
    g = np.zeros((na, D), complex)
    for r in out.itertuples():
        g[r.ant, r.patch_idx] = r.g_re + 1j * r.g_im
    worst = 0.0
    for r in pdf.itertuples():
        mod = sum(g[r.ant1, d] * (getattr(r, f"m{d}_re") + 1j * getattr(r, f"m{d}_im")) * np.conj(g[r.ant2, d])
                  for d in range(D))
        worst = max(worst, abs(r.vxx_re + 1j * r.vxx_im - mod))
    assert worst < 1e-7


# ----------------------------------------------------------- brute force

def _sir_brute(flags, eta):
    n = len(flags)
    out = list(flags)
    for i in range(n):
        for a in range(i + 1):
            for b in range(i, n):
                seg = flags[a:b + 1]
                if sum(seg) >= (1 - eta) * len(seg) - 1e-12:
                    out[i] = True
    return out


def _series(spark, values, flags):
    rows = [(0, t, 0, 1, 0, float(v), bool(f)) for t, (v, f) in enumerate(zip(values, flags))]
    return spark.createDataFrame(rows, "obs_id long, slot long, ant1 int, ant2 int, chan int, resid double, fl boolean")


def test_sir_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    flags = [bool(x) for x in rng.random(40) < 0.35]
    df = DF.sir(_series(spark, [0.0] * 40, flags), "time", 0.2)
    got = [r.fl for r in df.orderBy("slot").collect()]
    assert got == _sir_brute(flags, 0.2)


def test_nearest_and_linear_lookup_match_brute_force(spark):
    axis_vals = [0.0, 1.0, 1.5, 4.0, 10.0]
    axis = spark.createDataFrame(list(enumerate(axis_vals)), "idx int, value double")
    pts = [-1.0, 0.0, 0.4, 0.5, 0.6, 1.25, 2.75, 3.9, 7.0, 10.0, 12.0]
    p = spark.createDataFrame([(x,) for x in pts], "x double")
    near = {r.x: r.n for r in LK.lookup_axis(p, "x", axis, "n").collect()}
    for x in pts:
        best = min(axis_vals, key=lambda a: (abs(a - x), a))
        assert near[x] == best, x
    lin = {r.x: (r.t_lo, r.t_hi, r.t_frac) for r in LK.lookup_axis(p, "x", axis, "t", mode="linear").collect()}
    for x in pts:
        lo, hi, f = lin[x]
        xc = min(max(x, axis_vals[0]), axis_vals[-1])
        assert math.isclose(lo + f * (hi - lo), xc, abs_tol=1e-12)


def test_range_join_matches_literal_predicates(vis):
    rng = np.random.default_rng(11)
    ranges = []
    for _ in range(50):
        lo = 9.595e8 + rng.uniform(0, 5e6)
        ranges.append((lo, lo + rng.choice([1e3, 2e5, 3e6])))
    ranges.append((9.5e8, 9.7e8))  # one range covering everything
    a = FL.range_join_flags(vis, ranges[:-1])
    b = FL.flag_freq_ranges(vis, ranges[:-1], literal_limit=10_000)
    key = ["obs_id", "slot", "ant1", "ant2", "chan"]
    diff = (a.select(*key, F.col("flag.xx").alias("fa")).join(b.select(*key, F.col("flag.xx").alias("fb")), key)
            .filter(F.col("fa") != F.col("fb")).count())
    assert diff == 0
    assert FL.range_join_flags(vis, ranges).filter(~F.col("flag.yy")).count() == 0
