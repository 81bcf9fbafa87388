"""Patches told apart by undoing the mixing, against numpy bin by bin; gains of patches within one fringe."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from visfold.functions import cplx as C
from visfold.functions import sky as SK
from visfold.operators import averaging as A
from visfold.operators import demix as DX
from visfold.operators import flagging as FL
from visfold.operators import predict as PR
from visfold.operators import unmix as UM

CENTRES = [(1e-2, 2e-2, 1.0), (-2e-2, 1e-2, 0.5), (0.0, -3e-2, 2.0)]
BINS = dict(timestep=4, freqstep=4, solint_t=5, solint_f=1)


def sky(spark, n=3):
    return spark.createDataFrame([(f"c{k}", f"p{k}", *CENTRES[k]) for k in range(n)], "name string, patch string, l double, m double, flux_i double")


def rotations(pdf, n):
    k = 2 * np.pi * pdf.freq.to_numpy() / SK.SPEED_OF_LIGHT
    out = []
    for l_, m_, _ in CENTRES[:n]:
        out.append(np.exp(1j * k * (pdf.u * l_ + pdf.v * m_ + pdf.w * (np.sqrt(1 - l_ * l_ - m_ * m_) - 1)).to_numpy()))
    return np.stack(out, axis=1)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_equals_numpy_bin_by_bin(spark, vis, n):
    some = vis.filter("obs_id = 0 AND slot < 12").withColumn(  # a non-finite sample takes no part
        "data", F.when((F.col("slot") == 1) & (F.col("ant2") == 2), C.jones(*[C.cpx(F.lit(float("nan")), F.lit(0.0))] * 4)).otherwise(F.col("data")))
    comps = sky(spark, n)
    vm, _ = PR.patch_models(some, comps)
    got = UM.unmix_average(vm, UM.patch_centres(comps), **BINS).toPandas().set_index(["tbin", "ant1", "ant2", "patch_idx"])
    raw = some.filter("ant1 <> ant2").select("slot", "ant1", "ant2", "u", "v", "w", "freq", "weight", F.col("data.xx.re").alias("re"),
                                             F.col("data.xx.im").alias("im"), (F.col("flag.xx") | F.col("flag.yy")).alias("f")).toPandas()
    raw = raw[~raw.f & np.isfinite(raw.re)]
    checked = 0
    for (tbin, a1, a2), g in raw.groupby([raw.slot // 4, raw.ant1, raw.ant2]):
        rot, w = rotations(g, n), g.weight.to_numpy()
        mixed = (w[:, None] * rot * (g.re + 1j * g.im).to_numpy()[:, None]).sum(0) / w.sum()
        mix = np.einsum("s,sd,se->de", w, rot, rot.conj()) / w.sum()
        if np.linalg.cond(mix) > UM.MAX_CONDITION:
            assert (tbin, a1, a2, 0) not in got.index
            continue
        want, noise = np.linalg.solve(mix, mixed), np.linalg.inv(mix).diagonal().real
        for d in range(n):
            row = got.loc[(tbin, a1, a2, d)]
            assert abs(row.vxx_re + 1j * row.vxx_im - want[d]) <= 1e-7 * np.abs(want).max()
            assert row.w == pytest.approx(w.sum() / noise[d], rel=1e-6)
            checked += 1
    assert checked == len(got) and checked > 6


def test_patches_within_one_fringe_are_separated(spark, vis):
    """Simulated with gains per antenna and direction; the phase between the patches turns by less than a fringe in any bin."""
    comps = sky(spark, 2)
    vm, patches = PR.patch_models(FL.clear_flags(vis).filter("ant1 <> ant2"), comps)
    total = C.c_zero()
    for d in range(2):
        amp = (1 + 0.05 * (d + 1) * F.col("ant1")) * (1 + 0.05 * (d + 1) * F.col("ant2"))
        total = C.c_add(total, C.c_mul(F.col(f"model_{d}"), C.c_from_polar(amp, 0.1 * (d + 1) * (F.col("ant1") - F.col("ant2")))))
    sim = vm.withColumn("_s", total).withColumn("data", PR.unpolarised(F.col("_s"))).select(vis.columns).cache()
    pts = sim.select("slot", "ant1", "ant2", "u", "v", "w", "freq").toPandas()
    between = [c[0] - CENTRES[1][i] for i, c in enumerate(zip(CENTRES[0][:2]))]
    pts["turns"] = pts.freq / SK.SPEED_OF_LIGHT * (pts.u * between[0] + pts.v * between[1])
    spread = pts.groupby([pts.slot // 4, "ant1", "ant2"]).turns.agg(lambda x: x.max() - x.min())
    assert 0 < spread.max() < 1
    out, gains = DX.demix(sim, comps, method="unmix", **BINS)
    before, after = A.rms_power(sim).collect()[0]["rms"], A.rms_power(FL.clear_flags(out)).collect()[0]["rms"]
    assert after < 1e-7 * before
    assert out.filter("flag.xx").count() == 0 and set(gains.select("patch").distinct().toPandas().patch) == {"p0", "p1"}


def test_a_bin_of_one_sample_has_no_rows_and_its_data_is_flagged(spark, vis):
    one = FL.clear_flags(vis).filter("slot = 3 AND chan = 0")
    out, _ = DX.demix(one, sky(spark, 2), method="unmix", **BINS)
    r = out.agg(F.min(F.col("flag.xx").cast("int")).alias("f"), F.count(F.lit(1)).alias("n")).first()
    assert r.n == one.count() and r.f == 1


def test_empty_input(spark, vis):
    comps = sky(spark, 2)
    vm, _ = PR.patch_models(vis.limit(0), comps)
    assert UM.unmix_average(vm, UM.patch_centres(comps), **BINS).count() == 0


def test_centres_by_ra_dec_follow_the_phase_centre(spark, vis):
    comps = spark.createDataFrame([("a", "p", 0.9, -0.5, 1.0), ("b", "p", 0.902, -0.5, 3.0)], "name string, patch string, ra double, dec double, flux_i double")
    centre, = UM.patch_centres(comps)
    assert abs(centre["ra"] - 0.9015) < 1e-6 and abs(centre["dec"] + 0.5) < 1e-6
    meta = vis.select("obs_id").distinct().withColumn("ra0", F.lit(0.9015)).withColumn("dec0", F.lit(-0.5))
    r = UM.with_rotations(vis, [centre], meta).agg(F.max(F.abs(F.hypot("rot_0_re", "rot_0_im") - 1)).alias("a"), F.max(F.abs("rot_0_im")).alias("b")).first()
    assert r.a < 1e-12 and r.b < 0.05
    with pytest.raises(ValueError):
        UM.with_rotations(vis, [centre])


@pytest.mark.parametrize("radec", [False, True])
def test_a_sky_in_blocks_equals_one_constant(spark, vis, radec):
    rng = np.random.default_rng(5)
    rows = [(f"c{k}", "GAUSSIAN" if k % 3 == 0 else "POINT", f"p{k % 3}" if k % 7 else None, *(rng.random(2) * 1e-2).tolist(), 0.9 + 1e-3 * float(rng.random()),
             -0.5 + 1e-3 * float(rng.random()), 1.0 + k, 60.0, 30.0, 10.0 * k) for k in range(90)]
    comps = spark.createDataFrame(rows, "name string, type string, patch string, l double, m double, ra double, dec double, flux_i double, "
                                        "major double, minor double, orientation double")
    if radec:
        comps = comps.drop("l", "m")
    meta = vis.select("obs_id").distinct().withColumn("ra0", F.lit(0.9)).withColumn("dec0", F.lit(-0.5))
    some = vis.filter("slot < 3")
    some = some.unionAll(some.filter("chan = 0")).unionAll(some.filter("chan = 1").limit(2).withColumn("u", F.lit(None).cast("double")))
    key = ["obs_id", "slot", "ant1", "ant2", "chan", "u", "re", "im"]

    def flat(df):
        pdf = df.select("obs_id", "slot", "ant1", "ant2", "chan", "u", "data.xx.re", "data.xx.im").toPandas()
        return pdf.sort_values(key[:6]).reset_index(drop=True)
    a, b = flat(PR.predict(some, comps, meta)), flat(PR.predict(some, comps, meta, max_components=10, block=8))
    assert len(a) == len(b) == some.count()
    assert np.array_equal(a[["re", "im"]].isna(), b[["re", "im"]].isna())
    assert np.nanmax(np.abs(a[["re", "im"]].to_numpy() - b[["re", "im"]].to_numpy())) < 1e-7
    (pa, na), (pb, nb) = PR.patch_models(some, comps, meta), PR.patch_models(some, comps, meta, max_components=10, block=8)
    assert na == nb == ["p0", "p1", "p2"]
    for k in range(3):
        x, y = (p.agg(F.sum(f"model_{k}.re").alias("s"), F.sum(F.abs(f"model_{k}.im")).alias("t")).first() for p in (pa, pb))
        assert x.s == pytest.approx(y.s, rel=1e-9, abs=1e-6) and x.t == pytest.approx(y.t, rel=1e-9)


@pytest.mark.parametrize("before,copies", [([{"PreFlagger": {"chan": "[3]"}}], 0), ([{"AOFlagger": {}}], 1), ([{"Averager": {"timestep": 2}}], 1)])
def test_demixer_copies_only_what_a_shuffle_made(spark, vis, monkeypatch, before, copies):
    from visfold.plans import preprocess as PP
    comps, made, written = sky(spark, 2), [], PP._written
    model = PR.predict(FL.clear_flags(vis).filter("slot < 8").withColumn("weight", F.lit(1.0)), comps)
    monkeypatch.setattr(PP, "_written", lambda df: made.append(1) or written(df))
    demixer = {"Demixer": {"skymodel": "sky", "method": "unmix", "demixtimestep": 4, "demixfreqstep": 4, "solint_t": 2}}
    out = PP.preprocess(model, [*before, demixer], PP.Inputs(sky_models={"sky": comps}))
    known = PP.preprocess(model, before)
    assert len(made) == copies
    assert out.columns == known.columns and out.count() == known.count()
    good = out.filter("NOT flag.xx").agg(F.max(C.c_abs(F.col("data.xx"))).alias("left"), F.count(F.lit(1)).alias("n")).first()
    # two slots averaged: the phases turn by at most 0.06 between them, and a mean loses their square by 8
    assert good.n > 0 and good.left < (1e-7 if "Averager" not in before[0] else 1e-3)


def test_gains_are_few_files(spark, tmp_path):
    """Not a file per task and observation: ranges of intervals meet few observations."""
    import glob
    rows = [(o, t, 0, 0, a, None, 1.0, 0.0, 1, True) for o in range(6) for t in range(8) for a in range(2)]
    gains = spark.createDataFrame(rows, DX.GAIN_SCHEMA).repartition(16, "obs_id", "tsol")
    DX.write_demix_gains(gains, ["p"], f"{tmp_path}/g")
    assert len(glob.glob(f"{tmp_path}/g/obs_id=*/*.parquet")) <= 6 + int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = spark.read.parquet(f"{tmp_path}/g")
    assert back.count() == len(rows) and back.filter("patch = 'p'").select("obs_id", "tsol", "ant").distinct().count() == len(rows)


def test_a_large_sky_is_summed_by_all_cores_without_arrays_per_row(spark, vis):
    comps = spark.createDataFrame([(f"c{k}", f"p{k % 2}", 1e-4 * k, 2e-3, 1.0) for k in range(100)],
                                  "name string, patch string, l double, m double, flux_i double")
    out = PR.predict(vis.filter("slot < 3").coalesce(1), comps)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "_sky" not in plan
    assert out.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    few, _ = PR.patch_models(vis.filter("slot < 3"), comps)
    m, d = (df.agg(F.sum(c).alias("s")).first().s for df, c in ((few, F.col("model_0.re") + F.col("model_1.re")), (out, "data.xx.re")))
    assert abs(m - d) < 1e-6


@pytest.mark.parametrize("track,by_term", [("line", False), ("ellipse", False), ("still", True), ("scattered", True), ("two lines", False)])
def test_sums_along_a_track_are_those_term_by_term(monkeypatch, track, by_term):
    """Points and Gaussians over a wide sky, summed by series along smooth tracks only."""
    from visfold.operators import sky_sums as SS

    r, t = np.random.default_rng(3), np.arange(120.0)
    names = ("patch", "l", "m", "ra", "dec", "flux_i", "ref_freq", "per_ref", "si", "log_si", "type", "major", "minor", "orientation")
    sky = SS.SkyArrays.of([dict(zip(names, (f"p{k % 2}", None, None, 0.9 + 0.1 * r.random(), -0.5 + 0.1 * r.random(), 1 + r.random(), 1.4e8, 1 / 1.4e8,
                                            [-0.7, 0.1 * (k % 3)], k % 2 == 0, "GAUSSIAN" if k % 7 == 0 else "POINT", 60.0, 30.0, 10.0 * k))) for k in range(3000)])
    line = np.stack([100 + 0.1 * t, 40 - 0.1 * t, 5 + 0 * t], axis=1)
    turn = 0.3 + 8 * 7.3e-5 * t
    uvw = {"line": line, "ellipse": np.stack([150 * np.cos(turn), 90 * np.sin(turn) - 30, 40 * np.cos(turn) + 2], axis=1), "still": 0 * line + 7,
           "scattered": r.normal(size=(120, 3)) * 300, "two lines": np.where(t[:, None] % 2, line, line + 50)}[track][r.permutation(120)]
    centre, flux, freq = sky.directions((0.9, -0.5)), sky.fluxes(9.6e8), 9.6e8
    sets, cells, each = [sky.patch == "p0", sky.patch == "p1"], [], SS.SkyArrays._each
    want = [each(sky, uvw * (freq / SS.SPEED_OF_LIGHT), centre[0][:, s], flux[0][s], np.flatnonzero(s)) for s in sets]
    monkeypatch.setattr(SS.SkyArrays, "_each", lambda self, x, *more: cells.append(len(x) * len(more[1])) or each(self, x, *more))
    found = sky.sums(uvw, freq, centre, flux, sets)
    for a, b in zip(found, want):
        assert np.abs(a - b).max() < 1e-12 * flux[0].sum()
    assert (sum(cells) >= 0.9 * 120 * 3000) == by_term and (by_term or not cells)
    direct = -2j * np.pi * ((uvw[:5] * (freq / SS.SPEED_OF_LIGHT)) @ centre[0][:, :sky.n_points])
    points = sky.sums(uvw[:5], freq, centre, flux, [np.arange(3000) < sky.n_points])[0]
    assert np.abs(np.exp(direct) @ flux[0][:sky.n_points] - points).max() < 1e-9
