"""Registered queries on calibration and prediction beyond one per operator: soltabs with their own
axes, single amplitude and phase, linear lookup, filters after applycal, sky files, simulated gains."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cplx as C
from ..functions.compare import qround
from ..operators import applycal as AC
from ..operators import averaging as A
from ..operators import demix as DX
from ..operators import flagging as FL
from ..operators import predict as PR
from ..operators import unmix as UM
from ..sources import testviews as TV
from . import oracle as O
from .queries import _DX, _flux_sql, _predict_sql, _shape_of_sql, _vis, register

POLS = O.POLS


# ------------------------------------------------------------------- applycal

def _nearest_sql(name: str, sol: str, column: str) -> str:
    return (f"{name} AS (SELECT vt.time, arg_min(st.time, abs(st.time - vt.time)) AS {column} FROM (SELECT DISTINCT time FROM vis4) vt, "
            f"(SELECT DISTINCT time FROM {sol}) st GROUP BY vt.time)")


def _scalar_result_sql(gains: str) -> str:
    """CTE ``ac``: vis4 divided by g1 conj(g2); ``gains``: a CTE gg with (key, a_re, a_im, b_re, b_im, gok)."""
    res = {p: O.c_div(O.col_c("", p), O.c_mul(("a_re", "a_im"), O.c_conj(("b_re", "b_im")))) for p in POLS}
    good = "coalesce(gok AND " + " AND ".join(f"isfinite(n_{p}_{x})" for p in POLS for x in ("re", "im")) + ", false)"
    cols = ", ".join(f"CASE WHEN {good} THEN n_{p}_{x} ELSE {p}_{x} END AS {p}_{x}" for p in POLS for x in ("re", "im"))
    flags = ", ".join(f"(f{p} OR NOT {good}) AS f{p}" for p in POLS)
    return (f"{gains}, rr AS (SELECT *, {O.c_cols('n_', res)} FROM gg), "
            f"ac AS (SELECT obs_id, slot, time, ant1, ant2, chan, freq, u, v, w, weight, {cols}, {flags} FROM rr)")


def _two_axes_sql() -> str:
    def g(side):
        return f"{side}a.val*cos({side}p.val) AS {side[0]}_re, {side}a.val*sin({side}p.val) AS {side[0]}_im"
    joins = " ".join(f"LEFT JOIN {t} {s}{x} ON {s}{x}.ant = 'ant' || CAST(v.{ant} AS VARCHAR) AND {s}{x}.time = n{x}.st"
                     for s, ant in (("a", "ant1"), ("b", "ant2")) for x, t in (("a", "sa"), ("p", "sp")))
    gains = (f"gg AS (SELECT v.*, {g('a')}, {g('b')}, aa.val IS NOT NULL AND ap.val IS NOT NULL AND ba.val IS NOT NULL AND bp.val IS NOT NULL AS gok "
             f"FROM vis4 v JOIN na USING (time) JOIN np USING (time) {joins})")
    return O.with_vis(TV.solution_fixture_sql("scalar"), "sa AS (SELECT * FROM sol WHERE soltype = 'amplitude')",
                      "sp AS (SELECT * FROM sol WHERE soltype = 'phase' AND CAST((time - 17e8)/8e0 AS BIGINT) % 50 = 0)",
                      _nearest_sql("na", "sa", "st"), _nearest_sql("np", "sp", "st"), _scalar_result_sql(gains)) + f"SELECT {O.out_cols()} FROM ac"


def two_axes_solutions(vis):
    """Amplitude every 25 slots, phase every 50, its rows out of order and its index with gaps."""
    sol = TV.solution_fixture(vis, "scalar")
    slot = ((F.col("time") - F.lit(17e8)) / F.lit(8e0)).cast("bigint")
    return sol.filter((F.col("soltype") == "amplitude") | (slot % 50 == 0)).orderBy(F.desc("time"))


@register("applycal_two_axes", _two_axes_sql())
def q_applycal_two_axes(spark, sf_dir):
    vis = _vis(spark, sf_dir)
    return TV.flatten(AC.applycal(vis, two_axes_solutions(vis), TV.antenna_table(vis)))


def _single(soltype: str):
    def q(spark, sf_dir):
        vis = _vis(spark, sf_dir)
        return TV.flatten(AC.applycal(vis, TV.solution_fixture(vis, "scalar", soltypes=(soltype,)), TV.antenna_table(vis)))
    return q


for _type in ("amplitude", "phase"):
    register(f"applycal_{_type}", O.with_vis(TV.solution_fixture_sql("scalar", soltypes=(_type,)), *O.applycal_sql("scalar"))
             + f"SELECT {O.out_cols()} FROM ac")(_single(_type))


def _linear_sql(*turned: str) -> str:
    """Linear mode: phases unwrapped along the whole series by a running sum of turns; ``turned``: a CTE for ``sol``."""
    span = """tt AS (SELECT DISTINCT time FROM sol), bb AS (SELECT min(time) AS first, max(time) AS last FROM tt),
pc AS (SELECT DISTINCT time, least(greatest(time, first), last) AS xc, first, last FROM vis4, bb),
ll AS (SELECT time, xc, CASE WHEN first = last THEN first WHEN xc = last THEN (SELECT max(time) FROM tt WHERE time < xc)
    ELSE (SELECT max(time) FROM tt WHERE time <= xc) END AS lo,
  CASE WHEN first = last OR xc = last THEN xc ELSE (SELECT min(time) FROM tt WHERE time > xc) END AS hi FROM pc),
lf AS (SELECT *, CASE WHEN hi = lo THEN 0e0 ELSE (xc - lo)/(hi - lo) END AS frac FROM ll),
gr AS (SELECT time, ant, max(CASE WHEN soltype='amplitude' THEN val END) AS amp, max(CASE WHEN soltype='phase' THEN val END) AS raw FROM sol GROUP BY time, ant),
gd AS (SELECT *, round((raw - lag(raw) OVER (PARTITION BY ant ORDER BY time)) / (2*pi())) AS turns FROM gr),
gc AS (SELECT time, ant, amp, raw - 2*pi()*coalesce(sum(turns) OVER (PARTITION BY ant ORDER BY time), 0) AS ph FROM gd)"""

    def g(side, part, fn):
        return (f"({side}0.amp + ({side}1.amp - {side}0.amp)*frac) * {fn}({side}0.ph + ({side}1.ph - {side}0.ph)*frac) AS {side}_{part}")
    joins = " ".join(f"LEFT JOIN gc {s}{i} ON {s}{i}.ant = 'ant' || CAST(v.{ant} AS VARCHAR) AND {s}{i}.time = lf.{t}"
                     for s, ant in (("a", "ant1"), ("b", "ant2")) for i, t in ((0, "lo"), (1, "hi")))
    cols = ", ".join(g(s, x, fn) for s in "ab" for x, fn in (("re", "cos"), ("im", "sin")))
    gains = f"gg AS (SELECT v.*, {cols}, a0.amp IS NOT NULL AND a1.amp IS NOT NULL AND b0.amp IS NOT NULL AND b1.amp IS NOT NULL AS gok FROM vis4 v JOIN lf USING (time) {joins})"
    source = [TV.solution_fixture_sql("scalar", name="flat"), *turned] if turned else [TV.solution_fixture_sql("scalar")]
    return O.with_vis(*source, span, _scalar_result_sql(gains)) + f"SELECT {O.out_cols()} FROM ac"


@register("applycal_linear", _linear_sql())
def q_applycal_linear(spark, sf_dir):
    vis = _vis(spark, sf_dir)
    return TV.flatten(AC.applycal(vis, TV.solution_fixture(vis, "scalar"), TV.antenna_table(vis), mode="linear"))


_TURNED_SQL = """sol AS (SELECT * REPLACE (CASE WHEN soltype = 'phase' THEN raw - 2*pi()*floor((raw + pi())/(2*pi())) ELSE val END AS val)
  FROM (SELECT *, (time - 17e8)/8e0 * (3e-2 + val/5e0) AS raw FROM flat))"""


def turning_solutions(vis):
    """The scalar fixture with phases that turn with time, each antenna's at its own rate, folded into [-pi, pi)."""
    sol = TV.solution_fixture(vis, "scalar")
    raw = (F.col("time") - F.lit(17e8)) / F.lit(8e0) * (F.lit(3e-2) + F.col("val") / F.lit(5e0))
    folded = raw - F.lit(2e0) * F.pi() * F.floor((raw + F.pi()) / (F.lit(2e0) * F.pi()))
    return sol.withColumn("val", F.when(F.col("soltype") == "phase", folded).otherwise(F.col("val")))


@register("applycal_linear_phase", _linear_sql(_TURNED_SQL))
def q_applycal_linear_phase(spark, sf_dir):
    """Linear mode across the fold of the phases: Spark goes the shorter way per interval, the SQL unwraps whole series."""
    vis = _vis(spark, sf_dir)
    return TV.flatten(AC.applycal(vis, turning_solutions(vis), TV.antenna_table(vis), mode="linear"))


@register("applycal_unflagged", O.with_vis(TV.solution_fixture_sql("fulljones"), *O.applycal_sql("fulljones"))
          + f"SELECT {O.out_cols()} FROM ac WHERE NOT fxx AND NOT fyy")
def q_applycal_unflagged(spark, sf_dir):
    """What comes next after calibration: keep unflagged data."""
    vis = _vis(spark, sf_dir)
    out = AC.applycal(vis, TV.solution_fixture(vis, "fulljones"), TV.antenna_table(vis))
    return TV.flatten(out.filter(~F.col("flag.xx") & ~F.col("flag.yy")))


@register("vis_allclose_differs", O.with_vis() + """SELECT obs_id, obs_id % 2 = 0 AS all_close,
  CASE WHEN obs_id % 2 = 0 THEN 0e0 ELSE 5e-1 END AS max_abs_diff, count(*) AS n FROM vis4 GROUP BY obs_id""")
def q_vis_allclose_differs(spark, sf_dir):
    """Odd observations have one channel shifted by half a unit."""
    vis = _vis(spark, sf_dir)
    xx = F.col("data.xx")
    shifted = F.when((F.col("obs_id") % 2 == 1) & (F.col("chan") == 1), xx.withField("im", xx["im"] + F.lit(0.5))).otherwise(xx)
    r = A.vis_allclose(vis, vis.withColumn("data", F.col("data").withField("xx", shifted)))
    return r.select("obs_id", "all_close", F.round("max_abs_diff", 9).alias("max_abs_diff"), "n")


# -------------------------------------------------------------------- predict

#: Phase centre of the sky-file query (degrees).
RA0, DEC0 = 5.2e1, -2.8e1


def _sky_file_sql() -> str:
    k = f"(2e0*pi()*v.freq/{O.C_LIGHT})"
    ph = f"(-{k}*(v.u*d.l + v.v*d.m + v.w*(d.n - 1e0)))"
    amp = f"(({_flux_sql('v.freq', 'd.')})*(CASE WHEN d.type = 'GAUSSIAN' THEN {_shape_of_sql('v.', 'd.')} ELSE 1e0 END))"
    return O.with_vis(TV.SKY_TEXT_SQL, f"""dl AS (SELECT *, cos(dec)*sin(ra - radians({RA0!r}e0)) AS l,
  sin(dec)*cos(radians({DEC0!r}e0)) - cos(dec)*sin(radians({DEC0!r}e0))*cos(ra - radians({RA0!r}e0)) AS m FROM scomp),
d AS (SELECT *, sqrt(1e0 - l*l - m*m) AS n FROM dl),
t AS (SELECT v.obs_id, v.slot, v.ant1, v.ant2, v.chan, sum({amp}*cos({ph})) AS re, sum({amp}*sin({ph})) AS im
  FROM vis4 v, d GROUP BY ALL)""") + f"SELECT obs_id, slot, ant1, ant2, chan, {O.qr('re', 2)} AS re, {O.qr('im', 2)} AS im FROM t"


def _obs_meta(vis):
    return vis.select("obs_id").distinct().select("obs_id", F.radians(F.lit(RA0)).alias("ra0"), F.radians(F.lit(DEC0)).alias("dec0"))


@register("predict_sky_model", _sky_file_sql())
def q_predict_sky_model(spark, sf_dir):
    """From the sky-model file: components by (ra, dec), with spectra and Gaussians, one per user."""
    vis = _vis(spark, sf_dir)
    _, comps = TV.sky_model_from_events(spark, sf_dir)
    out = PR.predict(vis, comps, _obs_meta(vis))
    return out.select("obs_id", "slot", "ant1", "ant2", "chan", qround(F.col("data.xx.re"), 2).alias("re"), qround(F.col("data.xx.im"), 2).alias("im"))


# ---------------------------------------------------------------------- demix

@register("demix", O.with_vis(_predict_sql().replace("pv AS", "pa AS"), f"""left_over AS (SELECT obs_id, count(*) AS n,
  sqrt(sum(2e0*(b_re*b_re + b_im*b_im))/(count(*)*4e0)) AS rms FROM (SELECT obs_id, {{bre}} AS b_re, {{bim}} AS b_im FROM vis4) GROUP BY obs_id)""".format(
    bre=O.comp_term_sql(*TV.SKY_COMPONENTS[1][3:6])[0], bim=O.comp_term_sql(*TV.SKY_COMPONENTS[1][3:6])[1]))
    + f"SELECT obs_id, n, true AS all_vanish, {O.qr('rms')} AS rms_of_other, CAST(0 AS BIGINT) AS null_gains FROM left_over")
def q_demix(spark, sf_dir):
    """A predicted sky: taking all patches out leaves nothing, taking one out leaves the other."""
    model = PR.predict(FL.clear_flags(_vis(spark, sf_dir)), TV.sky_components(spark))
    none, gains = DX.demix(model, TV.sky_components(spark), subtract=["bright_a", "bright_b"], **_DX)
    other, _ = DX.demix(model, TV.sky_components(spark), subtract=["bright_a"], **_DX)
    before, after = A.rms_power(model).withColumnRenamed("rms", "before"), A.rms_power(none).withColumnRenamed("rms", "after")
    counts = model.groupBy("obs_id").agg(F.count(F.lit(1)).alias("n"))
    nulls = gains.groupBy("obs_id").agg(F.count(F.when(F.col("g_re").isNull(), 1)).alias("null_gains"))
    return (counts.join(before, "obs_id").join(after, "obs_id").join(A.rms_power(other), "obs_id").join(nulls, "obs_id")
            .select("obs_id", "n", (F.col("after") < 1e-7 * F.col("before")).alias("all_vanish"), qround(F.col("rms")).alias("rms_of_other"), "null_gains"))


def _sim_gain(ant, d: int):
    """Known gains of the simulation: amplitude 1 + 0.05 ant (d + 1), phase 0.1 ant (d + 1)."""
    return F.lit(1.0) + F.lit(0.05 * (d + 1)) * ant, F.lit(0.1 * (d + 1)) * ant


def _simulated(spark, sf_dir, components):
    """Cross-correlations of the patches' models times known gains, with the models' columns."""
    vm, patches = PR.patch_models(FL.clear_flags(_vis(spark, sf_dir)).filter("ant1 <> ant2"), components)
    total = C.c_zero()
    for d in range(len(patches)):
        (a1, p1), (a2, p2) = _sim_gain(F.col("ant1"), d), _sim_gain(F.col("ant2"), d)
        total = C.c_add(total, C.c_mul(F.col(f"model_{d}"), C.c_from_polar(a1 * a2, p1 - p2)))
    return vm.withColumn("_s", total).withColumn("data", PR.unpolarised(F.col("_s"))).drop("_s")


def _simulated_sql(sources=tuple(c[1:] for c in TV.SKY_COMPONENTS)) -> str:
    """``sources``: tuples that end in l, m and flux."""
    parts = []
    for d, comp in enumerate(sources):
        re, im = O.comp_term_sql(*comp[-3:])
        a = f"((1e0 + {0.05 * (d + 1)!r}e0*ant1)*(1e0 + {0.05 * (d + 1)!r}e0*ant2))"
        ph = f"({0.1 * (d + 1)!r}e0*ant1 - {0.1 * (d + 1)!r}e0*ant2)"
        parts.append((f"({a}*(({re})*cos({ph}) - ({im})*sin({ph})))", f"({a}*(({re})*sin({ph}) + ({im})*cos({ph})))"))
    return f"sim AS (SELECT obs_id, {parts[0][0]} + {parts[1][0]} AS re, {parts[0][1]} + {parts[1][1]} AS im FROM vis4 WHERE ant1 <> ant2)"


def _taken_out(sim, patches, gain: str):
    """Fit gains of this kind to simulated data and subtract: per observation, is less than 1e-7 of the input's rms left?"""
    avg = DX.demix_average(sim, len(patches), 1, 1, 4, 4, DX.GAINS[gain][0])
    gains = DX.fit_direction_gains(avg, len(patches), gain=gain).checkpoint()
    return _rms_left(sim, DX.subtract_sources(sim, gains, range(len(patches)), 4, 4, 1, 1, gain=gain))


def _rms_left(sim, out):
    left = A.rms_power(FL.clear_flags(out)).withColumnRenamed("rms", "after")
    counts = sim.groupBy("obs_id").agg(F.count(F.lit(1)).alias("n"))
    return (counts.join(A.rms_power(sim), "obs_id").join(left, "obs_id")
            .select("obs_id", "n", qround(F.col("rms")).alias("rms_in"), (F.col("after") < 1e-7 * F.col("rms")).alias("fits")))


@register("fit_direction_gains", O.with_vis(_simulated_sql()) + f"""SELECT obs_id, count(*) AS n,
  {O.qr('sqrt(sum(2e0*(re*re + im*im))/(count(*)*4e0))')} AS rms_in, true AS fits FROM sim GROUP BY obs_id""")
def q_fit_direction_gains(spark, sf_dir):
    """Simulated with known gains per antenna and direction: the fitted model takes the data out again."""
    return _taken_out(_simulated(spark, sf_dir, TV.sky_components(spark)), [c[2] for c in TV.SKY_COMPONENTS], "scalar")


# ------------------------------------------------- demix, the mixing undone

#: Two patches within one fringe of each other in every bin.
CLOSE_PATCHES = (("close_a", "near_a", 1e-2, 2e-2, 1e0), ("close_b", "near_b", -2e-2, 1e-2, 5e-1))
_UNMIX = dict(timestep=4, freqstep=4, solint_t=5, solint_f=1)
#: Bins that tell the patches apart less well would compare rounding errors.
_UNMIX_CONDITION = 1e4


def _close_sky(spark):
    return spark.createDataFrame(list(CLOSE_PATCHES), "name string, patch string, l double, m double, flux_i double")


def _unmix_sql() -> str:
    """Sums per bin, then the 2x2 inverse written out: s_a = (v_a - A v_b) / (1 - |A|^2), s_b = (v_b - conj(A) v_a) / (1 - |A|^2)."""
    sums = ["sum(weight) AS w"]
    phases, models = [], []
    for d, (_, _, l_, m_, flux) in enumerate(CLOSE_PATCHES):
        n_ = f"(sqrt(1e0 - {O.dbl(l_ * l_)} - {O.dbl(m_ * m_)}) - 1e0)"
        phases.append(f"2e0*pi()*freq/{O.C_LIGHT}*(u*{O.dbl(l_)} + v*{O.dbl(m_)} + w*{n_}) AS p{d}")
        models.append(f"{O.dbl(flux)}*sum(weight)/sum(weight) AS m{d}")  # phased to its own centre, a point is constant
        for p in ("xx", "yy"):
            sums.append(f"sum(weight*({p}_re*cos(p{d}) - {p}_im*sin(p{d})))/sum(weight) AS {p}{d}_re")
            sums.append(f"sum(weight*({p}_re*sin(p{d}) + {p}_im*cos(p{d})))/sum(weight) AS {p}{d}_im")
    sums += ["sum(weight*cos(p0 - p1))/sum(weight) AS a_re", "sum(weight*sin(p0 - p1))/sum(weight) AS a_im"]
    clear = []
    for d, other, sign in ((0, 1, ""), (1, 0, "-")):  # the matrix entry of the second row is the conjugate
        cols = [f"{d} AS patch_idx", "w*q AS w", f"m{d} AS m_re", "0e0 AS m_im"]
        for p in ("xx", "yy"):
            cols.append(f"({p}{d}_re - (a_re*{p}{other}_re - ({sign}a_im)*{p}{other}_im))/q AS v{p}_re")
            cols.append(f"({p}{d}_im - (a_re*{p}{other}_im + ({sign}a_im)*{p}{other}_re))/q AS v{p}_im")
        clear.append(f"SELECT obs_id, tsol, fsol, tbin, fbin, ant1, ant2, {', '.join(cols)} FROM apart")
    keys = "obs_id, tsol, fsol, tbin, fbin, ant1, ant2"
    return O.with_vis(
        "fs AS (SELECT obs_id, min(slot) AS first_slot FROM vis4 GROUP BY obs_id)",
        f"ph AS (SELECT vis4.*, {', '.join(phases)}, CAST(floor((slot - first_slot)/4e0) AS BIGINT) AS tbin, CAST(floor(chan/4e0) AS INT) AS fbin "
        "FROM vis4 JOIN fs USING (obs_id) WHERE ant1 <> ant2 AND NOT fxx AND NOT fyy)",
        f"bins AS (SELECT obs_id, CAST(floor(tbin/5e0) AS BIGINT) AS tsol, fbin AS fsol, tbin, fbin, ant1, ant2, {', '.join(sums + models)} "
        "FROM ph GROUP BY obs_id, tbin, fbin, ant1, ant2)",
        f"apart AS (SELECT *, 1e0 - a_re*a_re - a_im*a_im AS q FROM bins "
        f"WHERE 1e0 + sqrt(a_re*a_re + a_im*a_im) <= {O.dbl(_UNMIX_CONDITION)}*(1e0 - sqrt(a_re*a_re + a_im*a_im)))",
        f"s AS ({' UNION ALL '.join(clear)})",
    ) + f"SELECT {keys}, patch_idx, " + ", ".join(f"{O.qr(c, 3)} AS {c}" for c in _UNMIX_VALUES) + " FROM s"


_UNMIX_VALUES = ("w", "vxx_re", "vxx_im", "vyy_re", "vyy_im", "m_re", "m_im")


@register("unmix_average", _unmix_sql())
def q_unmix_average(spark, sf_dir):
    """Each patch's own averaged data, the mixing with the other one undone."""
    comps = _close_sky(spark)
    vm, _ = PR.patch_models(_vis(spark, sf_dir), comps)
    out = UM.unmix_average(vm, UM.patch_centres(comps), **_UNMIX, max_condition=_UNMIX_CONDITION)
    return out.select(*UM.BIN, "patch_idx", *[qround(F.col(c), 3).alias(c) for c in _UNMIX_VALUES])


@register("demix_unmixed", O.with_vis(_simulated_sql(CLOSE_PATCHES)) + f"""SELECT obs_id, count(*) AS n,
  {O.qr('sqrt(sum(2e0*(re*re + im*im))/(count(*)*4e0))')} AS rms_in, true AS fits FROM sim GROUP BY obs_id""")
def q_demix_unmixed(spark, sf_dir):
    """Close patches, simulated with known gains per antenna and direction, fitted one by one and taken out again."""
    comps = _close_sky(spark)
    sim = _simulated(spark, sf_dir, comps)
    out, _ = DX.demix(sim.drop("model_0", "model_1"), comps, method="unmix", **_UNMIX)
    return _rms_left(sim, out)


#: Known 2x2 gains of the simulation: real parts of (xx, xy, yx, yy) as (constant, per antenna) by direction.
_SIM_JONES = [((1.0, 0.05), (0.0, 0.02), (0.0, -0.03), (0.9, 0.04)), ((1.1, -0.04), (0.05, 0.01), (0.0, 0.02), (1.0, 0.03))]


def _jones_sql() -> str:
    """V = sum_d m_d G_p G_q^T: the simulated gains are real."""
    parts = {p: ([], []) for p in O.POLS}
    for d, comp in enumerate(TV.SKY_COMPONENTS):
        m_re, m_im = O.comp_term_sql(*comp[3:6])
        g = {a: [f"({O.dbl(c)} + {O.dbl(s)}*{a})" for c, s in _SIM_JONES[d]] for a in ("ant1", "ant2")}
        for i, p in enumerate(O.POLS):
            row, col = divmod(i, 2)
            factor = f"({g['ant1'][2 * row]}*{g['ant2'][2 * col]} + {g['ant1'][2 * row + 1]}*{g['ant2'][2 * col + 1]})"
            parts[p][0].append(f"{factor}*({m_re})")
            parts[p][1].append(f"{factor}*({m_im})")
    cols = ", ".join(f"{' + '.join(parts[p][x])} AS {p}_{n}" for p in O.POLS for x, n in enumerate(("re", "im")))
    return f"sim AS (SELECT obs_id, {cols} FROM (SELECT obs_id, ant1, ant2, u, v, w, freq FROM vis4 WHERE ant1 <> ant2))"


@register("fit_direction_jones", O.with_vis(_jones_sql()) + f"""SELECT obs_id, count(*) AS n,
  {O.qr('sqrt(sum(' + ' + '.join(f'{p}_{x}*{p}_{x}' for p in O.POLS for x in ('re', 'im')) + ')/(count(*)*4e0))')} AS rms_in, true AS fits
  FROM sim GROUP BY obs_id""")
def q_fit_direction_jones(spark, sf_dir):
    """Simulated with known 2x2 gains per antenna and direction: the fitted model takes all polarisations out again."""
    vm, patches = PR.patch_models(FL.clear_flags(_vis(spark, sf_dir)).filter("ant1 <> ant2"), TV.sky_components(spark))

    # dealt anew, so that the models are computed once and not in every product
    vm = vm.repartition("obs_id", "ant1", "ant2")

    def g(ant: str, d: int, i: int):
        c, s = _SIM_JONES[d][i]
        return F.lit(c) + F.lit(s) * F.col(ant)
    sums = {}
    for i, p in enumerate(O.POLS):
        row, col = divmod(i, 2)
        factors = [g("ant1", d, 2 * row) * g("ant2", d, 2 * col) + g("ant1", d, 2 * row + 1) * g("ant2", d, 2 * col + 1) for d in range(len(patches))]
        sums[p] = C.cpx(*[sum((f * F.col(f"model_{d}").getField(x) for d, f in enumerate(factors)), F.lit(0.0)) for x in ("re", "im")])
    sim = vm.withColumn("data", F.struct(*[sums[p].alias(p) for p in O.POLS]))
    return _taken_out(sim, patches, "jones")


# ------------------------------------------------------------- whole pipeline

#: The step list with Demixer and sink. (No AOFlagger: what Demixer leaves of a predicted sky has
#: no noise, and thresholds on rounding errors compare nothing; ``preprocess`` covers that step.)
DEMIX_STEPS = [{"MsIn": {"datacolumn": "DATA"}}, {"PreFlagger": {"freqrange": "[960.5..961.5 MHz]"}},
               {"Demixer": {"skymodel": "sky", "subtractsources": ["bright_a"]}}, {"ApplyCal": {"parmdb": "diagonal"}},
               {"Averager": {"timestep": 4, "freqstep": 4}}, {"MsOut": {"overwrite": True}}]


def _demix_pipeline_sql() -> str:
    re, im = O.comp_term_sql(*TV.SKY_COMPONENTS[1][3:6])
    other = (f"mb AS (SELECT * REPLACE ({re} AS xx_re, {im} AS xx_im, 0e0 AS xy_re, 0e0 AS xy_im, 0e0 AS yx_re, 0e0 AS yx_im, "
             f"{re} AS yy_re, {im} AS yy_im, false AS fxx, false AS fxy, false AS fyx, false AS fyy) FROM vis4)")
    return O.with_vis(TV.solution_fixture_sql("diagonal"), other, O.flag_cte("pf", "mb", "freq BETWEEN 9.605e8 AND 9.615e8"),
                      *O.applycal_sql("diagonal", src="pf"), O.average_sql("ac", 4, 4, "a")) + f"SELECT {O.out_cols()} FROM a"


@register("preprocess_demix", _demix_pipeline_sql())
def q_preprocess_demix(spark, sf_dir):
    """From Parquet to Parquet: a predicted sky of two sources, one of them taken out."""
    from ..plans import preprocess as PP
    from ..session import scratch_path
    from ..sources import visibilities as VI
    vis = _vis(spark, sf_dir)
    source, target = scratch_path(spark, "vis"), scratch_path(spark, "out")
    VI.write_visibilities(PR.predict(FL.clear_flags(vis), TV.sky_components(spark)), source)
    inputs = PP.Inputs(solutions={"diagonal": TV.solution_fixture(vis, "diagonal")}, sky_models={"sky": TV.sky_components(spark)},
                       antenna=TV.antenna_table(vis))
    PP.run_pipeline(spark, source, DEMIX_STEPS, target, inputs)
    return TV.flatten(VI.scan_visibilities(spark, target))
