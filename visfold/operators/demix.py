"""Demixing: fit direction-dependent gains of bright patches and subtract them.

Plan:
1. per-patch models are row-local columns on the visibilities (``patch_models``);
2. data and models are averaged together by (timestep, freqstep) with the
   averaging aggregation (one shuffle, partial aggregation first);
3. gains per (obs, solution interval, patch, antenna) are solved by a grouped
   map (``applyInPandas``, Levenberg-Marquardt in ``gain_solver``) over solution intervals: each group holds
   at most baselines x averaged bins of one interval, independent of the data size;
   the solved gains are checkpointed (small, reused twice);
4. the chosen patches are subtracted at full resolution after two joins
   (ant1, ant2) with the gain table, broadcast behind a size check.

``fit_direction_scalar`` is the native alternative: one complex factor per
(obs, interval, patch), sum(conj(m) v w) / sum(|m|^2 w), no Python.

Decisions: all patches are fitted, only the chosen ones subtracted; flagged and non-finite
samples and auto-correlations are left out of the fit, and non-finite ones are flagged; a group without
enough samples gets null gains and its data is flagged, not subtracted.
Gains per antenna and direction are ``scalar`` (both XX and YY constrain them), ``diagonal`` (XX and YY
apart) or ``jones`` (2x2, from all four polarisations).
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cplx as C
from ..session import ship_package
from ..plans.joins import per_observation
from .averaging import with_relative_slot
from .gain_solver import fit_gains
from .predict import patch_models

POLS = C.POLS
DIAG = ("xx", "yy")
#: Kinds of gains: the polarisations that constrain them, and those that have a gain of their own.
GAINS = {"scalar": (DIAG, ()), "diagonal": (DIAG, DIAG), "jones": (POLS, POLS)}


def _bins(v: DataFrame, timestep: int, freqstep: int, solint_t: int, solint_f: int, obs_first=None) -> DataFrame:
    v = with_relative_slot(v, obs_first)
    v = v.withColumn("tbin", F.floor(F.col("rel_slot") / F.lit(float(timestep))).cast("bigint"))
    v = v.withColumn("fbin", F.floor(F.col("chan") / F.lit(float(freqstep))).cast("int"))
    v = v.withColumn("tsol", F.floor(F.col("tbin") / F.lit(float(solint_t))).cast("bigint"))
    return v.withColumn("fsol", F.floor(F.col("fbin") / F.lit(float(solint_f))).cast("int"))


def _finite(z: Column) -> Column:
    """Are both parts finite? Names each part once, as they may be long expressions."""
    return F.coalesce(z.getField("re") * 0.0 + z.getField("im") * 0.0 == 0.0, F.lit(False))


def usable_for_fit(pols) -> Column:
    """Cross-correlations, unflagged and finite in these polarisations, with a positive finite weight."""
    use = F.col("ant1") != F.col("ant2")
    for p in pols:
        use = use & ~F.col("flag").getField(p) & _finite(F.col("data").getField(p))
    return use & (F.col("weight") > 0) & (F.col("weight") < float("inf"))


def demix_average(vis: DataFrame, n_patches: int, timestep: int = 1, freqstep: int = 1,
                  solint_t: int = 4, solint_f: int = 4, pols=DIAG, obs_first=None) -> DataFrame:
    """Average data (XX, YY unless told otherwise) and every patch model over (timestep, freqstep) bins,
    weighting unflagged, finite cross-correlation samples only. One row per bin with
    sum of weights ``w`` (bins without usable samples are dropped)."""
    v = _bins(vis, timestep, freqstep, solint_t, solint_f, obs_first)
    use = usable_for_fit(pols)
    aggs = [F.sum(F.when(use, F.col("weight"))).alias("w")]

    def weighted(x: Column) -> Column:
        return F.sum(F.when(use, F.col("weight") * x))
    for p in pols:
        d = F.col("data").getField(p)
        aggs += [weighted(d.getField("re")).alias(f"v{p}_re"), weighted(d.getField("im")).alias(f"v{p}_im")]
    for k in range(n_patches):
        m = F.col(f"model_{k}")
        aggs += [weighted(m.getField("re")).alias(f"m{k}_re"), weighted(m.getField("im")).alias(f"m{k}_im")]
    keys = ["obs_id", "tsol", "fsol", "tbin", "fbin", "ant1", "ant2"]
    a = v.groupBy(*keys).agg(*aggs).filter(F.col("w") > 0)
    cols = [*keys, "w"]
    for name in [f"v{p}" for p in pols] + [f"m{k}" for k in range(n_patches)]:
        cols += [F.try_divide(F.col(f"{name}_re"), F.col("w")).alias(f"{name}_re"),
                 F.try_divide(F.col(f"{name}_im"), F.col("w")).alias(f"{name}_im")]
    return a.select(*cols)


def fit_direction_scalar(avg: DataFrame, n_patches: int) -> DataFrame:
    """One complex factor per (obs, interval, patch): sum(conj(m) v w) / sum(|m|^2 w)."""
    aggs = []
    for k in range(n_patches):
        num_re, num_im, den = None, None, None
        for p in DIAG:
            v = C.cpx(F.col(f"v{p}_re"), F.col(f"v{p}_im"))
            m = C.cpx(F.col(f"m{k}_re"), F.col(f"m{k}_im"))
            z = C.c_mul(C.c_conj(m), v)
            nr, ni, dd = C.re_(z) * F.col("w"), C.im_(z) * F.col("w"), C.c_abs2(m) * F.col("w")
            num_re = nr if num_re is None else num_re + nr
            num_im = ni if num_im is None else num_im + ni
            den = dd if den is None else den + dd
        aggs += [F.sum(num_re).alias(f"_nr{k}"), F.sum(num_im).alias(f"_ni{k}"), F.sum(den).alias(f"_d{k}")]
    g = avg.groupBy("obs_id", "tsol", "fsol").agg(*aggs)
    arr = F.array(*[F.struct(F.lit(k).alias("patch_idx"),
                             F.try_divide(F.col(f"_nr{k}"), F.col(f"_d{k}")).alias("g_re"),
                             F.try_divide(F.col(f"_ni{k}"), F.col(f"_d{k}")).alias("g_im"))
                    for k in range(n_patches)])
    return g.select("obs_id", "tsol", "fsol", F.explode(arr).alias("_g")).select(
        "obs_id", "tsol", "fsol", "_g.patch_idx", "_g.g_re", "_g.g_im")


# ------------------------------------------------------------ grouped solver

GAIN_SCHEMA = "obs_id long, tsol long, fsol int, patch_idx int, ant int, pol string, g_re double, g_im double, iterations int, converged boolean"


def solve_group(pdf: pd.DataFrame, n_patches: int, max_iter: int = 100, gain: str = "scalar") -> pd.DataFrame:
    """Least squares for V_pq = sum_d G_p,d M_pq,d G_q,d^H on one solution interval; rows of ``GAIN_SCHEMA``.

    ``pol`` names a gain's own polarisation, and is null for scalar gains. An interval with fewer samples than
    gains has null gains.
    """
    keys = pdf.iloc[0]
    ants = np.union1d(pdf["ant1"].to_numpy(), pdf["ant2"].to_numpy())
    p = np.searchsorted(ants, pdf["ant1"].to_numpy())
    q = np.searchsorted(ants, pdf["ant2"].to_numpy())
    w = pdf["w"].to_numpy(dtype=float)
    used, own = GAINS[gain]
    v = {x: pdf[f"v{x}_re"].to_numpy() + 1j * pdf[f"v{x}_im"].to_numpy() for x in used}
    m = np.stack([pdf[f"m{k}_re"].to_numpy() + 1j * pdf[f"m{k}_im"].to_numpy() for k in range(n_patches)], axis=1)
    if gain == "scalar":  # both polarisations are independent samples of the same model
        fits = [((None,), np.concatenate([v[x] for x in used])[:, None, None], np.concatenate([m, m]), *(np.concatenate([x, x]) for x in (p, q, w)))]
    elif gain == "diagonal":
        fits = [((x,), v[x][:, None, None], m, p, q, w) for x in used]
    else:
        fits = [(POLS, np.stack([v[x] for x in POLS], axis=1).reshape(-1, 2, 2), m, p, q, w)]
    rows = []
    for pols, V, *given in fits:
        enough = len(V) >= len(ants) * n_patches
        G, turns, settled = fit_gains(V, *given, len(ants), max_iter) if enough else (None, 0, False)
        for i, ant in enumerate(ants):
            for d in range(n_patches):
                for c, pol in enumerate(pols):
                    g = G[i, d].ravel()[c] if enough else None
                    rows.append((int(keys["obs_id"]), int(keys["tsol"]), int(keys["fsol"]), d, int(ant), pol,
                                 None if g is None else float(g.real), None if g is None else float(g.imag), turns, settled))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in GAIN_SCHEMA.split(", ")])


def fit_direction_gains(avg: DataFrame, n_patches: int, max_iter: int = 100, gain: str = "scalar") -> DataFrame:
    """Grouped map over (obs_id, tsol, fsol): gains per patch and antenna (and polarisation). ``avg`` holds the
    polarisations that the kind of gain needs (``GAINS``)."""
    cols = ["obs_id", "tsol", "fsol", "ant1", "ant2", "w"] + [f"v{p}_{x}" for p in GAINS[gain][0] for x in ("re", "im")] \
        + [f"m{k}_{x}" for k in range(n_patches) for x in ("re", "im")]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return solve_group(pdf, n_patches, max_iter, gain)
    return solvable(avg.select(*cols), ["obs_id", "tsol", "fsol"], solve, GAIN_SCHEMA)


def solvable(avg: DataFrame, keys: list[str], solve, schema: str) -> DataFrame:
    """Apply a solver to the groups of ``keys``."""
    # The averaged input is small in bytes but costly to solve: an explicit
    # repartition on the group key keeps AQE from coalescing every interval into
    # one task (the group-by reuses this partitioning, no extra exchange).
    spark = avg.sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ship_package(spark)
    gains = avg.repartition(n, *keys).groupBy(*keys).applyInPandas(solve, schema)
    # gains of an interval that didn't converge are null, so its data is flagged, not changed
    return gains.withColumns({g: F.when(F.col("converged"), F.col(g)) for g in ("g_re", "g_im")})


def subtract_sources(vis_models: DataFrame, gains: DataFrame, subtract_idx, solint_t: int, solint_f: int,
                     timestep: int, freqstep: int, scalar: bool = False, gain: str = "scalar", obs_first=None) -> DataFrame:
    """V - sum_d G_p,d M_d G_q,d^H over the chosen patches (models are unpolarised; all four polarisations
    change with ``gain='jones'``, else XX and YY).

    ``scalar``: gains have no antenna (one factor per patch), V - sum_d g_d M_d.
    A sample whose interval has no gain for a chosen patch is flagged, not changed; so is a non-finite one.
    """
    v = _bins(vis_models, timestep, freqstep, solint_t, solint_f, obs_first)
    wide_keys = ["obs_id", "tsol", "fsol"] + ([] if scalar else ["ant"])
    own = GAINS[gain][1]

    def value(k: int, pol: str | None) -> Column:
        here = F.col("patch_idx") == k
        here = here if pol is None else here & (F.col("pol") == pol)
        return F.first(F.when(here, C.cpx(F.col("g_re"), F.col("g_im"))), ignorenulls=True)
    piv = gains.groupBy(*wide_keys).agg(*[
        value(k, None).alias(f"g{k}") if not own else F.struct(*[value(k, p).alias(p) for p in own]).alias(f"g{k}") for k in subtract_idx])
    piv = per_observation(piv)
    ok = F.lit(True)
    changed = POLS if gain == "jones" else DIAG
    total = {p: C.c_zero() for p in changed}
    if scalar:
        v = v.join(piv, ["obs_id", "tsol", "fsol"], "left")
    else:
        a = piv.select("obs_id", "tsol", "fsol", F.col("ant").alias("ant1"), *[F.col(f"g{k}").alias(f"a{k}") for k in subtract_idx])
        b = piv.select("obs_id", "tsol", "fsol", F.col("ant").alias("ant2"), *[F.col(f"g{k}").alias(f"b{k}") for k in subtract_idx])
        v = v.join(a, ["obs_id", "tsol", "fsol", "ant1"], "left").join(b, ["obs_id", "tsol", "fsol", "ant2"], "left")
    for k in subtract_idx:
        m = F.col(f"model_{k}")
        for side in ("g",) if scalar else ("a", "b"):
            g = F.col(f"{side}{k}")
            for one in ([g.getField(p) for p in own] if own else [g]):
                ok = ok & C.c_is_finite(one)
        for p in changed:
            if scalar:
                term = C.c_mul(F.col(f"g{k}"), m)
            elif gain == "jones":
                row, col = divmod(POLS.index(p), 2)
                parts = [C.c_mul(F.col(f"a{k}").getField(POLS[2 * row + i]), C.c_conj(F.col(f"b{k}").getField(POLS[2 * col + i]))) for i in (0, 1)]
                term = C.c_mul(C.c_add(*parts), m)
            else:
                ga, gb = (F.col(f"{side}{k}").getField(p) if own else F.col(f"{side}{k}") for side in ("a", "b"))
                term = C.c_mul(C.c_mul(ga, m), C.c_conj(gb))
            total[p] = C.c_add(total[p], term)
    if not own:  # one sum for both polarisations
        v, total = v.withColumn("_sub", total["xx"]), {p: F.col("_sub") for p in changed}
    v = v.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    data = F.struct(*[
        (F.when(F.col("_ok"), C.c_sub(F.col("data").getField(p), total[p])).otherwise(F.col("data").getField(p))
         if p in changed else F.col("data").getField(p)).alias(p) for p in POLS])
    flag = F.struct(*[(F.col("flag").getField(p) | ~F.col("_ok") | ~_finite(F.col("data").getField(p))).alias(p) for p in POLS])
    return v.withColumns({"data": data, "flag": flag})


def demix(vis: DataFrame, components: DataFrame, subtract=None, timestep: int = 1, freqstep: int = 1,
          solint_t: int = 4, solint_f: int = 4, obs_meta: DataFrame | None = None, method: str = "lm",
          gains_path: str | None = None, gain: str = "scalar", obs_first: DataFrame | int | None = None):
    """Demixer step. Returns (demixed vis, gains). ``subtract``: patch names (default all).

    ``method='lm'``: station solver for all patches together, with gains of the kind ``gain``; ``'unmix'``: the same solver patch by
    patch, after the mixing of averaged patches is undone (``unmix``); ``'scalar'``: native per-patch factor.
    ``obs_first``: as in ``with_relative_slot``. With ``gains_path`` the gains are written there, partitioned by ``obs_id``.
    """
    if obs_first is None:  # read once for the fit and the subtraction
        obs_first = per_observation(vis.groupBy("obs_id").agg(F.min("slot").alias("first_slot")))
    vm, patches = patch_models(vis, components, obs_meta)
    subtract = list(patches) if subtract is None else list(subtract)
    unknown = sorted(set(subtract) - set(patches))
    if unknown:
        raise ValueError(f"unknown patches to subtract: {unknown}")
    idx = [patches.index(p) for p in subtract]
    if gain not in GAINS:
        raise ValueError(f"gain must be one of {sorted(GAINS)}, got {gain!r}")
    if method == "unmix":
        from .unmix import fit_unmixed_gains, patch_centres, unmix_average
        avg = unmix_average(vm, patch_centres(components), timestep, freqstep, solint_t, solint_f, GAINS[gain][0], obs_meta, obs_first)
        gains = fit_unmixed_gains(avg, gain=gain)
    elif method in ("lm", "scalar"):
        avg = demix_average(vm, len(patches), timestep, freqstep, solint_t, solint_f, GAINS[gain][0], obs_first)
        gains = fit_direction_gains(avg, len(patches), gain=gain) if method == "lm" else fit_direction_scalar(avg, len(patches))
    else:
        raise ValueError(f"method must be 'lm', 'unmix' or 'scalar', got {method!r}")
    gains = gains.checkpoint()  # small, reused by the size check, the join and the sink
    if gains_path is not None:
        write_demix_gains(gains, patches, gains_path)
    out = subtract_sources(vm, gains, idx, solint_t, solint_f, timestep, freqstep, scalar=(method == "scalar"),
                           gain="scalar" if method == "scalar" else gain, obs_first=obs_first)
    named = gains.withColumn("patch", F.element_at(F.array(*[F.lit(p) for p in patches]), F.col("patch_idx") + 1))
    return out.select(vis.columns), named


def write_demix_gains(gains: DataFrame, patches, path: str, mode: str = "overwrite") -> None:
    """Gains sink: one partition folder per observation (unique per input); the folders of other
    observations stay as they are."""
    named = gains.withColumn("patch", F.element_at(F.array(*[F.lit(p) for p in patches]), F.col("patch_idx") + 1))
    # ranges of intervals: a task meets few observations and opens few files, and a large observation is several tasks' work
    named = named.repartitionByRange("obs_id", "tsol", "fsol")
    named.write.mode(mode).partitionBy("obs_id").option("partitionOverwriteMode", "dynamic").parquet(path)
