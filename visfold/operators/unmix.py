"""Demixing by rotation, averaging and undoing the mixing (van der Tol, Jeffs & van der Veen 2007, IEEE TSP 55).

Averaged data phased to one patch still holds what is left of the others. For every direction d the samples of a bin are
phased to d and averaged, v_d; a source of direction e that is constant when phased to e adds to v_d its average times
A_de, the bin's mean of exp(i (phase_d - phase_e)). So v = A s, and s = A^-1 v are the patches apart.

Sums are one ``groupBy`` over bins with partial aggregation: D averages per polarisation, D model averages and D (D - 1) / 2
mean phase factors. The D x D inverses are taken in batches of bins, row by row, without another shuffle. A patch's
gains are then fitted alone, in groups D times smaller than those of the joint fit.

Defined results: flagged, non-finite and auto-correlation samples and weights that aren't positive take no part; a bin
that can't tell the patches apart (condition of A above ``max_condition``, as with fewer samples than patches) has no rows.
A row's weight is the bin's over the noise that undoing the mixing adds, (A^-1)_dd.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cplx as C
from ..functions import sky as SK
from ..plans.joins import per_observation
from ..session import ship_package
from .demix import DIAG, GAIN_SCHEMA, GAINS, _bins, solvable, solve_group, usable_for_fit

BIN = ["obs_id", "tsol", "fsol", "tbin", "fbin", "ant1", "ant2"]
#: Bins whose matrix is conditioned worse can't tell the patches apart.
MAX_CONDITION = 1e6


def patch_centres(components: DataFrame) -> list[dict]:
    """Flux-weighted centre per patch, in order of patches: l and m, or ra and dec where a component lacks l or m.

    Patches are few (each has a model column). Patches whose fluxes add up to nothing take the plain mean.
    """
    have = set(components.columns)

    def of(name: str) -> Column:
        return F.col(name).cast("double") if name in have else F.lit(None).cast("double")
    ra, dec = of("ra"), of("dec")
    parts = {"l": of("l"), "m": of("m"), "x": F.cos(dec) * F.cos(ra), "y": F.cos(dec) * F.sin(ra), "z": F.sin(dec)}
    flux = F.coalesce(of("flux_i"), F.lit(0.0))
    aggs = [F.max(of("l").isNull() | of("m").isNull()).alias("radec")]
    for k, c in parts.items():
        aggs.append(F.coalesce(F.try_divide(F.sum(flux * c), F.sum(F.when(c.isNotNull(), flux))), F.avg(c)).alias(k))
    rows = components.filter("patch IS NOT NULL").groupBy("patch").agg(*aggs).orderBy("patch").collect()
    out = []
    for r in rows:
        if not r["radec"]:
            out.append({"patch": r["patch"], "l": r["l"], "m": r["m"]})
        elif r["x"] is not None:
            out.append({"patch": r["patch"], "ra": float(np.arctan2(r["y"], r["x"])), "dec": float(np.arctan2(r["z"], np.hypot(r["x"], r["y"])))})
        else:
            raise ValueError(f"patch {r['patch']!r} has components with and without (l, m), and none by (ra, dec)")
    return out


def with_rotations(vis: DataFrame, centres: list[dict], obs_meta: DataFrame | None = None) -> DataFrame:
    """Add ``rot_<k>_re`` and ``rot_<k>_im``: the factor that phases a row to patch k. Centres by (ra, dec) need obs_meta (obs_id, ra0, dec0)."""
    if any("ra" in c for c in centres):
        if obs_meta is None:
            raise ValueError("centres given by (ra, dec) need obs_meta (obs_id, ra0, dec0)")
        placed = [SK.direction_cosines(F.lit(c["ra"]), F.lit(c["dec"]), F.col("ra0"), F.col("dec0")).alias(f"_c{k}")
                  for k, c in enumerate(centres) if "ra" in c]
        vis = vis.join(per_observation(obs_meta.select("obs_id", "ra0", "dec0").distinct().select("obs_id", *placed)), "obs_id", "left")
    phases = {}
    for k, c in enumerate(centres):
        if "ra" in c:
            lmn = [F.col(f"_c{k}").getField(x) for x in "lmn"]
        else:
            lmn = [F.lit(c["l"]), F.lit(c["m"]), F.lit(float(np.sqrt(1.0 - c["l"] ** 2 - c["m"] ** 2)))]
        phases[f"_ph{k}"] = SK.geometric_phase("u", "v", "w", "freq", *lmn)
    vis = vis.withColumns(phases)
    # flat columns: the fields of a struct would be worked out anew at every use
    rots = {f"rot_{k}_{x}": f(F.col(f"_ph{k}")) for k in range(len(centres)) for x, f in (("re", F.cos), ("im", F.sin))}
    return vis.withColumns(rots).drop(*phases, *[f"_c{k}" for k in range(len(centres))])


def _unmix_batches(n: int, names: list[str], max_condition: float):
    """Function for ``mapInPandas``: bins with averages -> one row per bin and patch."""
    upper = [(d, e) for d in range(n) for e in range(d + 1, n)]

    def complexes(pdf: pd.DataFrame, name: str) -> np.ndarray:
        return pdf[f"{name}_re"].to_numpy(dtype=float) + 1j * pdf[f"{name}_im"].to_numpy(dtype=float)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            A = np.zeros((len(pdf), n, n), dtype=complex)
            A[:, range(n), range(n)] = 1.0
            for d, e in upper:
                A[:, d, e] = complexes(pdf, f"a{d}_{e}")
                A[:, e, d] = A[:, d, e].conj()
            given = np.isfinite(A).all(axis=(1, 2))
            values, vectors = np.linalg.eigh(np.where(given[:, None, None], A, np.eye(n)))  # ascending
            apart = given & (values[:, 0] > 0) & (values[:, -1] <= max_condition * values[:, 0])
            pdf, values, vectors = pdf[apart], values[apart], vectors[apart]
            inverse = np.einsum("bik,bk,bjk->bij", vectors, 1.0 / values, vectors.conj())
            mixed = {p: np.stack([complexes(pdf, f"v{p}{d}") for d in range(n)], axis=1) for p in names}
            clear = {p: np.einsum("bij,bj->bi", inverse, v) for p, v in mixed.items()}
            for d in range(n):
                out = pdf[BIN].copy()
                out["patch_idx"] = np.int32(d)
                out["w"] = pdf["w"].to_numpy(dtype=float) / inverse[:, d, d].real
                for p in names:
                    out[f"v{p}_re"], out[f"v{p}_im"] = clear[p][:, d].real, clear[p][:, d].imag
                out["m_re"], out["m_im"] = pdf[f"m{d}_re"], pdf[f"m{d}_im"]
                yield out
    return run


def unmix_average(vis_models: DataFrame, centres: list[dict], timestep: int = 1, freqstep: int = 1, solint_t: int = 4, solint_f: int = 4,
                  pols=DIAG, obs_meta: DataFrame | None = None, obs_first=None, max_condition: float = MAX_CONDITION) -> DataFrame:
    """One row per bin and patch: the patch's own averaged data ``v<pol>_re/im`` and model ``m_re/im``, both phased to the
    patch's centre, and their weight ``w``. ``vis_models`` has a model column per patch (``patch_models``)."""
    n = len(centres)
    v = _bins(with_rotations(vis_models, centres, obs_meta), timestep, freqstep, solint_t, solint_f, obs_first)
    use = usable_for_fit(pols)

    def rotation(k: int) -> Column:
        return C.cpx(F.col(f"rot_{k}_re"), F.col(f"rot_{k}_im"))

    def mean(z: Column, name: str) -> list[Column]:
        return [F.sum(F.when(use, F.col("weight") * z.getField(x))).alias(f"{name}_{x}") for x in ("re", "im")]
    aggs = [F.sum(F.when(use, F.col("weight"))).alias("w")]
    for d in range(n):
        rot = rotation(d)
        for p in pols:
            aggs += mean(C.c_mul(F.col("data").getField(p), rot), f"v{p}{d}")
        aggs += mean(C.c_mul(F.col(f"model_{d}"), rot), f"m{d}")
        for e in range(d + 1, n):
            aggs += mean(C.c_mul(rot, C.c_conj(rotation(e))), f"a{d}_{e}")
    sums = v.groupBy(*BIN).agg(*aggs).filter(F.col("w") > 0)
    means = sums.select(*BIN, "w", *[F.try_divide(F.col(c), F.col("w")).alias(c) for c in sums.columns if c not in (*BIN, "w")])
    kinds = {f.name: f.dataType.simpleString() for f in means.schema}
    schema = ", ".join([f"{k} {kinds[k]}" for k in BIN] + ["patch_idx int", "w double"]
                       + [f"v{p}_{x} double" for p in pols for x in ("re", "im")] + ["m_re double", "m_im double"])
    ship_package(means.sparkSession)
    return means.mapInPandas(_unmix_batches(n, list(pols), max_condition), schema)


def fit_unmixed_gains(avg: DataFrame, max_iter: int = 100, gain: str = "scalar") -> DataFrame:
    """Gains per (obs, interval, patch, antenna) from ``unmix_average``, each patch by itself; rows as those of ``fit_direction_gains``.

    Gains of an interval that didn't converge are null; a patch without bins in an interval has no rows."""
    keys = ["obs_id", "tsol", "fsol", "patch_idx"]
    cols = [*keys, "ant1", "ant2", "w"] + [f"v{p}_{x}" for p in GAINS[gain][0] for x in ("re", "im")]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = solve_group(pdf, 1, max_iter, gain)
        out["patch_idx"] = np.int32(pdf["patch_idx"].iloc[0])
        return out
    return solvable(avg.select(*cols, F.col("m_re").alias("m0_re"), F.col("m_im").alias("m0_im")), keys, solve, GAIN_SCHEMA)
