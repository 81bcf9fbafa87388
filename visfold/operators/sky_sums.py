"""Sums over many sky components by numpy, for ``predict``: the formulas of ``functions.sky`` on arrays.

A batch of points (u, v, w, freq, phase centre, track) is taken by phase centre, frequency and track, where fluxes and direction
cosines are the same for all its points. A track is one baseline of an observation, whose points lie on a smooth curve. Where a
polynomial x0 + c1 t + c2 t^2 + .. (t from -1 to 1) meets a track's points to rounding, the components are dealt into cells by their
phases' rates along it; a component's exponent less that of its cell's centre is a small polynomial in t, so its term is a power series
in t, whose coefficients are added up once for all points. The series end where a bound of the rest is below ``TAIL`` of
the flux. What has no short series (points on no such curve, short tracks, steep tapers) is summed term by term, with sines and
cosines in tiles of ``TILE`` numbers, which stay in a core's cache. Memory is bounded by a batch and the sky. As in the
expression form, a null input makes the whole sum 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.sky import ARCSEC, FWHM_TO_SIGMA, SPEED_OF_LIGHT

#: Numbers in a tile (points x components).
TILE = 1 << 14
#: Points that a track has at least, coefficients that a series has at most, and the share of the flux that it may leave out.
LEAST_POINTS, MOST_TERMS, TAIL = 24, 40, 1e-15
#: Degrees of the curves that are tried.
DEGREES = (1, 2, 3, 5, 8)
#: A cell's components differ by at most so many radians over half a track.
CELL = 0.5
_STEPS = 1 << 12
_COS, _SIN = (f(2.0 * np.pi * np.arange(_STEPS) / _STEPS) for f in (np.cos, np.sin))


def phasors(turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(-2 pi i turns): the nearest entry of a table, turned by the rest (at most 0.0008 radians)."""
    k = np.rint(turns * _STEPS)
    r = turns - k * (1.0 / _STEPS)
    r *= 2.0 * np.pi
    q = r * r
    c = 1.0 - q * (0.5 - q * (1.0 / 24.0))
    r *= 1.0 - q * (1.0 / 6.0 - q * (1.0 / 120.0))
    at = k.astype(np.int64) & (_STEPS - 1)
    a, b = _COS[at], _SIN[at]
    return a * c - b * r, -(b * c + a * r)


def _curve(x: np.ndarray):
    """(t, coefficients c0, c1, .., do they meet the points?) of a smooth curve; None if the points are nowhere near one."""
    middle = x[len(x) // 2]
    d = x - middle
    mean = d.mean(axis=0)
    t = (d - mean) @ np.linalg.svd(d - mean, full_matrices=False)[2][0]
    low, high = t.min(), t.max()
    if not high > low:
        return None
    t = (2.0 * t - low - high) / (high - low)
    within = 32 * np.finfo(float).eps * np.abs(x).max()
    for degree in DEGREES:
        powers = t[:, None] ** np.arange(degree + 1)
        c = np.linalg.lstsq(powers, d, rcond=None)[0]
        off = np.abs(powers @ c - d).max()
        if off <= within:
            break
    c[0] += middle
    return (t, c, off <= within) if off <= 1e-2 * (high - low) else None


def _terms(bounds: list[float]) -> int | None:
    """Terms of exp(sum_m p_m t^m) for |p_m| within the bounds that leave out less than ``TAIL``; None if too many."""
    c = [1.0]
    for n in range(1, 2 * MOST_TERMS):
        c.append(sum(m * b * c[n - m] for m, b in enumerate(bounds, 1) if m <= n) / n)
    rest = np.cumsum(c[::-1])[::-1]
    short = np.flatnonzero(rest <= TAIL)
    return int(short[0]) if len(short) and short[0] <= MOST_TERMS else None


def _doubles(rows, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 for null) and where they are null."""
    null = np.array([r[name] is None for r in rows], bool)
    return np.array([0.0 if r[name] is None else r[name] for r in rows], float), null


@dataclass
class SkyArrays:
    """Components as arrays, point sources before Gaussians."""
    patch: np.ndarray
    fixed: np.ndarray  # l and m are given
    l: np.ndarray  # noqa: E741
    m: np.ndarray
    ra: np.ndarray
    dec: np.ndarray
    no_angle: np.ndarray
    flux: np.ndarray
    per_ref: np.ndarray  # 1 / reference frequency
    flat: np.ndarray  # no reference frequency
    si: np.ndarray  # coefficients, 0 beyond a component's own
    n_si: np.ndarray
    log_si: np.ndarray
    null: np.ndarray  # a value without which the flux or shape is null
    n_points: int
    shape: tuple[np.ndarray, np.ndarray, np.ndarray]  # of the Gaussians: sigmas along both axes, position angle

    @classmethod
    def of(cls, rows) -> SkyArrays:
        # neighbours side by side, so that a cell's components lie close in memory
        rows = sorted(rows, key=lambda r: (r["ra"] if r["l"] is None else r["l"]) or 0.0)
        gauss = [(r["type"] or "POINT").upper() == "GAUSSIAN" for r in rows]
        rows = [r for r, g in zip(rows, gauss) if not g] + [r for r, g in zip(rows, gauss) if g]
        n_points = len(rows) - sum(gauss)
        (l_, no_l), (m_, no_m), (ra, no_ra), (dec, no_dec) = (_doubles(rows, k) for k in ("l", "m", "ra", "dec"))
        flux, null = _doubles(rows, "flux_i")
        per_ref, no_inverse = _doubles(rows, "per_ref")
        flat = np.array([r["ref_freq"] is None for r in rows], bool)
        lists = [r["si"] or [] for r in rows]
        si = np.zeros((len(rows), max((len(x) for x in lists), default=0)))
        for i, x in enumerate(lists):
            si[i, :len(x)] = [0.0 if c is None else c for c in x]
        null = null | (~flat & (no_inverse | np.array([None in x for x in lists], bool)))
        major, no_major = _doubles(rows, "major")
        minor, no_minor = _doubles(rows, "minor")
        angle, _ = _doubles(rows, "orientation")
        null[n_points:] |= (no_major | no_minor)[n_points:]
        fixed = ~(no_l | no_m)
        sigma = ARCSEC * FWHM_TO_SIGMA
        return cls(np.array([r["patch"] for r in rows], object), fixed, l_, m_, ra, dec, ~fixed & (no_ra | no_dec), flux, per_ref, flat, si,
                   np.array([len(x) for x in lists], int), np.array([r["log_si"] is None or r["log_si"] for r in rows], bool), null, n_points,
                   (major[n_points:] * sigma, minor[n_points:] * sigma, np.radians(angle[n_points:])))

    def directions(self, centre: tuple[float, float] | None):
        """(3 x components) direction cosines l, m, n - 1, and where they are null."""
        l_, m_, null = self.l, self.m, self.no_angle
        if not self.fixed.all():
            if centre is None:
                null = ~self.fixed
            else:
                ra0, dec0 = centre
                d = self.ra - ra0
                l_ = np.where(self.fixed, l_, np.cos(self.dec) * np.sin(d))
                m_ = np.where(self.fixed, m_, np.sin(self.dec) * np.cos(dec0) - np.cos(self.dec) * np.sin(dec0) * np.cos(d))
        return np.stack([l_, m_, np.sqrt(1.0 - l_ * l_ - m_ * m_) - 1.0]), null

    def fluxes(self, freq: float):
        """Fluxes at a frequency, and where they are null."""
        x = freq * self.per_ref
        lx = np.log10(np.where(x > 0, x, 1.0))
        log, lin = np.zeros_like(x), np.zeros_like(x)
        for k in range(self.si.shape[1]):
            log += self.si[:, k] * lx ** k
            lin += self.si[:, k] * np.where(self.n_si > k, x - 1.0, 0.0) ** (k + 1)
        out = np.where(self.log_si, self.flux * np.power(x, log), self.flux + lin)
        # the logarithm of what isn't positive is null
        null = self.null | (~self.flat & self.log_si & (self.n_si > 0) & ~(x > 0) & ~np.isnan(x))
        return np.where(self.flat, self.flux, out), null

    def sums(self, uvw: np.ndarray, freq: float, at_centre, at_freq, sets: list[np.ndarray]) -> list[np.ndarray | None]:
        """Complex model of each set of components (masks) at the points of a track; None if a term is null.
        at_centre, at_freq: what ``directions`` and ``fluxes`` give."""
        (lmn, no_direction), (flux, no_flux) = at_centre, at_freq
        null = no_direction | no_flux
        x, out = uvw * (freq / SPEED_OF_LIGHT), []
        with np.errstate(all="ignore"):
            for s in sets:
                if null[s].any():
                    out.append(None)
                    continue
                which = np.flatnonzero(s)
                points = np.searchsorted(which, self.n_points)
                out.append(sum((self._along(x, lmn[:, w], flux[w], w) for w in (which[:points], which[points:]) if len(w)), np.zeros(len(x), complex)))
        return out

    def _along(self, x: np.ndarray, lmn: np.ndarray, flux: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The sum at points (in wavelengths): by series along their curve, halves of it, or term by term."""
        if len(x) < LEAST_POINTS or not (np.isfinite(x).all() and np.isfinite(lmn).all() and np.isfinite(flux).all()):
            return self._each(x, lmn, flux, which)
        curve = _curve(x)
        if curve is None:
            return self._each(x, lmn, flux, which)
        t, c, met = curve
        out = self._series(x, t, c, lmn, flux, which) if met else None
        if out is None:  # half a curve is flatter
            order = np.argsort(t, kind="stable")
            out = np.empty(len(x), complex)
            for half in (order[:len(x) // 2], order[len(x) // 2:]):
                out[half] = self._along(x[half], lmn, flux, which)
        return out

    def _series(self, x, t, c, lmn, flux, which):
        """The sum along a curve x(t), or None where too many components have no short series."""
        rate = (2.0 * np.pi / CELL) * (c[1] @ lmn)
        low = rate.min()
        cells = rate.max() - low
        if cells >= min(1 << 16, len(flux) // 4):
            return None
        cell = (rate - low).astype(np.uint16)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        starts = np.append(np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])), len(cell))
        edges = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(cell), TILE)), len(starts) - 1))
        centre, moments, rest = np.empty((3, len(starts) - 1)), np.zeros((MOST_TERMS, len(starts) - 1), complex), []
        for a, b in zip(edges[:-1], edges[1:]):  # whole cells, as many as stay in a core's cache
            at, begin = order[starts[a]:starts[b]], starts[a:b] - starts[a]
            centre[:, a:b], series, steep = self._cells(c, np.stack([x.take(at) for x in lmn]), flux.take(at), which.take(at), begin)
            rest.append(at[steep])
            if series is None or sum(map(len, rest)) > len(flux) // 16:
                return None
            moments[:len(series), a:b] = series
        powers = t[:, None] ** np.arange(MOST_TERMS)
        re, im = phasors((x - c[0]) @ centre)
        out = ((re + 1j * im) * (powers @ moments.real + 1j * (powers @ moments.imag))).sum(axis=1)
        rest = np.sort(np.concatenate(rest))
        return out + self._each(x, lmn[:, rest], flux[rest], which[rest]) if len(rest) else out

    def _cells(self, c, s, flux, which, begin):
        """Of some cells along a curve: their centres, their series' coefficients (None if they are too many), and which components are
        too steep for one and left out. begin: where each cell begins."""
        counts = np.diff(np.append(begin, len(flux)))
        centre = np.add.reduceat(s, begin, axis=1) / counts
        less = s - np.repeat(centre, counts, axis=1)
        p = [-2j * np.pi * (k @ less) for k in c[1:]]
        re, im = phasors(c[0] @ s)
        last = (re + 1j * im) * flux
        if which[0] >= self.n_points:  # the taper's exponent is a polynomial in t, too
            along, across = self._axes(c, which - self.n_points)
            taper = [sum(along[i] * along[m - i] + across[i] * across[m - i] for i in range(max(0, m - len(c) + 1), min(m, len(c) - 1) + 1))
                     for m in range(2 * len(c) - 1)]
            last *= np.exp(-2.0 * np.pi ** 2 * taper[0])
            p = [(p[m - 1] if m < len(c) else 0.0) - 2.0 * np.pi ** 2 * taper[m] for m in range(1, len(taper))]
        sizes = [np.abs(q.real) + np.abs(q.imag) for q in p]  # no less than their absolute values
        steep = sum(sizes) > 2.0 * CELL
        if steep.any():
            last[steep] = 0.0
            p, sizes = ([np.where(steep, 0.0, q) for q in x] for x in (p, sizes))
        terms = _terms([float(q.max()) for q in sizes])
        if terms is None:
            return centre, None, steep
        moments = np.zeros((max(1, terms), len(begin)), complex)
        moments[0] = np.add.reduceat(last, begin)
        p, last = [(m, m * q) for m, q in enumerate(p, 1)], [last]
        for n in range(1, terms):
            new = p[0][1] * last[0]
            for m, q in p[1:n]:
                new += q * last[m - 1]
            new *= 1.0 / n
            moments[n] = np.add.reduceat(new, begin)
            last = [new, *last][:len(p)]
        return centre, moments, steep

    def _each(self, x: np.ndarray, lmn: np.ndarray, flux: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The sum term by term; which: the components' places, in ascending order."""
        out = np.zeros(len(x), complex)
        points = int(np.searchsorted(which, self.n_points))
        width = min(max(1, len(flux)), TILE)
        for a in range(0, len(x), max(1, TILE // width)):
            p = x[a:a + max(1, TILE // width)]
            for b in range(0, len(flux), width):
                re, im = phasors(p @ lmn[:, b:b + width])
                g = max(b, points)
                if g < b + width and g < len(flux):
                    along, across = self._axes(p, which[g:b + width] - self.n_points)
                    taper = np.exp(-2.0 * np.pi ** 2 * (along * along + across * across))
                    re[:, g - b:] *= taper
                    im[:, g - b:] *= taper
                w = flux[b:b + width]
                out[a:a + len(p)] += re @ w + 1j * (im @ w)
        return out

    def _axes(self, uvw: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(u, v) along both axes of Gaussians, times their sigmas."""
        major, minor, angle = (x[which] for x in self.shape)
        u, v = uvw[:, :1], uvw[:, 1:2]
        return (u * np.sin(angle) + v * np.cos(angle)) * major, (u * np.cos(angle) - v * np.sin(angle)) * minor


def _column(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return x.fill_null(0.0).to_numpy(zero_copy_only=False).astype(float), x.is_null().to_numpy(zero_copy_only=False)


def model_function(sky: SkyArrays, patches: list):
    """Arrow function of (track, u, v, w, freq[, ra0, dec0]): a struct with the model ``m<k>`` of each patch; a patch None is the whole sky.
    track: a number that points of one baseline share; any will do, as what has no short series is summed term by term."""
    sets = [np.ones(len(sky.flux), bool) if p is None else sky.patch == p for p in patches]
    kind = ", ".join(f"m{k}: struct<re: double, im: double>" for k in range(len(patches)))

    def models(track: pa.Array, *columns: pa.Array) -> pa.Array:  # the hints tell Spark what kind of function it is
        values, nulls = zip(*[_column(x) for x in columns])
        n = len(values[0])
        sums = np.zeros((len(sets), n), complex)
        bad = np.logical_or.reduce(nulls[:4])
        uvw = np.stack(values[:3], axis=1)
        keys = np.stack([values[3]] + [np.where(x, np.nan, v) for v, x in zip(values[4:], nulls[4:])] + [_column(track)[0]], axis=1)
        distinct, group = np.unique(keys, axis=0, return_inverse=True)
        group = np.where(bad, -1, group.reshape(-1))
        order = np.argsort(group, kind="stable")
        ends = np.searchsorted(group[order], np.arange(len(distinct) + 1))
        at_centre, at_freq = {}, {}
        for i, key in enumerate(distinct):
            at = order[ends[i]:ends[i + 1]]
            if not len(at):
                continue
            no_centre = len(nulls) > 4 and (nulls[4][at[0]] or nulls[5][at[0]])
            centre, freq = None if len(key) == 2 or no_centre else tuple(key[1:3].tolist()), float(key[0])
            with np.errstate(all="ignore"):
                if centre not in at_centre:
                    at_centre = {centre: sky.directions(centre)}
                if freq not in at_freq:
                    at_freq[freq] = sky.fluxes(freq)
                    if len(at_freq) > 64:
                        at_freq = {freq: at_freq[freq]}
            for k, s in enumerate(sky.sums(uvw[at], freq, at_centre[centre], at_freq[freq], sets)):
                if s is not None:
                    sums[k, at] = s
        parts = [pa.StructArray.from_arrays([pa.array(s.real.copy()), pa.array(s.imag.copy())], names=["re", "im"]) for s in sums]
        return pa.StructArray.from_arrays(parts, names=[f"m{k}" for k in range(len(parts))])

    # called nondeterministic so that the planner neither repeats these sums for a filter on them nor moves them
    return F.arrow_udf(models, f"struct<{kind}>").asNondeterministic()
