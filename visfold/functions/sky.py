"""Sky-model scalar functions as column expressions.

Angles in radians, frequencies in Hz, baselines u, v, w in metres.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import cplx as C

# Speed of light (m/s) and FWHM -> sigma factor of a Gaussian.
SPEED_OF_LIGHT = 299792458.0
FWHM_TO_SIGMA = 1.0 / (2.0 * math.sqrt(2.0 * math.log(2.0)))
ARCSEC = math.pi / (180.0 * 3600.0)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_angle(text, kind: str = "ra") -> Column:
    """Angle text -> radians.

    Accepts ``52.05deg``, ``0.9rad``, plain degrees, ``hh:mm:ss.s`` (right
    ascension, hours) and ``dd.mm.ss.s`` (declination, three dot-separated
    fields, degrees).
    """
    t = F.trim(_c(text))
    sexa_ra = F.split(t, ":")
    sexa_dec = F.split(t, r"\.")
    sign = F.when(t.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))

    def dms(parts, scale):
        a = F.abs(F.try_element_at(parts, F.lit(1)).cast("double"))
        b = F.try_element_at(parts, F.lit(2)).cast("double")
        # seconds may carry a fraction after a further dot (dd.mm.ss.sss)
        c = F.concat_ws(".", F.slice(parts, 3, 2)).cast("double")
        return sign * F.radians((a + b / F.lit(60.0) + c / F.lit(3600.0)) * F.lit(scale))

    return (F.when(t.endswith("deg"), F.radians(F.regexp_replace(t, "deg$", "").cast("double")))
            .when(t.endswith("rad"), F.regexp_replace(t, "rad$", "").cast("double"))
            .when(F.lit(kind == "ra") & t.contains(":"), dms(sexa_ra, 15.0))
            .when(F.lit(kind == "dec") & (F.size(sexa_dec) >= 3) & ~t.rlike("[eE]"), dms(sexa_dec, 1.0))
            .otherwise(F.radians(t.cast("double"))))


def direction_cosines(ra, dec, ra0, dec0) -> Column:
    """struct(l, m, n) of a direction relative to the phase centre (ra0, dec0)."""
    ra, dec, ra0, dec0 = _c(ra), _c(dec), _c(ra0), _c(dec0)
    d = ra - ra0
    l_ = F.cos(dec) * F.sin(d)
    m_ = F.sin(dec) * F.cos(dec0) - F.cos(dec) * F.sin(dec0) * F.cos(d)
    n_ = F.sqrt(F.lit(1.0) - l_ * l_ - m_ * m_)
    return F.struct(l_.alias("l"), m_.alias("m"), n_.alias("n"))


def component_flux(flux_i, si, log_si, ref_freq, freq) -> Column:
    """Stokes I at ``freq``.

    Logarithmic: I (f/f0)^(c0 + c1 log10(f/f0) + c2 log10(f/f0)^2 + ..).
    Linear: I + sum_k c_k (f/f0 - 1)^(k+1).
    """
    flux_i, si, log_si, ref_freq, freq = map(_c, (flux_i, si, log_si, ref_freq, freq))
    x = freq / ref_freq
    lx = F.log10(x)
    expo = F.aggregate(F.transform(F.coalesce(si, F.array().cast("array<double>")),
                                   lambda c, k: c * F.pow(lx, k.cast("double"))),
                       F.lit(0.0), lambda acc, y: acc + y)
    lin = F.aggregate(F.transform(F.coalesce(si, F.array().cast("array<double>")),
                                  lambda c, k: c * F.pow(x - F.lit(1.0), (k + 1).cast("double"))),
                      F.lit(0.0), lambda acc, y: acc + y)
    return F.when(F.coalesce(log_si, F.lit(True)), flux_i * F.pow(x, expo)).otherwise(flux_i + lin)


def gaussian_shape(u, v, freq, major_arcsec, minor_arcsec, orientation_deg) -> Column:
    """Visibility taper of an elliptical Gaussian (FWHM axes in arcsec, position angle in deg).

    shape = exp(-2 pi^2 (s_maj^2 a^2 + s_min^2 b^2)) with a, b the uv
    components (in wavelengths) along the major and minor axes.
    """
    u, v, freq = _c(u), _c(v), _c(freq)
    maj, mnr, pa = _c(major_arcsec), _c(minor_arcsec), F.radians(_c(orientation_deg))
    scale = freq / F.lit(SPEED_OF_LIGHT)
    ul, vl = u * scale, v * scale
    along = ul * F.sin(pa) + vl * F.cos(pa)
    across = ul * F.cos(pa) - vl * F.sin(pa)
    s_maj = maj * F.lit(ARCSEC * FWHM_TO_SIGMA)
    s_min = mnr * F.lit(ARCSEC * FWHM_TO_SIGMA)
    return F.exp(F.lit(-2.0 * math.pi ** 2) * (s_maj * s_maj * along * along + s_min * s_min * across * across))


def component_shape(ctype, u, v, freq, major, minor, orientation) -> Column:
    """1 for POINT, the Gaussian taper for GAUSSIAN."""
    return F.when(_c(ctype) == "GAUSSIAN", gaussian_shape(u, v, freq, major, minor, orientation)).otherwise(F.lit(1.0))


def geometric_phase(u, v, w, freq, l_, m_, n_) -> Column:
    """2 pi f/c (u l + v m + w (n - 1))."""
    u, v, w, freq, l_, m_, n_ = map(_c, (u, v, w, freq, l_, m_, n_))
    return F.lit(2.0 * math.pi) * freq / F.lit(SPEED_OF_LIGHT) * (u * l_ + v * m_ + w * (n_ - F.lit(1.0)))


def phase_rotate(data, u, v, w, freq, l_: float, m_: float) -> Column:
    """Multiply every polarisation by exp(+i 2 pi f/c (u l + v m + w (n - 1)))."""
    n_ = math.sqrt(1.0 - l_ * l_ - m_ * m_)
    ph = geometric_phase(u, v, w, freq, F.lit(float(l_)), F.lit(float(m_)), F.lit(n_))
    rot = C.c_expi(ph)
    data = _c(data)
    return F.struct(*[C.c_mul(data.getField(p), rot).alias(p) for p in C.POLS])
