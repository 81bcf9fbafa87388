"""Static flagging (PreFlagger-like) as row-local column expressions.

Flag operators never drop rows: they rewrite the ``flag`` struct, so the whole
chain fuses into one codegen stage after the scan. Criteria given together
are AND-ed; a call without any criterion flags nothing (documented decision).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cplx as C
from ..plans.joins import bounded_broadcast, per_observation

POLS = C.POLS

# Frequency unit multipliers accepted in range strings.
_UNITS = {"hz": 1.0, "khz": 1e3, "mhz": 1e6, "ghz": 1e9}


def _apply(vis: DataFrame, match, mode: str = "set") -> DataFrame:
    """Set (``mode='set'``) or clear (``mode='clear'``) flags where ``match``.

    ``match`` is one boolean Column for all polarisations or a dict pol->Column.
    """
    if mode not in ("set", "clear"):
        raise ValueError(f"mode must be 'set' or 'clear', got {mode!r}")
    per_pol = match if isinstance(match, dict) else {p: match for p in POLS}
    fields = []
    for p in POLS:
        m = F.coalesce(per_pol[p], F.lit(False))
        old = F.col("flag").getField(p)
        new = (old | m) if mode == "set" else (old & ~m)
        fields.append(new.alias(p))
    return vis.withColumn("flag", F.struct(*fields))


def parse_freq_ranges(text: str) -> list[tuple[float, float]]:
    """Parse ``"[960..961 MHz, 1.2GHz+-5MHz]"`` into inclusive (lo, hi) in Hz."""
    body = text.strip().strip("[]")
    out = []
    for part in filter(None, (p.strip() for p in body.split(","))):
        m = re.fullmatch(r"(\S+?)\s*([kKmMgG]?[hH][zZ])?\s*\.\.\s*(\S+?)\s*([kKmMgG]?[hH][zZ])?", part)
        pm = re.fullmatch(r"(\S+?)\s*([kKmMgG]?[hH][zZ])?\s*\+-\s*(\S+?)\s*([kKmMgG]?[hH][zZ])?", part)
        if m:
            a, ua, b, ub = m.groups()
            ub = ub or ua or "hz"
            ua = ua or ub
            out.append((float(a) * _UNITS[ua.lower()], float(b) * _UNITS[ub.lower()]))
        elif pm:
            c, uc, h, uh = pm.groups()
            uh = uh or uc or "hz"
            uc = uc or uh
            cc, hh = float(c) * _UNITS[uc.lower()], float(h) * _UNITS[uh.lower()]
            out.append((cc - hh, cc + hh))
        else:
            raise ValueError(f"cannot parse frequency range {part!r}")
    return out


def parse_channel_ranges(text: str) -> list[tuple[int, int | None]]:
    """Parse ``"[0..nchan]"`` / ``"[0..3, 7]"``; ``nchan`` means open-ended."""
    body = text.strip().strip("[]")
    out: list[tuple[int, int | None]] = []
    for part in filter(None, (p.strip() for p in body.split(","))):
        if ".." in part:
            a, b = (s.strip() for s in part.split(".."))
            out.append((int(a), None if b == "nchan" else int(b)))
        else:
            out.append((int(part), int(part)))
    return out


def _any(conds: Iterable[Column]) -> Column:
    out = None
    for c in conds:
        out = c if out is None else (out | c)
    return out if out is not None else F.lit(False)


def freq_match(ranges: Sequence[tuple[float, float]]) -> Column:
    return _any(F.col("freq").between(F.lit(float(lo)), F.lit(float(hi))) for lo, hi in ranges)


def chan_match(ranges: Sequence[tuple[int, int | None]]) -> Column:
    conds = []
    for a, b in ranges:
        conds.append(F.col("chan") >= F.lit(a) if b is None else F.col("chan").between(a, b))
    return _any(conds)


def flag_freq_ranges(vis: DataFrame, ranges, mode: str = "set", spw: DataFrame | None = None,
                     literal_limit: int = 32) -> DataFrame:
    """Flag channels whose frequency lies in one of the inclusive ``ranges``.

    Short lists become an OR of ``between`` predicates (row-local). Long lists
    or a DataFrame of ranges go through ``range_join_flags``.
    """
    if isinstance(ranges, str):
        ranges = parse_freq_ranges(ranges)
    if isinstance(ranges, DataFrame) or len(ranges) > literal_limit:
        return range_join_flags(vis, ranges, mode=mode, spw=spw)
    return _apply(vis, freq_match(ranges), mode)


def range_join_flags(vis: DataFrame, ranges, mode: str = "set", spw: DataFrame | None = None) -> DataFrame:
    """Non-equi channel-in-range match, resolved on the channel table.

    The match runs on the small channel table (``spw`` or the distinct
    (obs_id, chan, freq) of ``vis``), never on the visibilities, and as an
    equi-join: each range is expanded over the fixed-width frequency buckets
    it touches (width = span of all ranges / number of ranges) and a channel
    meets the ranges of its own bucket, then ``between`` decides. The flagged
    (obs_id, chan) pairs come back through an equi-join.
    """
    spark = vis.sparkSession
    if not isinstance(ranges, DataFrame):
        ranges = spark.createDataFrame([(float(a), float(b)) for a, b in ranges], "lo double, hi double")
    r = ranges.select("lo", "hi")
    st = r.agg(F.min("lo").alias("a"), F.max("hi").alias("b"), F.count(F.lit(1)).alias("n")).first()
    channels = spw.select("obs_id", "chan", "freq") if spw is not None else \
        vis.select("obs_id", "chan", "freq").distinct()
    if not st["n"]:
        hit = channels.limit(0).select("obs_id", "chan")
    else:
        lo0, hi0 = float(st["a"]), float(st["b"])
        width = (hi0 - lo0) / st["n"] if hi0 > lo0 else 1.0
        bucket = lambda c: F.floor((c - F.lit(lo0)) / F.lit(width)).cast("bigint")
        rb = bounded_broadcast(r.filter(F.col("hi") >= F.col("lo")).select(
            "lo", "hi", F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi")))).alias("_b")))
        ch = channels.filter(F.col("freq").between(F.lit(lo0), F.lit(hi0))).withColumn("_b", bucket(F.col("freq")))
        hit = (ch.join(rb, "_b").filter(F.col("freq").between(F.col("lo"), F.col("hi")))
               .select("obs_id", "chan").distinct())
    hit = hit.withColumn("_hit", F.lit(True))
    out = vis.join(per_observation(hit), ["obs_id", "chan"], "left")
    return _apply(out, F.col("_hit"), mode).drop("_hit").select(vis.columns)


def flag_channels(vis: DataFrame, chans, mode: str = "set") -> DataFrame:
    """Flag by channel index ranges, e.g. ``"[0..nchan]"`` (all channels)."""
    if isinstance(chans, str):
        chans = parse_channel_ranges(chans)
    return _apply(vis, chan_match(chans), mode)


def flag_time_range(vis: DataFrame, t0: float, t1: float, mode: str = "set") -> DataFrame:
    return _apply(vis, F.col("time").between(F.lit(float(t0)), F.lit(float(t1))), mode)


def flag_uv_range(vis: DataFrame, uvmin: float = 0.0, uvmax: float | None = None, mode: str = "set") -> DataFrame:
    """Flag samples whose projected baseline length sqrt(u^2+v^2) lies in [uvmin, uvmax]."""
    uv = F.hypot(F.col("u"), F.col("v"))
    m = uv >= F.lit(float(uvmin))
    if uvmax is not None:
        m = m & (uv <= F.lit(float(uvmax)))
    return _apply(vis, m, mode)


def flag_amplitude(vis: DataFrame, amplmin: float | None = None, amplmax: float | None = None,
                   mode: str = "set") -> DataFrame:
    """Flag where any polarisation's amplitude is below ``amplmin`` or above ``amplmax``.

    A hit on one polarisation flags all four of that sample (decision).
    """
    hits = []
    for p in POLS:
        a = C.c_abs(F.col("data").getField(p))
        if amplmin is not None:
            hits.append(a < F.lit(float(amplmin)))
        if amplmax is not None:
            hits.append(a > F.lit(float(amplmax)))
    return _apply(vis, _any(hits), mode)


def _antenna_match(vis: DataFrame, antennas: Sequence, antenna_table: DataFrame | None):
    """(rows with what the match needs, match): baselines that touch the antennas (indices or names)."""
    conds = []
    idx = [a for a in antennas if isinstance(a, int)]
    names = [a for a in antennas if isinstance(a, str)]
    if len(idx) + len(names) != len(list(antennas)):
        raise ValueError(f"antennas are indices or names, got {list(antennas)!r}")
    if idx:
        conds.append(F.col("ant1").isin(idx) | F.col("ant2").isin(idx))
    if names:
        if antenna_table is None:
            raise ValueError("antenna names need an antenna table (obs_id, ant, name)")
        bad = per_observation(antenna_table.filter(F.col("name").isin(names)).select("obs_id", "ant").distinct())
        b1 = bad.select("obs_id", F.col("ant").alias("ant1"), F.lit(True).alias("_b1"))
        b2 = bad.select("obs_id", F.col("ant").alias("ant2"), F.lit(True).alias("_b2"))
        vis = vis.join(b1, ["obs_id", "ant1"], "left").join(b2, ["obs_id", "ant2"], "left")
        conds.append(F.col("_b1").isNotNull() | F.col("_b2").isNotNull())
    return vis, _any(conds) if conds else None


def flag_antennas(vis: DataFrame, antennas: Sequence = (), autocorr: bool = False,
                  antenna_table: DataFrame | None = None, mode: str = "set") -> DataFrame:
    """Flag baselines touching the given antennas (indices or names), and/or autos."""
    out, touched = _antenna_match(vis, antennas, antenna_table)
    conds = ([F.col("ant1") == F.col("ant2")] if autocorr else []) + ([touched] if touched is not None else [])
    if not conds:
        return vis
    return _apply(out, _any(conds), mode).select(vis.columns)


def preflag(vis: DataFrame, mode: str = "set", chan=None, freqrange=None, timerange=None,
            uvmrange=None, amplmin=None, amplmax=None, autocorr: bool = False,
            antennas: Sequence = (), antenna_table: DataFrame | None = None) -> DataFrame:
    """PreFlagger step: AND of all given criteria, then set or clear.

    Without any criterion the step is a no-op (decision).
    """
    conds = []
    if chan is not None:
        conds.append(chan_match(parse_channel_ranges(chan) if isinstance(chan, str) else chan))
    if freqrange is not None:
        conds.append(freq_match(parse_freq_ranges(freqrange) if isinstance(freqrange, str) else freqrange))
    if timerange is not None:
        conds.append(F.col("time").between(float(timerange[0]), float(timerange[1])))
    if uvmrange is not None:
        conds.append(F.hypot("u", "v").between(float(uvmrange[0]), float(uvmrange[1])))
    if amplmin is not None or amplmax is not None:
        amp_hits = []
        for p in POLS:
            a = C.c_abs(F.col("data").getField(p))
            if amplmin is not None:
                amp_hits.append(a < F.lit(float(amplmin)))
            if amplmax is not None:
                amp_hits.append(a > F.lit(float(amplmax)))
        conds.append(_any(amp_hits))
    if autocorr:
        conds.append(F.col("ant1") == F.col("ant2"))
    columns = vis.columns
    vis, touched = _antenna_match(vis, antennas, antenna_table)
    if touched is not None:
        conds.append(touched)
    if not conds:
        if mode not in ("set", "clear"):
            raise ValueError(f"mode must be 'set' or 'clear', got {mode!r}")
        return vis
    m = conds[0]
    for c in conds[1:]:
        m = m & c
    return _apply(vis, m, mode).select(columns)


def clear_flags(vis: DataFrame, **criteria) -> DataFrame:
    """PreFlagger ``mode: clear``: matching samples become unflagged."""
    if not criteria:
        criteria = {"chan": "[0..nchan]"}
    return preflag(vis, mode="clear", **criteria)


def mask_flagged(vis: DataFrame) -> DataFrame:
    """Replace flagged samples by complex zero, per polarisation."""
    fields = [F.when(F.col("flag").getField(p), C.c_zero()).otherwise(F.col("data").getField(p)).alias(p)
              for p in POLS]
    return vis.withColumn("data", F.struct(*fields))
