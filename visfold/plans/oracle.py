"""SQL text builders for the DuckDB oracle.

The oracle re-derives the fixtures from the same parquet tables with plain
SQL, so each registered Spark query is checked against an independent
formulation. Doubles are written as ``4e1`` (a bare ``40.0`` is DECIMAL in
both engines, with different precision); results are rounded the same way
on both sides.
"""

from __future__ import annotations

from ..functions.compare import qround_sql as qr
from ..sources.testviews import ANTENNA_SQL, BURSTS_CTE, VIS_CTE

POLS = ("xx", "xy", "yx", "yy")
KEY = "obs_id, slot, ant1, ant2, chan"

# vis with one flag per polarisation (all four equal in the fixture)
VIS4_CTE = "vis4 AS (SELECT * EXCLUDE (flag), flag AS fxx, flag AS fxy, flag AS fyx, flag AS fyy FROM vis)"


def dbl(x: float) -> str:
    """A double literal DuckDB will not read as DECIMAL."""
    return repr(float(x)) if "e" in repr(float(x)) else f"{float(x)!r}e0".replace(".0e0", "e0")


def with_vis(*ctes: str) -> str:
    parts = [VIS_CTE, VIS4_CTE, *ctes]
    return "WITH " + ",\n".join(parts) + "\n"


def with_bursts(*ctes: str) -> str:
    return "WITH " + ",\n".join([BURSTS_CTE, VIS4_CTE, *ctes]) + "\n"


def with_vis_ant(*ctes: str) -> str:
    return with_vis(ANTENNA_SQL, *ctes)


def out_cols(digits: int = 6, extra=("time", "freq", "u", "v", "w", "weight")) -> str:
    cols = ["obs_id", "slot", "ant1", "ant2", "chan"]
    cols += [f"{qr(c, digits)} AS {c}" for c in extra]
    cols += [f"{qr(p + '_' + x, digits)} AS {p}_{x}" for p in POLS for x in ("re", "im")]
    cols += [f"f{p} AS flag_{p}" for p in POLS]
    return ", ".join(cols)


def average_sql(src: str, timestep: int, freqstep: int, name: str) -> str:
    """CTE ``name`` averaging relation ``src`` (vis4 layout) like ``average``."""
    if timestep > 1:
        rel = (f"(SELECT s.*, s.slot - m.first_slot AS rel FROM {src} s JOIN "
               f"(SELECT obs_id, min(slot) AS first_slot FROM {src} GROUP BY obs_id) m USING (obs_id))")
        tbin = f"CAST(floor(rel/{timestep}e0) AS BIGINT)"
    else:
        rel, tbin = src, "slot"
    fbin = f"CAST(floor(chan/{freqstep}e0) AS INT)"
    sel = [f"obs_id, {tbin} AS slot, ant1, ant2, {fbin} AS chan",
           "avg(time) AS time, avg(freq) AS freq, avg(u) AS u, avg(v) AS v, avg(w) AS w",
           "sum(CASE WHEN (NOT fxx OR NOT fxy OR NOT fyx OR NOT fyy) THEN weight ELSE 0e0 END) AS weight"]
    for p in POLS:
        wp = f"(CASE WHEN NOT f{p} THEN weight ELSE 0e0 END)"
        for x in ("re", "im"):
            sel.append(f"CASE WHEN count_if(NOT f{p}) > 0 THEN sum({wp}*{p}_{x})/sum({wp}) "
                       f"ELSE avg({p}_{x}) END AS {p}_{x}")
        sel.append(f"count_if(NOT f{p}) = 0 AS f{p}")
    return (f"{name} AS (SELECT {', '.join(sel)} FROM {rel} "
            f"GROUP BY obs_id, {tbin}, ant1, ant2, {fbin})")


def flag_cte(name: str, src: str, cond: str, mode: str = "set") -> str:
    """CTE ``name`` = ``src`` with per-pol flags set (or cleared) where ``cond``."""
    c = f"coalesce(({cond}), false)"
    cols = [f"(f{p} OR {c}) AS f{p}" if mode == "set" else f"(f{p} AND NOT {c}) AS f{p}" for p in POLS]
    return f"{name} AS (SELECT * EXCLUDE (fxx, fxy, fyx, fyy), {', '.join(cols)} FROM {src})"


def amp_sql(p: str) -> str:
    return f"sqrt({p}_re*{p}_re + {p}_im*{p}_im)"


# ---------------------------------------------------------------- complex SQL

def c_mul(a, b):
    (ar, ai), (br, bi) = a, b
    return (f"(({ar})*({br}) - ({ai})*({bi}))", f"(({ar})*({bi}) + ({ai})*({br}))")


def c_conj(a):
    return (a[0], f"(-({a[1]}))")


def c_neg(a):
    return (f"(-({a[0]}))", f"(-({a[1]}))")


def c_sub(a, b):
    return (f"(({a[0]}) - ({b[0]}))", f"(({a[1]}) - ({b[1]}))")


def c_add(a, b):
    return (f"(({a[0]}) + ({b[0]}))", f"(({a[1]}) + ({b[1]}))")


def c_div(a, b):
    (ar, ai), (br, bi) = a, b
    d = f"(({br})*({br}) + ({bi})*({bi}))"
    return (f"((({ar})*({br}) + ({ai})*({bi}))/{d})", f"((({ai})*({br}) - ({ar})*({bi}))/{d})")


def col_c(prefix: str, p: str):
    return (f"{prefix}{p}_re", f"{prefix}{p}_im")


def c_cols(prefix: str, vals: dict) -> str:
    return ", ".join(f"{vals[p][0]} AS {prefix}{p}_re, {vals[p][1]} AS {prefix}{p}_im" for p in POLS)


def applycal_sql(kind: str, src: str = "vis4", sol: str = "sol", out: str = "ac",
                 time_axis: bool = True, freq_axis: bool = False) -> list[str]:
    """CTEs applying fixture solutions ``sol`` to ``src`` like ``applycal`` (nearest lookup)."""
    ctes = [f"gc AS (SELECT time, freq, ant, pol, "
            f"coalesce(max(CASE WHEN soltype='amplitude' THEN val END), 1e0) AS amp, "
            f"coalesce(max(CASE WHEN soltype='phase' THEN val END), 0e0) AS ph, "
            f"max(CASE WHEN soltype='tec' THEN val END) AS tec FROM {sol} GROUP BY time, freq, ant, pol)"]
    pol_name = {"xx": "XX", "xy": "XY", "yx": "YX", "yy": "YY"}
    piv = []
    for p in POLS:
        if kind == "scalar":
            cond = "true"
        elif kind == "diagonal" and p in ("xy", "yx"):
            piv += [f"CAST(NULL AS DOUBLE) AS {p}_amp", f"CAST(NULL AS DOUBLE) AS {p}_ph", f"CAST(NULL AS DOUBLE) AS {p}_tec"]
            continue
        else:
            cond = f"pol = '{pol_name[p]}'"
        piv += [f"max(CASE WHEN {cond} THEN amp END) AS {p}_amp", f"max(CASE WHEN {cond} THEN ph END) AS {p}_ph",
                f"max(CASE WHEN {cond} THEN tec END) AS {p}_tec"]
    ctes.append(f"gp AS (SELECT time, freq, ant, {', '.join(piv)} FROM gc GROUP BY time, freq, ant)")
    joins, lookup_cols = [], []
    if time_axis:
        ctes.append(f"nt AS (SELECT vt.time, arg_min(st.time, abs(st.time - vt.time)) AS st FROM "
                    f"(SELECT DISTINCT time FROM {src}) vt, (SELECT DISTINCT time FROM {sol}) st GROUP BY vt.time)")
        joins.append("JOIN nt USING (time)")
        lookup_cols.append("nt.st")
    if freq_axis:
        ctes.append(f"nf AS (SELECT vf.freq, arg_min(sf.freq, abs(sf.freq - vf.freq)) AS sf FROM "
                    f"(SELECT DISTINCT freq FROM {src}) vf, (SELECT DISTINCT freq FROM {sol}) sf GROUP BY vf.freq)")
        joins.append("JOIN nf USING (freq)")
        lookup_cols.append("nf.sf")
    ctes.append(f"va AS (SELECT v.*{''.join(', ' + c for c in lookup_cols)} FROM {src} v {' '.join(joins)})")

    def gjoin(alias, antcol):
        on = [f"{alias}.ant = 'ant' || CAST(va.{antcol} AS VARCHAR)"]
        if time_axis:
            on.append(f"{alias}.time = va.st")
        if freq_axis:
            on.append(f"{alias}.freq = va.sf")
        return f"LEFT JOIN gp {alias} ON {' AND '.join(on)}"

    def gain(alias, p):
        ph = f"({alias}.{p}_ph + coalesce(-8.4479745e9*{alias}.{p}_tec/va.freq, 0e0))"
        return (f"({alias}.{p}_amp*cos({ph}))", f"({alias}.{p}_amp*sin({ph}))")

    gcols = []
    for alias, tag in (("g1", "a_"), ("g2", "b_")):
        for p in POLS:
            if kind != "fulljones" and p in ("xy", "yx"):
                gcols.append(f"0e0 AS {tag}{p}_re, 0e0 AS {tag}{p}_im")
            else:
                re, im = gain(alias, p)
                gcols.append(f"{re} AS {tag}{p}_re, {im} AS {tag}{p}_im")
    ok = "(g1.xx_amp IS NOT NULL AND g2.xx_amp IS NOT NULL)"
    ctes.append(f"vg AS (SELECT va.*, {', '.join(gcols)}, {ok} AS gok FROM va {gjoin('g1', 'ant1')} {gjoin('g2', 'ant2')})")
    V = {p: col_c("", p) for p in POLS}
    if kind != "fulljones":
        g1 = {"x": col_c("a_", "xx"), "y": col_c("a_", "yy")}
        g2 = {"x": col_c("b_", "xx"), "y": col_c("b_", "yy")}
        res = {p: c_div(V[p], c_mul(g1[p[0]], c_conj(g2[p[1]]))) for p in POLS}
        ctes.append(f"r AS (SELECT *, {c_cols('n_', res)} FROM vg)")
    else:
        def inv(tag):
            a = {p: col_c(tag, p) for p in POLS}
            det = c_sub(c_mul(a["xx"], a["yy"]), c_mul(a["xy"], a["yx"]))
            return {"xx": c_div(a["yy"], det), "xy": c_div(c_neg(a["xy"]), det),
                    "yx": c_div(c_neg(a["yx"]), det), "yy": c_div(a["xx"], det)}
        ctes.append(f"i AS (SELECT *, {c_cols('i1_', inv('a_'))}, {c_cols('i2_', inv('b_'))} FROM vg)")
        i1 = {p: col_c("i1_", p) for p in POLS}
        i2 = {p: col_c("i2_", p) for p in POLS}
        h = {"xx": c_conj(i2["xx"]), "xy": c_conj(i2["yx"]), "yx": c_conj(i2["xy"]), "yy": c_conj(i2["yy"])}

        def mm(a, b):
            return {"xx": c_add(c_mul(a["xx"], b["xx"]), c_mul(a["xy"], b["yx"])),
                    "xy": c_add(c_mul(a["xx"], b["xy"]), c_mul(a["xy"], b["yy"])),
                    "yx": c_add(c_mul(a["yx"], b["xx"]), c_mul(a["yy"], b["yx"])),
                    "yy": c_add(c_mul(a["yx"], b["xy"]), c_mul(a["yy"], b["yy"]))}
        ctes.append(f"m AS (SELECT *, {c_cols('m_', mm(i1, V))}, {c_cols('h_', h)} FROM i)")
        m = {p: col_c("m_", p) for p in POLS}
        hh = {p: col_c("h_", p) for p in POLS}
        ctes.append(f"r AS (SELECT *, {c_cols('n_', mm(m, hh))} FROM m)")
    fin = " AND ".join(f"isfinite(n_{p}_{x})" for p in POLS for x in ("re", "im"))
    sel = ["obs_id", "slot", "time", "ant1", "ant2", "chan", "freq", "u", "v", "w", "weight"]
    good = f"coalesce(gok AND {fin}, false)"
    sel += [f"CASE WHEN {good} THEN n_{p}_{x} ELSE {p}_{x} END AS {p}_{x}" for p in POLS for x in ("re", "im")]
    sel += [f"(f{p} OR NOT {good}) AS f{p}" for p in POLS]
    ctes.append(f"{out} AS (SELECT {', '.join(sel)} FROM r)")
    return ctes


# ---------------------------------------------------------- dynamic flagging

TIME_PART = "PARTITION BY obs_id, ant1, ant2, chan ORDER BY slot"
FREQ_PART = "PARTITION BY obs_id, ant1, ant2, slot ORDER BY chan"


def dyn_prepare(src: str = "vis4", name: str = "d0") -> str:
    pw = " + ".join(f"({p}_re*{p}_re + {p}_im*{p}_im)" for p in POLS)
    return (f"{name} AS (SELECT * REPLACE (coalesce(fl OR NOT (amp - amp = 0e0), true) AS fl) FROM "
            f"(SELECT *, sqrt(({pw})/4e0) AS amp, (fxx OR fxy OR fyx OR fyy) AS fl FROM {src}))")


def dyn_residual(src: str, name: str, half_width: int = 3) -> str:
    import math
    g = [math.exp(-2.0 * j * j / (half_width * half_width)) for j in range(half_width + 1)]

    def smooth(c: str, part: str) -> str:
        near = " + ".join(f"{g[j]!r}*(lag({c}, {j}, 0e0) OVER ({part}) + lead({c}, {j}, 0e0) OVER ({part}))" for j in range(1, half_width + 1))
        return f"{g[0]!r}*{c} + {near}"

    return (f"{name}a AS (SELECT *, CASE WHEN fl THEN 0e0 ELSE amp END AS bv, CASE WHEN fl THEN 0e0 ELSE 1e0 END AS bw FROM {src}), "
            f"{name}b AS (SELECT * REPLACE ({smooth('bv', TIME_PART)} AS bv, {smooth('bw', TIME_PART)} AS bw) FROM {name}a), "
            f"{name}c AS (SELECT * REPLACE ({smooth('bv', FREQ_PART)} AS bv, {smooth('bw', FREQ_PART)} AS bw) FROM {name}b), "
            f"{name} AS (SELECT * EXCLUDE (bv, bw), CASE WHEN bw > 0e0 AND amp - amp = 0e0 THEN amp - bv/bw ELSE 0e0 END AS resid FROM {name}c)")


def dyn_noise(src: str, name: str) -> str:
    return (f"{name}m AS (SELECT obs_id, ant1, ant2, median(resid) AS centre FROM {src} WHERE NOT fl GROUP BY ALL), "
            f"{name}s AS (SELECT obs_id, ant1, ant2, m.centre, 1.4826e0*median(abs(d.resid - m.centre)) AS noise "
            f"FROM {src} d JOIN {name}m m USING (obs_id, ant1, ant2) WHERE NOT fl GROUP BY ALL), "
            f"{name} AS (SELECT d.*, s.centre, s.noise FROM {src} d LEFT JOIN {name}s s USING (obs_id, ant1, ant2))")


def dyn_sumthreshold(src: str, prefix: str, direction: str, sensitivity: float = 6.0,
                     sizes=(1, 2, 4, 8, 16, 32, 64)) -> tuple[list[str], str]:
    """Frames of M rows as such: the sum of each window, then the largest of the windows that hold a sample."""
    part = TIME_PART if direction == "time" else FREQ_PART
    ctes, prev = [], src
    for m in sizes:
        k = m.bit_length() - 1
        chi = f"(({dbl(sensitivity)}*noise)/{dbl(1.5 ** k)})"
        x = f"CASE WHEN NOT fl AND noise > 0e0 THEN resid - centre - {chi} ELSE 0e0 END"
        fwd = f"({part} ROWS BETWEEN CURRENT ROW AND {m - 1} FOLLOWING)"
        a, b = f"{prefix}{m}a", f"{prefix}{m}b"
        ctes.append(f"{a} AS (SELECT *, coalesce(count(*) OVER {fwd} = {m} AND sum({x}) OVER {fwd} > 1e-6*{chi}, false) "
                    f"AS hit FROM {prev})")
        ctes.append(f"{b} AS (SELECT * EXCLUDE (fl, hit), fl OR bool_or(hit) OVER ({part} ROWS BETWEEN {m - 1} PRECEDING "
                    f"AND CURRENT ROW) AS fl FROM {a})")
        prev = b
    return ctes, prev


def dyn_rounds(src: str, rounds: int = 2, sensitivity: float = 6.0) -> tuple[list[str], str]:
    ctes, last = [], src
    for r in range(rounds):
        ctes.append(dyn_residual(last, f"r{r}"))
        last = f"r{r}"
        if r == 0:
            ctes.append(dyn_noise(last, "noisy"))
            last = "noisy"
        for d in ("time", "freq"):
            more, last = dyn_sumthreshold(last, f"s{r}{d[0]}", d, sensitivity * 3.0 ** (rounds - 1 - r))
            ctes += more
        if r < rounds - 1:
            ctes.append(f"n{r} AS (SELECT * EXCLUDE (resid) FROM {last})")
            last = f"n{r}"
    return ctes, last


def dyn_sir(src: str, prefix: str, direction: str, eta: float = 0.2) -> tuple[list[str], str]:
    part = TIME_PART if direction == "time" else FREQ_PART
    a, b = f"{prefix}a", f"{prefix}b"
    return [f"{a} AS (SELECT *, sum(CASE WHEN fl THEN {dbl(eta)} ELSE {dbl(eta - 1.0)} END) OVER ({part} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM {src})",
            f"{b} AS (SELECT * EXCLUDE (fl, p), fl OR round(max(p) OVER ({part} ROWS BETWEEN CURRENT ROW AND UNBOUNDED "
            f"FOLLOWING) - least(0e0, coalesce(min(p) OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
            f"0e0)), 9) >= 0 AS fl FROM {a})"], b


def dyn_merge(src: str, name: str) -> str:
    return (f"{name} AS (SELECT * EXCLUDE (fxx, fxy, fyx, fyy, amp, fl, resid, centre, noise), fxx OR fl AS fxx, "
            f"fxy OR fl AS fxy, fyx OR fl AS fyx, fyy OR fl AS fyy FROM {src})")


# ------------------------------------------------------------------- sky SQL

TWO_PI = "6.283185307179586e0"
C_LIGHT = "299792458e0"


def comp_phase_sql(l_: float, m_: float, sign: str = "-") -> str:
    import math
    n_ = math.sqrt(1.0 - l_ * l_ - m_ * m_)
    return (f"{sign}((({TWO_PI}*freq)/{C_LIGHT}) * (u*{dbl(l_)} + v*{dbl(m_)} + w*({dbl(n_)} - 1e0)))")


def comp_term_sql(l_: float, m_: float, flux: float) -> tuple[str, str]:
    ph = comp_phase_sql(l_, m_)
    return (f"({dbl(flux)}*cos({ph}))", f"({dbl(flux)}*sin({ph}))")


def jones_cols(prefix: str):
    return {p: col_c(prefix, p) for p in POLS}


def j_mul(a, b):
    return {"xx": c_add(c_mul(a["xx"], b["xx"]), c_mul(a["xy"], b["yx"])),
            "xy": c_add(c_mul(a["xx"], b["xy"]), c_mul(a["xy"], b["yy"])),
            "yx": c_add(c_mul(a["yx"], b["xx"]), c_mul(a["yy"], b["yx"])),
            "yy": c_add(c_mul(a["yx"], b["xy"]), c_mul(a["yy"], b["yy"]))}


def j_herm(a):
    return {"xx": c_conj(a["xx"]), "xy": c_conj(a["yx"]), "yx": c_conj(a["xy"]), "yy": c_conj(a["yy"])}


def j_inv_with_det(a, det):
    return {"xx": c_div(a["yy"], det), "xy": c_div(c_neg(a["xy"]), det),
            "yx": c_div(c_neg(a["yx"]), det), "yy": c_div(a["xx"], det)}


def j_det(a):
    return c_sub(c_mul(a["xx"], a["yy"]), c_mul(a["xy"], a["yx"]))
