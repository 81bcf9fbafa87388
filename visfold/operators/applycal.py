"""Apply calibration solutions to visibilities (scalar, diagonal, full Jones, single).

Plan: soltabs with the same axes are fused into one complex gain per cell; soltabs
with axes of their own (amplitude and phase on different time grids) keep them and
their gains are multiplied after the lookup. Each such group is pivoted into
one Jones struct per (time, freq, antenna) and joined to the visibilities twice
(ant1, ant2) after the nearest/linear axis lookup. Joins against the visibilities
are with small, size-checked tables, so the visibilities are streamed once with no
shuffle; the correction itself is closed-form column algebra V' = J1^-1 V J2^-H inside
whole-stage codegen. Every visibility comes out exactly once.

Missing solution, zero solution weight or a non-finite result: the sample is
flagged on all polarisations and its data is left unchanged (decision).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import cplx as C
from ..plans.joins import per_observation
from .lookup import between, lookup_axis, phase_between, solution_axis

POLS = C.POLS
# Fixed value: TEC phase coefficient, phase = TEC_COEFF * tec / freq (radians, Hz, TECU).
TEC_COEFF = -8.4479745e9
_POL_OF = {"XX": "xx", "XY": "xy", "YX": "yx", "YY": "yy"}


#: Solution cells up to which the gain tables are broadcast; beyond, the joins shuffle.
BROADCAST_CELLS = 2_000_000
_FORMS = {(): "scalar", S.VALID_POL_TUPLES[0]: "diagonal", S.VALID_POL_TUPLES[1]: "fulljones"}


def solution_layout(sol: DataFrame, direction: str | None = None) -> dict:
    """How a solution set is applied, from one aggregation with a row per soltab.

    ``kind`` follows ``solset_correction``: ``fulljones`` (amplitude and phase with four
    polarisations), else ``diagonal`` or ``scalar``. ``groups``: soltabs with the same axes, to be
    fused, each with the (first, last, n) of its time and frequency axes. Raises for sets
    that can't be applied: more than one solset, other soltabs than one, or amplitude and phase,
    polarisations that differ or are incomplete, several directions without a choice of one.
    """
    def axis_aggs(a: str):
        on = F.array_contains("axes", a)
        value = F.when(on, F.col(a))
        return [F.min(value).alias(f"{a}_first"), F.max(value).alias(f"{a}_last"), F.count_distinct(value).alias(f"{a}_n"),
                F.sum_distinct(F.pmod(F.xxhash64(value), F.lit(1 << 40))).alias(f"{a}_sum")]
    tabs = (sol.groupBy("solset", "soltab").agg(
        F.min("soltype").alias("soltype"), F.first("axes").alias("axes"), F.array_sort(F.collect_set("pol")).alias("pols"),
        F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_set("dir")).alias("dirs"), *axis_aggs("time"), *axis_aggs("freq"))
        .orderBy("soltype", "solset", "soltab").limit(50).collect())
    types = [t["soltype"] for t in tabs]
    if len({t["solset"] for t in tabs}) != 1:
        raise ValueError(f"expected one solution set, found {sorted({str(t['solset']) for t in tabs})}")
    if len(tabs) != 1 and types != ["amplitude", "phase"]:
        raise ValueError(f"a solution set holds one soltab, or amplitude and phase; found {types}")
    if len({tuple(t["pols"]) for t in tabs}) != 1:
        raise ValueError(f"soltabs differ in polarisations: {[t['pols'] for t in tabs]}")
    pols = next((p for p in _FORMS if sorted(p) == list(tabs[0]["pols"])), None)
    if pols is None:
        raise ValueError(f"unknown polarisations {tabs[0]['pols']}")
    kind = _FORMS[pols]
    if kind == "fulljones" and len(tabs) == 1:
        raise ValueError("four polarisations need amplitude and phase together")
    for t in tabs:
        if direction is None and len(t["dirs"]) > 1:
            raise ValueError(f"soltab {t['soltab']} has directions {t['dirs']}; choose one")
        if direction is not None and t["dirs"] and direction not in t["dirs"]:
            raise ValueError(f"soltab {t['soltab']} has no direction {direction!r}, only {t['dirs']}")
    groups: dict[tuple, dict] = {}
    for t in tabs:
        axes = [a for a in ("time", "freq") if a in t["axes"]]
        grid = tuple((a, *(t[f"{a}_{x}"] for x in ("first", "last", "n", "sum"))) for a in axes)
        g = groups.setdefault(grid, {"soltabs": [], "axes": axes, "stats": {a: (t[f"{a}_first"], t[f"{a}_last"], int(t[f"{a}_n"])) for a in axes}})
        g["soltabs"].append(t["soltab"])
    return {"kind": kind, "types": types, "pols": list(pols), "groups": list(groups.values()), "direction": direction,
            "rows": sum(int(t["rows"]) for t in tabs), "axes": sorted({a for t in tabs for a in t["axes"]})}


def gain_cells(sol: DataFrame) -> DataFrame:
    """One row per (time, freq, ant, pol) with fused amplitude, phase, tec and weight.

    A missing amplitude counts as 1, a missing phase as 0 (soltabs that are applied alone). One
    direction at most is left when this is called.
    """
    keys = ["time", "freq", "ant", "pol"]
    g = sol.groupBy(*keys).agg(
        F.max(F.when(F.col("soltype") == "amplitude", F.col("val"))).alias("amp"),
        F.max(F.when(F.col("soltype") == "phase", F.col("val"))).alias("phase"),
        F.max(F.when(F.col("soltype") == "tec", F.col("val"))).alias("tec"),
        F.min("weight").alias("w"),
    )
    return g.select(*keys, F.coalesce("amp", F.lit(1.0)).alias("amp"), F.coalesce("phase", F.lit(0.0)).alias("phase"),
                    "tec", (F.col("w") > 0).alias("ok"))


def jones_table(sol: DataFrame, layout: dict) -> DataFrame:
    """Pivot pol into one struct per (time, freq, ant): per pol (amp, phase, tec)."""
    g = gain_cells(sol)
    cell = F.struct("amp", "phase", "tec")
    keys = ["time", "freq", "ant"]
    if layout["kind"] == "scalar":
        return g.select(*keys, *[cell.alias(p) for p in POLS], "ok")
    aggs = []
    for name, p in _POL_OF.items():
        aggs.append(F.first(F.when(F.col("pol") == name, cell), ignorenulls=True).alias(p))
    aggs.append(F.bool_and("ok").alias("ok"))
    aggs.append(F.count(F.lit(1)).alias("_n"))
    j = g.groupBy(*keys).agg(*aggs)
    need = 4 if layout["kind"] == "fulljones" else 2
    return j.withColumn("ok", F.col("ok") & (F.col("_n") == need)).drop("_n")


def _gain(cell: Column, freq: Column) -> Column:
    ph = cell.getField("phase") + F.coalesce(F.lit(TEC_COEFF) * cell.getField("tec") / freq, F.lit(0.0))
    return C.c_from_polar(cell.getField("amp"), ph)


def polar_between(lo: Column, hi: Column, frac: Column) -> Column:
    """The cell (amp, phase, tec) at a fraction of the way between two neighbours of a solution axis."""
    parts = {x: (lo.getField(x), hi.getField(x)) for x in ("amp", "phase", "tec")}
    return F.struct(between(*parts["amp"], frac).alias("amp"), phase_between(*parts["phase"], frac).alias("phase"),
                    between(*parts["tec"], frac).alias("tec"))


def _jones_at(prefix: str, kind: str, freq: Column) -> Column:
    g = {p: _gain(F.col(f"{prefix}{p}"), freq) for p in POLS}
    if kind == "fulljones":
        return C.jones(g["xx"], g["xy"], g["yx"], g["yy"])
    return C.jones_diag(g["xx"], g["yy"])


def correct(df: DataFrame, data: str, j1: Column, j2: Column, kind: str, out: str) -> DataFrame:
    """Add flat columns ``out``_<pol>_re/im = J1^-1 V J2^-H (diagonal and scalar: element-wise form).

    Every intermediate used more than once is staged as flat columns, so it
    is evaluated once per row; the stages are SQL expression text
    (``cplx.s_*``), one ``selectExpr`` each. The result comes out of ``inline`` over an
    array of one struct: a later filter on it (unflagged data, say) is not pushed below, where
    it would repeat the whole algebra at every use.
    """
    df, _ = C.stage_jones(df, "_j1", j1)
    df, _ = C.stage_jones(df, "_j2", j2)
    a, b = C.s_jones("_j1"), C.s_jones("_j2")
    tmp = C.staged_columns("_j1", True) + C.staged_columns("_j2", True)
    v = {p: (f"`{data}`.{p}.re", f"`{data}`.{p}.im") for p in POLS}
    if kind == "fulljones":
        df = df.selectExpr("*", *C.s_exprs("_d1", C.s_jones_det(a)), *C.s_exprs("_d2", C.s_jones_det(b)))
        df = df.selectExpr("*", *C.s_exprs("_i1", C.s_jones_inv(a, C.s_col("_d1")), True),
                           *C.s_exprs("_i2", C.s_jones_inv(b, C.s_col("_d2")), True))
        df = df.selectExpr("*", *C.s_exprs("_m", C.s_jones_mul(C.s_jones("_i1"), v), True),
                           *C.s_exprs("_h", C.s_jones_herm(C.s_jones("_i2")), True))
        res = C.s_jones_mul(C.s_jones("_m"), C.s_jones("_h"))
        tmp += C.staged_columns("_d1") + C.staged_columns("_d2") + C.staged_columns("_i1", True)
        tmp += C.staged_columns("_i2", True) + C.staged_columns("_m", True) + C.staged_columns("_h", True)
    else:
        g1 = {"x": C.s_col("_j1", "xx"), "y": C.s_col("_j1", "yy")}
        g2 = {"x": C.s_col("_j2", "xx"), "y": C.s_col("_j2", "yy")}
        df = df.selectExpr("*", *[e for p in POLS for e in C.s_exprs(f"_b{p}", C.s_mul(g1[p[0]], C.s_conj(g2[p[1]])))])
        res = {p: C.s_div(v[p], C.s_col(f"_b{p}")) for p in POLS}
        tmp += [c for p in POLS for c in C.staged_columns(f"_b{p}")]
    df = df.selectExpr("*", f"inline(array(struct({', '.join(C.s_exprs(out, res, True))})))")
    return df.drop(*tmp)


def applycal(vis: DataFrame, sol: DataFrame, antenna: DataFrame, mode: str = "nearest",
             layout: dict | None = None, direction: str | None = None) -> DataFrame:
    """Apply one solution set in the form that ``solution_layout`` finds; one row out per row in.

    Linear mode interpolates amplitude, phase (by the shorter way round) and TEC apart in time, so a gain
    whose amplitude stays keeps it between two phases.
    """
    layout = layout or solution_layout(sol, direction)
    kind = layout["kind"]
    if layout["direction"] is not None:
        sol = sol.filter(F.col("dir").isNull() | (F.col("dir") == F.lit(layout["direction"])))
    hint = F.broadcast if layout["rows"] <= BROADCAST_CELLS else (lambda df: df)
    names = per_observation(antenna.select("obs_id", "ant", "name"))
    v = (vis.join(names.select("obs_id", F.col("ant").alias("ant1"), F.col("name").alias("_n1")), ["obs_id", "ant1"], "left")
         .join(names.select("obs_id", F.col("ant").alias("ant2"), F.col("name").alias("_n2")), ["obs_id", "ant2"], "left"))
    gains, ok = {"a": [], "b": []}, F.lit(True)
    for k, group in enumerate(layout["groups"]):
        cells = sol.filter(F.col("soltab").isin(group["soltabs"]))
        table = hint(jones_table(cells, layout))
        has_t, has_f = "time" in group["axes"], "freq" in group["axes"]
        small = layout["rows"] <= BROADCAST_CELLS
        if has_f:
            v = lookup_axis(v, "freq", solution_axis(cells, "freq"), f"_sf{k}", stats=group["stats"]["freq"], bounded=small)
        if has_t:
            v = lookup_axis(v, "time", solution_axis(cells, "time"), f"_st{k}", mode=mode, stats=group["stats"]["time"], bounded=small)
        times = [f"_st{k}"] if has_t and mode == "nearest" else [f"_st{k}_lo", f"_st{k}_hi"] if has_t else [None]
        for side, name in (("a", "_n1"), ("b", "_n2")):
            found = []
            for i, t in enumerate(times):
                tag = f"{side}{k}{i}_"
                keys = [F.col("ant").alias(name)] + ([F.col("freq").alias(f"_sf{k}")] if has_f else []) + ([F.col("time").alias(t)] if t else [])
                on = [name] + ([f"_sf{k}"] if has_f else []) + ([t] if t else [])
                v = v.join(table.select(*keys, *[F.col(p).alias(f"{tag}{p}") for p in POLS], F.col("ok").alias(f"{tag}ok")), on, "left")
                ok = ok & F.coalesce(F.col(f"{tag}ok"), F.lit(False))
                found.append({p: F.col(f"{tag}{p}") for p in POLS})
            if len(found) == 2:
                frac = F.coalesce(F.col(f"_st{k}_frac"), F.lit(0.0))
                found = [{p: polar_between(found[0][p], found[1][p], frac) for p in POLS}]
            gains[side].append({p: _gain(found[0][p], F.col("freq")) for p in POLS})

    def jones(parts: list[dict]) -> Column:
        g = {p: parts[0][p] for p in POLS}
        for more in parts[1:]:
            g = {p: C.c_mul(g[p], more[p]) for p in POLS}
        return C.jones(*(g[p] for p in POLS)) if kind == "fulljones" else C.jones_diag(g["xx"], g["yy"])

    v = v.withColumn("_ok", ok)
    v = correct(v, "data", jones(gains["a"]), jones(gains["b"]), kind, "_new")
    good = F.col("_ok")
    for p in POLS:
        for x in ("re", "im"):
            c = F.col(f"_new_{p}_{x}")
            good = good & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    new = {p: C.cpx(F.col(f"_new_{p}_re"), F.col(f"_new_{p}_im")) for p in POLS}
    v = v.withColumn("_good", good)
    data = F.struct(*[F.when(F.col("_good"), new[p]).otherwise(F.col("data").getField(p)).alias(p) for p in POLS])
    flag = F.struct(*[(F.col("flag").getField(p) | ~F.col("_good")).alias(p) for p in POLS])
    return v.withColumn("data", data).withColumn("flag", flag).select(vis.columns)


def antenna_coverage(antenna: DataFrame, sol: DataFrame) -> DataFrame:
    """Antennas present in the data with no solution cell (non-empty -> cannot apply)."""
    have = sol.select(F.col("ant").alias("name")).filter(F.col("name").isNotNull()).distinct()
    return antenna.join(have, "name", "left_anti").select("obs_id", "ant", "name")


def complex_to_polar(c: Column) -> Column:
    return F.struct(C.c_abs(c).alias("amplitude"), C.c_arg(c).alias("phase"))


def polar_to_complex(amp: Column, phase: Column) -> Column:
    return C.c_from_polar(amp, phase)


def split_complex_gains(gains: DataFrame, solset: str = "sol000") -> DataFrame:
    """Complex gain cells (axes, pos, coords, g struct<re,im>, weight) -> one amplitude
    and one phase soltab with the same axes and copied weights."""
    parts = F.array(
        F.struct(F.lit("amplitude").alias("soltype"), C.c_abs("g").alias("val")),
        F.struct(F.lit("phase").alias("soltype"), C.c_arg("g").alias("val")),
    )
    e = gains.select("*", F.explode(parts).alias("_p"))
    return e.select(
        F.lit(solset).alias("solset"), F.concat(F.col("_p.soltype"), F.lit("000")).alias("soltab"),
        F.col("_p.soltype").alias("soltype"), "axes", "pos",
        *[F.col(c).cast(t).alias(c) if c in gains.columns else F.lit(None).cast(t).alias(c)
          for c, t in (("time", "double"), ("freq", "double"), ("ant", "string"), ("pol", "string"), ("dir", "string"))],
        F.col("_p.val").alias("val"), F.col("weight").cast("float").alias("weight"))
