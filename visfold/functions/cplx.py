"""Complex and 2x2 Jones algebra as Spark column expressions.

Spark has no complex type, so a complex number is ``struct<re:double, im:double>``
and a Jones matrix / polarisation vector is ``struct<xx:C, xy:C, yx:C, yy:C>``.
Every function returns a plain Column, so the whole chain stays inside
whole-stage codegen: no UDF, no Python in the hot path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POLS = ("xx", "xy", "yx", "yy")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cpx(re, im) -> Column:
    """Build a complex value from real and imaginary parts."""
    re = F.lit(float(re)) if isinstance(re, (int, float)) else _c(re)
    im = F.lit(float(im)) if isinstance(im, (int, float)) else _c(im)
    return F.struct(re.cast("double").alias("re"), im.cast("double").alias("im"))


def re_(c) -> Column:
    return _c(c).getField("re")


def im_(c) -> Column:
    return _c(c).getField("im")


def c_zero() -> Column:
    return cpx(0.0, 0.0)


def c_one() -> Column:
    return cpx(1.0, 0.0)


def c_add(a, b) -> Column:
    return cpx(re_(a) + re_(b), im_(a) + im_(b))


def c_sub(a, b) -> Column:
    return cpx(re_(a) - re_(b), im_(a) - im_(b))


def c_mul(a, b) -> Column:
    ar, ai, br, bi = re_(a), im_(a), re_(b), im_(b)
    return cpx(ar * br - ai * bi, ar * bi + ai * br)


def c_scale(a, s) -> Column:
    s = F.lit(float(s)) if isinstance(s, (int, float)) else _c(s)
    return cpx(re_(a) * s, im_(a) * s)


def c_conj(a) -> Column:
    return cpx(re_(a), -im_(a))


def c_neg(a) -> Column:
    return cpx(-re_(a), -im_(a))


def c_abs2(a) -> Column:
    return re_(a) * re_(a) + im_(a) * im_(a)


def c_abs(a) -> Column:
    return F.hypot(re_(a), im_(a))


def c_arg(a) -> Column:
    return F.atan2(im_(a), re_(a))


def c_div(a, b) -> Column:
    """a / b; a zero divisor gives null parts (ANSI-safe ``try_divide``)."""
    d = c_abs2(b)
    ar, ai, br, bi = re_(a), im_(a), re_(b), im_(b)
    return cpx(F.try_divide(ar * br + ai * bi, d), F.try_divide(ai * br - ar * bi, d))


def c_from_polar(amp, phase) -> Column:
    amp, phase = _c(amp), _c(phase)
    return cpx(amp * F.cos(phase), amp * F.sin(phase))


def c_expi(phase) -> Column:
    """exp(i * phase)."""
    phase = _c(phase)
    return cpx(F.cos(phase), F.sin(phase))


def c_is_finite(a) -> Column:
    """True when both parts are finite numbers (not null, NaN or infinite)."""
    def fin(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return fin(re_(a)) & fin(im_(a))


# ---------------------------------------------------------------- Jones 2x2

def jones(xx, xy, yx, yy) -> Column:
    return F.struct(_c(xx).alias("xx"), _c(xy).alias("xy"), _c(yx).alias("yx"), _c(yy).alias("yy"))


def j_get(j, p: str) -> Column:
    return _c(j).getField(p)


def jones_diag(gx, gy) -> Column:
    return jones(gx, c_zero(), c_zero(), gy)


def jones_scalar(g) -> Column:
    return jones(g, c_zero(), c_zero(), g)


def jones_mul(a, b) -> Column:
    """Matrix product a @ b."""
    a_ = {p: j_get(a, p) for p in POLS}
    b_ = {p: j_get(b, p) for p in POLS}
    return jones(
        c_add(c_mul(a_["xx"], b_["xx"]), c_mul(a_["xy"], b_["yx"])),
        c_add(c_mul(a_["xx"], b_["xy"]), c_mul(a_["xy"], b_["yy"])),
        c_add(c_mul(a_["yx"], b_["xx"]), c_mul(a_["yy"], b_["yx"])),
        c_add(c_mul(a_["yx"], b_["xy"]), c_mul(a_["yy"], b_["yy"])),
    )


def jones_herm(a) -> Column:
    """Conjugate transpose."""
    return jones(
        c_conj(j_get(a, "xx")), c_conj(j_get(a, "yx")),
        c_conj(j_get(a, "xy")), c_conj(j_get(a, "yy")),
    )


def jones_det(a) -> Column:
    return c_sub(c_mul(j_get(a, "xx"), j_get(a, "yy")), c_mul(j_get(a, "xy"), j_get(a, "yx")))


def jones_inv(a, det=None) -> Column:
    """Closed-form inverse; a singular matrix yields null parts.

    Pass ``det`` (a column holding ``jones_det(a)``) to avoid re-deriving it.
    """
    det = jones_det(a) if det is None else _c(det)
    return jones(
        c_div(j_get(a, "yy"), det),
        c_div(c_neg(j_get(a, "xy")), det),
        c_div(c_neg(j_get(a, "yx")), det),
        c_div(j_get(a, "xx"), det),
    )


def jones_is_finite(a) -> Column:
    out = None
    for p in POLS:
        t = c_is_finite(j_get(a, p))
        out = t if out is None else out & t
    return out


def jones_sub(a, b) -> Column:
    return jones(*[c_sub(j_get(a, p), j_get(b, p)) for p in POLS])


def jones_add(a, b) -> Column:
    return jones(*[c_add(j_get(a, p), j_get(b, p)) for p in POLS])


def jones_scale(a, g) -> Column:
    """Multiply every element by complex g."""
    return jones(*[c_mul(j_get(a, p), g) for p in POLS])


# ------------------------------------------------------------------ staging
# Catalyst inlines a struct-building projection into each field access that
# follows it (so ``s.re`` of ``struct(expensive, ..)`` becomes ``expensive``),
# which repeats every shared sub-expression of a nested complex formula.
# Intermediates that are used more than once are therefore materialised as
# flat double columns; a projection of a non-trivial double used several
# times is kept, and evaluated once per row.

def stage(df, name: str, c):
    """Add ``name_re``/``name_im`` holding complex ``c``; return (df, column view of them)."""
    c = _c(c)
    df = df.select("*", re_(c).alias(f"{name}_re"), im_(c).alias(f"{name}_im"))
    return df, cpx(F.col(f"{name}_re"), F.col(f"{name}_im"))


def stage_jones(df, name: str, j):
    """Materialise the four elements of Jones matrix ``j`` (one projection); return (df, matrix view)."""
    j = _c(j)
    cols = []
    for p in POLS:
        cols += [re_(j.getField(p)).alias(f"{name}_{p}_re"), im_(j.getField(p)).alias(f"{name}_{p}_im")]
    df = df.select("*", *cols)
    return df, jones(*[cpx(F.col(f"{name}_{p}_re"), F.col(f"{name}_{p}_im")) for p in POLS])


def staged_columns(name: str, matrix: bool = False) -> list[str]:
    if matrix:
        return [f"{name}_{p}_{x}" for p in POLS for x in ("re", "im")]
    return [f"{name}_re", f"{name}_im"]


# --------------------------------------------------------- SQL-text algebra
# The same algebra as SQL expression text over flat (re, im) columns: a
# stage of many long expressions is then one ``selectExpr`` (one parse in the
# JVM) instead of thousands of Column-building calls from Python.

def s_col(name: str, p: str | None = None) -> tuple[str, str]:
    base = name if p is None else f"{name}_{p}"
    return (f"`{base}_re`", f"`{base}_im`")


def s_add(a, b):
    return (f"({a[0]} + {b[0]})", f"({a[1]} + {b[1]})")


def s_sub(a, b):
    return (f"({a[0]} - {b[0]})", f"({a[1]} - {b[1]})")


def s_mul(a, b):
    return (f"({a[0]} * {b[0]} - {a[1]} * {b[1]})", f"({a[0]} * {b[1]} + {a[1]} * {b[0]})")


def s_conj(a):
    return (a[0], f"(- {a[1]})")


def s_neg(a):
    return (f"(- {a[0]})", f"(- {a[1]})")


def s_div(a, b):
    d = f"({b[0]} * {b[0]} + {b[1]} * {b[1]})"
    return (f"try_divide({a[0]} * {b[0]} + {a[1]} * {b[1]}, {d})", f"try_divide({a[1]} * {b[0]} - {a[0]} * {b[1]}, {d})")


def s_jones(name: str) -> dict:
    return {p: s_col(name, p) for p in POLS}


def s_jones_mul(a: dict, b: dict) -> dict:
    return {"xx": s_add(s_mul(a["xx"], b["xx"]), s_mul(a["xy"], b["yx"])),
            "xy": s_add(s_mul(a["xx"], b["xy"]), s_mul(a["xy"], b["yy"])),
            "yx": s_add(s_mul(a["yx"], b["xx"]), s_mul(a["yy"], b["yx"])),
            "yy": s_add(s_mul(a["yx"], b["xy"]), s_mul(a["yy"], b["yy"]))}


def s_jones_herm(a: dict) -> dict:
    return {"xx": s_conj(a["xx"]), "xy": s_conj(a["yx"]), "yx": s_conj(a["xy"]), "yy": s_conj(a["yy"])}


def s_jones_det(a: dict):
    return s_sub(s_mul(a["xx"], a["yy"]), s_mul(a["xy"], a["yx"]))


def s_jones_inv(a: dict, det) -> dict:
    return {"xx": s_div(a["yy"], det), "xy": s_div(s_neg(a["xy"]), det),
            "yx": s_div(s_neg(a["yx"]), det), "yy": s_div(a["xx"], det)}


def s_exprs(name: str, value, matrix: bool = False) -> list[str]:
    """``selectExpr`` items materialising a complex (or a Jones dict) as flat columns."""
    if matrix:
        return [f"{value[p][i]} AS `{name}_{p}_{x}`" for p in POLS for i, x in enumerate(("re", "im"))]
    return [f"{value[0]} AS `{name}_re`", f"{value[1]} AS `{name}_im`"]
