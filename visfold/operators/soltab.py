"""Solution-table rules, dimensions, equality and application mode.

All checks return rows (solset, soltab, rule, detail) instead of raising, so
many tables are validated in one job; ``raise_on_violations`` turns a
non-empty result into an error for callers that need one.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..sources.solutions import axes_of

VALID_SOLTYPES = list(S.VALID_SOLTYPES)
POL2 = ",".join(S.VALID_POL_TUPLES[0])
POL4 = ",".join(S.VALID_POL_TUPLES[1])
_VIOLATION_COLS = ("solset", "soltab", "rule", "detail")


def _valid_axes() -> Column:
    return F.array(*[F.lit(a) for a in S.VALID_AXIS_NAMES])


class InvalidSolutions(ValueError):
    """Raised when a solution set breaks one of the table rules."""


def raise_on_violations(violations: DataFrame, limit: int = 20) -> None:
    """Raise ``InvalidSolutions`` listing (up to ``limit``) violation rows."""
    rows = violations.limit(limit).collect()
    if rows:
        lines = [f"{r.solset}/{r.soltab}: {r.rule} ({r.detail})" for r in rows]
        raise InvalidSolutions("invalid solution tables:\n" + "\n".join(lines))


def soltab_dimensions(soltab_axis: DataFrame) -> DataFrame:
    """Length of each axis (number of values, not distinct values), in axis order."""
    return (soltab_axis.groupBy("solset", "soltab", "axis_pos", "axis")
            .agg(F.count(F.lit(1)).alias("length"))
            .select("solset", "soltab", "axis_pos", "axis", "length"))


def pol_tuples(soltab_axis: DataFrame) -> DataFrame:
    """(solset, soltab, pols) where pols = pol axis values joined by ',' in pos order."""
    p = soltab_axis.filter(F.col("axis") == "pol")
    return (p.groupBy("solset", "soltab")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "str_value"))).alias("_p"))
            .select("solset", "soltab",
                    F.array_join(F.transform("_p", lambda s: s.getField("str_value")), ",").alias("pols")))


def axis_subset_check(sol: DataFrame) -> DataFrame:
    """Per soltab: are all axis names in the valid set?"""
    return (sol.select("solset", "soltab", "axes").distinct()
            .select("solset", "soltab", (F.size(F.array_except("axes", _valid_axes())) == 0).alias("axes_valid"),
                    F.array_join(F.array_sort(F.array_except("axes", _valid_axes())), ",").alias("unknown_axes")))


#: Modulus of the cells' marks (a prime below 2^31, so products fit a long) and their two seeds.
MODULUS = (1 << 31) - 1
MARKS = (0, 1)


def _place_mark(axis: Column, pos: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), axis.cast("int"), pos.cast("int")), F.lit(MODULUS - 1)) + 1


def _product_mod(marks: Column) -> Column:
    return F.aggregate(marks, F.lit(1).cast("bigint"), lambda a, x: F.pmod(a * x, F.lit(MODULUS).cast("bigint")))


def _cell_mark(seed: int) -> Column:
    """A cell's mark: the product of its places' marks, one per axis."""
    return _product_mod(F.transform("pos", lambda p, axis: _place_mark(axis, p, seed)))


def _sum_mod(mark: Column) -> Column:
    """Sum of marks below 2^31, by halves, so that it overflows for no number of cells there could be."""
    high, low = F.sum(F.shiftright(mark, 16)), F.sum(mark.bitwiseAND(F.lit(0xFFFF)))
    return F.pmod(F.pmod(high, F.lit(MODULUS)) * 65536 + F.pmod(low, F.lit(MODULUS)), F.lit(MODULUS))


def _axis_summary(soltab_axis: DataFrame) -> DataFrame:
    """Per soltab: the grid's cells, shape and marks, axes that repeat a place, and the polarisations.

    The marks of all cells of a full grid sum up to the product of the axes' sums, so a table whose cells are its grid, each
    once, is told by sums over cells and over axis values; no cell is shuffled. Any other table passes with a probability
    below (axes / 2^31)^2.
    """
    tab = ["solset", "soltab"]
    places = soltab_axis.groupBy(*tab, "axis_pos", "axis", "pos").agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(F.when(F.col("axis") == "pol", F.struct("pos", "str_value"))).alias("_p"))
    axes = places.groupBy(*tab, "axis_pos", "axis").agg(
        F.sum("n").alias("length"), F.max("n").alias("most"), F.flatten(F.collect_list("_p")).alias("_p"),
        *[_sum_mod(_place_mark(F.col("axis_pos"), F.col("pos"), k)).alias(f"s{k}") for k in MARKS])
    one = axes.groupBy(*tab).agg(F.array_sort(F.collect_list(F.struct("axis_pos", "length", *[f"s{k}" for k in MARKS]))).alias("_a"),
                                 F.array_sort(F.collect_set(F.when(F.col("most") > 1, F.col("axis")))).alias("_dup"),
                                 F.array_sort(F.flatten(F.collect_list("_p"))).alias("_p"), F.bool_or(F.col("axis") == "pol").alias("_has_pol"))
    lengths = F.transform("_a", lambda s: s.getField("length"))
    return one.select(*tab, F.aggregate(lengths, F.lit(1).cast("bigint"), lambda a, x: a * x).alias("_prod"),
                      F.array_join(F.transform("_a", lambda s: s.getField("length").cast("string")), ",").alias("_shape"),
                      F.when(F.size("_dup") > 0, F.array_join("_dup", ",")).alias("_dup_axes"),
                      F.when(F.col("_has_pol"), F.array_join(F.transform("_p", lambda s: s.getField("str_value")), ",")).alias("pols"),
                      *[_product_mod(F.transform("_a", _field(f"s{k}"))).alias(f"_grid{k}") for k in MARKS])


def _field(name: str):
    return lambda s: s.getField(name)


def soltab_violations(sol: DataFrame, soltab_axis: DataFrame | None = None) -> DataFrame:
    """Per-soltab rules: soltype, axis names, 1-d axes, pol tuple, val/weight shape, axes shape."""
    if soltab_axis is None:
        soltab_axis = axes_of(sol)
    per_tab = sol.withColumns({f"_m{k}": _cell_mark(k) for k in MARKS}).groupBy("solset", "soltab").agg(
        F.collect_set("soltype").alias("_types"),
        F.first("axes").alias("axes"),
        F.count(F.lit(1)).alias("_cells"),
        F.count("val").alias("_nval"),
        F.count("weight").alias("_nweight"),
        F.sum(F.when(F.size("pos") != F.size("axes"), 1).otherwise(0)).alias("_badpos"),
        F.count("_m0").alias("_npos"),
        *[_sum_mod(F.col(f"_m{k}")).alias(f"_found{k}") for k in MARKS])
    t = per_tab.join(_axis_summary(soltab_axis), ["solset", "soltab"], "left")
    unknown = F.array_except("axes", _valid_axes())
    soltype = F.array_join(F.array_sort("_types"), ",")
    checks = [
        ("unknown_soltype", F.size(F.array_except("_types", F.array(*[F.lit(x) for x in VALID_SOLTYPES]))) > 0,
         soltype),
        ("unknown_axis", F.size(unknown) > 0, F.array_join(F.array_sort(unknown), ",")),
        ("axis_not_1d", F.col("_dup_axes").isNotNull(), F.col("_dup_axes")),
        ("invalid_pol", F.col("pols").isNotNull() & ~F.col("pols").isin(POL2, POL4), F.col("pols")),
        ("val_weight_shape", F.col("_nval") != F.col("_nweight"),
         F.concat_ws("/", F.col("_nval").cast("string"), F.col("_nweight").cast("string"))),
        ("axes_shape", (F.col("_badpos") > 0) | (F.col("_npos") != F.col("_cells"))
         | (F.coalesce(F.col("_prod"), F.lit(1)) != F.col("_cells"))
         | reduce(or_, [F.col(f"_found{k}") != F.coalesce(F.col(f"_grid{k}"), F.lit(1)) for k in MARKS]),
         F.concat_ws("/", F.col("_cells").cast("string"), F.coalesce(F.col("_shape"), F.lit("")))),
    ]
    arr = F.array(*[F.when(cond, F.struct(F.lit(rule).alias("rule"), det.cast("string").alias("detail")))
                    for rule, cond, det in checks])
    return (t.select("solset", "soltab", F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("v"))
            .select("solset", "soltab", F.col("v.rule").alias("rule"), F.col("v.detail").alias("detail")))


def soltab_axes_agree(dense: DataFrame) -> DataFrame:
    """Dense form: val and weight name the same axes and both are present."""
    waxes = F.col("weight_axes") if "weight_axes" in dense.columns else F.col("axes")
    ok = F.col("val").isNotNull() & F.col("weight").isNotNull() & (F.col("axes") == waxes)
    return (dense.select("solset", "soltab", ok.alias("ok")).groupBy("solset", "soltab")
            .agg(F.bool_and("ok").alias("axes_agree")))


def _solset_summary(sol: DataFrame, soltab_axis: DataFrame | None) -> DataFrame:
    if soltab_axis is None:
        soltab_axis = axes_of(sol)
    tabs = sol.select("solset", "soltab", "soltype").distinct()
    tabs = tabs.join(pol_tuples(soltab_axis), ["solset", "soltab"], "left").fillna({"pols": ""})
    return tabs.groupBy("solset").agg(
        F.count(F.lit(1)).alias("n_soltabs"),
        F.array_sort(F.collect_list(F.struct("soltype", "soltab", "pols"))).alias("tabs"),
    )


def order_soltabs(tabs: Column) -> Column:
    """Soltab names ordered by soltype (amplitude before phase)."""
    return F.transform(F.array_sort(tabs), lambda s: s.getField("soltab"))


def solset_violations(sol: DataFrame, soltab_axis: DataFrame | None = None,
                      file_col: str | None = None) -> DataFrame:
    """Set rules: 1 or 2 soltabs; two must be amplitude+phase with the same pol axis;
    a lone amplitude or phase with 4 pols is an incomplete full-Jones solution.
    With ``file_col``, every file must hold exactly one solset."""
    s = _solset_summary(sol, soltab_axis)
    types = F.transform("tabs", lambda x: x.getField("soltype"))
    pols = F.transform("tabs", lambda x: x.getField("pols"))
    n = F.col("n_soltabs")
    checks = [
        ("soltab_count", ~n.isin(1, 2), n.cast("string")),
        ("two_soltab_types", (n == 2) & (F.array_join(F.array_sort(types), ",") != "amplitude,phase"),
         F.array_join(F.array_sort(types), ",")),
        ("pol_mismatch", (n == 2) & (F.element_at(pols, 1) != F.element_at(pols, 2)), F.array_join(pols, "|")),
        ("incomplete_fulljones", (n == 1) & F.element_at(types, 1).isin("amplitude", "phase")
         & (F.size(F.split(F.element_at(pols, 1), ",")) == 4), F.element_at(types, 1)),
    ]
    arr = F.array(*[F.when(c, F.struct(F.lit(r).alias("rule"), d.alias("detail"))) for r, c, d in checks])
    out = (s.select("solset", F.lit(None).cast("string").alias("soltab"),
                    F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("v"))
           .select("solset", "soltab", F.col("v.rule").alias("rule"), F.col("v.detail").alias("detail")))
    if file_col is not None:
        per_file = (sol.groupBy(file_col).agg(F.count_distinct("solset").alias("n"))
                    .filter(F.col("n") != 1)
                    .select(F.col(file_col).cast("string").alias("solset"), F.lit(None).cast("string").alias("soltab"),
                            F.lit("solset_count").alias("rule"), F.col("n").cast("string").alias("detail")))
        out = out.unionByName(per_file)
    return out


def solset_correction(sol: DataFrame, soltab_axis: DataFrame | None = None) -> DataFrame:
    """How a valid set is applied: ``fulljones``, a single soltab, or amplitude then phase."""
    s = _solset_summary(sol, soltab_axis)
    types = F.array_join(F.array_sort(F.transform("tabs", lambda x: x.getField("soltype"))), ",")
    full = (F.col("n_soltabs") == 2) & (types == "amplitude,phase") & F.forall(
        "tabs", lambda x: x.getField("pols") == POL4)
    correction = (F.when(full, F.lit("fulljones"))
                  .when(F.col("n_soltabs") == 1, F.element_at("tabs", 1).getField("soltab"))
                  .when((F.col("n_soltabs") == 2) & (types == "amplitude,phase"), F.lit("amplitude_phase")))
    return s.select("solset", correction.alias("correction"),
                    F.array_join(order_soltabs(F.col("tabs")), ",").alias("soltabs"))


def _cells(sol: DataFrame) -> DataFrame:
    return sol.select("soltype", F.array_join(F.transform("pos", lambda p: p.cast("string")), ",").alias("pos"),
                      "val", "weight")


def _axis_rows(soltab_axis: DataFrame, sol: DataFrame) -> DataFrame:
    types = sol.select("solset", "soltab", "soltype").distinct()
    return soltab_axis.join(types, ["solset", "soltab"]).select("soltype", "axis", "pos", "num_value", "str_value")


def _neq(a: Column, b: Column) -> Column:
    """Difference test where NaN differs from NaN and null matches only null."""
    nan = F.isnan(F.coalesce(a, F.lit(0.0))) | F.isnan(F.coalesce(b, F.lit(0.0)))
    return nan | ~a.eqNullSafe(b)


def solutions_equal(a: DataFrame, b: DataFrame, a_axis: DataFrame | None = None,
                    b_axis: DataFrame | None = None) -> DataFrame:
    """Equality of two solution sets: same soltypes, axis names, axis values (in order),
    val and weight. Soltab names and order are ignored. One row of counts."""
    a_axis = axes_of(a) if a_axis is None else a_axis
    b_axis = axes_of(b) if b_axis is None else b_axis
    ca, cb = _cells(a).alias("l"), _cells(b).alias("r")
    cells = ca.join(cb, (F.col("l.soltype") == F.col("r.soltype")) & (F.col("l.pos") == F.col("r.pos")), "full_outer")
    cdiff = cells.select((F.col("l.soltype").isNull() | F.col("r.soltype").isNull()
                          | _neq(F.col("l.val"), F.col("r.val"))
                          | _neq(F.col("l.weight").cast("double"), F.col("r.weight").cast("double"))).alias("d"))
    xa, xb = _axis_rows(a_axis, a).alias("l"), _axis_rows(b_axis, b).alias("r")
    axes = xa.join(xb, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in ("soltype", "axis", "pos")], "full_outer")
    adiff = axes.select((F.col("l.axis").isNull() | F.col("r.axis").isNull()
                         | _neq(F.col("l.num_value"), F.col("r.num_value"))
                         | ~F.col("l.str_value").eqNullSafe(F.col("r.str_value"))).alias("d"))
    both = (cdiff.select(F.col("d").cast("bigint").alias("c"), F.lit(0).cast("bigint").alias("a"))
            .unionByName(adiff.select(F.lit(0).cast("bigint").alias("c"), F.col("d").cast("bigint").alias("a"))))
    n = both.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("cell_diffs"),
                 F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("axis_diffs"))
    return n.select("cell_diffs", "axis_diffs",
                    ((F.col("cell_diffs") == 0) & (F.col("axis_diffs") == 0)).alias("equal"))


def solutions_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cells in one set and not in the other (names ignored), both directions."""
    cols = ["soltype", "axes", "pos", "time", "freq", "ant", "pol", "dir", "val", "weight"]
    left = a.select(*cols).exceptAll(b.select(*cols)).withColumn("side", F.lit("left_only"))
    right = b.select(*cols).exceptAll(a.select(*cols)).withColumn("side", F.lit("right_only"))
    return left.unionByName(right)


def axis_members(members: DataFrame) -> DataFrame:
    """Group members minus ``val``/``weight`` are the axes; solset members minus the
    reserved keys are the soltabs. Input rows: (solset, soltab, member)."""
    tab = (members.filter(F.col("soltab").isNotNull()).groupBy("solset", "soltab")
           .agg(F.array_sort(F.array_except(F.collect_set("member"), F.array(F.lit("val"), F.lit("weight"))))
                .alias("axis_names")))
    return tab.filter(~F.col("soltab").isin(*S.RESERVED_SOLSET_KEYS))
