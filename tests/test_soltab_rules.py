"""One failing input per solution-table rule, and the valid cases."""

import pytest
from pyspark.sql import functions as F

from visfold import schemas as S
from visfold.operators import soltab as ST
from visfold.sources import solutions as SO


def cells(spark, rows):
    """rows: (solset, soltab, soltype, axes, pos, time, ant, pol, val, weight)."""
    full = [(a, b, c, d, e, f, None, g, h, None, i, j) for a, b, c, d, e, f, g, h, i, j in rows]
    return spark.createDataFrame(full, S.SOLUTION)


def tab(spark, solset="s", soltab="amplitude000", soltype="amplitude", axes=("time", "ant"), n_time=2,
        ants=("a", "b"), pols=None, **kw):
    rows = []
    for t in range(n_time):
        for ai, a in enumerate(ants):
            for pi, p in enumerate(pols or [None]):
                pos = [t, ai] + ([pi] if pols else [])
                rows.append((solset, soltab, soltype, list(axes), pos, float(t), a, p, 1.0, 1.0))
    return cells(spark, rows)


def rules(df):
    return sorted((r.solset, r.soltab, r.rule) for r in ST.soltab_violations(df).collect())


def test_valid_soltab_has_no_violation(spark):
    assert rules(tab(spark)) == []


def test_unknown_soltype(spark):
    assert ("s", "amplitude000", "unknown_soltype") in rules(tab(spark, soltype="zzz"))


def test_unknown_axis(spark):
    assert ("s", "amplitude000", "unknown_axis") in rules(tab(spark, axes=("time", "zzz")))


def test_axis_not_one_dimensional(spark):
    df = tab(spark)
    df = df.withColumn("time", F.when((F.element_at("pos", 1) == 0) & (F.col("ant") == "a"), 5.0)
                       .otherwise(F.col("time")))
    assert ("s", "amplitude000", "axis_not_1d") in rules(df)


def test_invalid_pol(spark):
    assert ("s", "amplitude000", "invalid_pol") in rules(
        tab(spark, axes=("time", "ant", "pol"), pols=("XX", "zzz")))
    # the right values in the wrong order are invalid too
    assert ("s", "amplitude000", "invalid_pol") in rules(
        tab(spark, axes=("time", "ant", "pol"), pols=("YY", "XX")))


def test_val_weight_shapes_differ(spark):
    df = tab(spark).withColumn("weight", F.when(F.col("ant") == "a", F.lit(None).cast("float"))
                               .otherwise(F.col("weight")))
    assert ("s", "amplitude000", "val_weight_shape") in rules(df)


def test_shape_against_axes(spark):
    df = tab(spark).filter(~((F.col("ant") == "b") & (F.col("time") == 1.0)))
    assert ("s", "amplitude000", "axes_shape") in rules(df)


def set_rules(df):
    return sorted(r.rule for r in ST.solset_violations(df).collect())


def test_incomplete_full_jones(spark):
    df = tab(spark, soltab="phase000", soltype="phase", axes=("time", "ant", "pol"),
             pols=("XX", "XY", "YX", "YY"))
    assert set_rules(df) == ["incomplete_fulljones"]


def test_three_soltabs(spark):
    df = tab(spark).unionByName(tab(spark, soltab="phase000", soltype="phase")).unionByName(
        tab(spark, soltab="tec000", soltype="tec"))
    assert set_rules(df) == ["soltab_count"]


def test_two_soltabs_must_be_amplitude_and_phase(spark):
    df = tab(spark).unionByName(tab(spark, soltab="tec000", soltype="tec"))
    assert set_rules(df) == ["two_soltab_types"]


def test_pol_axes_must_match(spark):
    df = tab(spark, axes=("time", "ant", "pol"), pols=("XX", "YY")).unionByName(
        tab(spark, soltab="phase000", soltype="phase", axes=("time", "ant", "pol"), pols=("XX", "XY", "YX", "YY")))
    assert "pol_mismatch" in set_rules(df)


def test_one_solset_per_file(spark):
    df = tab(spark).withColumn("file", F.lit("f.h5")).unionByName(
        tab(spark, solset="t").withColumn("file", F.lit("f.h5")))
    out = ST.solset_violations(df, file_col="file").collect()
    assert [r.rule for r in out] == ["solset_count"]


def test_raise_on_violations(spark):
    with pytest.raises(ST.InvalidSolutions):
        ST.raise_on_violations(ST.soltab_violations(tab(spark, soltype="zzz")))


def test_correction_forms(spark):
    amp = tab(spark, axes=("time", "ant", "pol"), pols=("XX", "XY", "YX", "YY"))
    ph = tab(spark, soltab="phase000", soltype="phase", axes=("time", "ant", "pol"), pols=("XX", "XY", "YX", "YY"))
    full = {r.solset: (r.correction, r.soltabs) for r in ST.solset_correction(amp.unionByName(ph)).collect()}
    assert full == {"s": ("fulljones", "amplitude000,phase000")}
    one = {r.solset: r.correction for r in ST.solset_correction(tab(spark, soltab="phase000", soltype="phase")).collect()}
    assert one == {"s": "phase000"}
    two = ST.solset_correction(tab(spark).unionByName(tab(spark, soltab="phase000", soltype="phase"))).collect()
    assert [(r.correction, r.soltabs) for r in two] == [("amplitude_phase", "amplitude000,phase000")]


def test_pack_unpack_roundtrip_and_equality(spark):
    a = tab(spark, axes=("time", "ant", "pol"), pols=("XX", "YY"))
    back = SO.unpack_soltab(SO.pack_soltab(a, chunk_cells=3))
    r = ST.solutions_equal(a, back).collect()[0]
    assert r.equal and r.cell_diffs == 0 and r.axis_diffs == 0
    other = a.withColumn("val", F.when(F.col("ant") == "a", F.lit(2.0)).otherwise(F.col("val")))
    r2 = ST.solutions_equal(a, other).collect()[0]
    assert not r2.equal and r2.cell_diffs == 4


def test_unpacked_cells_do_not_carry_their_axes(spark):
    """A cell beside its table's whole time axis is memory that grows with the square of the axis."""
    dense = SO.pack_soltab(tab(spark, axes=("time", "ant", "pol"), n_time=7, pols=("XX", "YY")), chunk_cells=5)
    cells = SO.unpack_soltab(dense)
    assert cells.select("time", "ant", "pol").distinct().count() == cells.count() == 28
    plan = cells._jdf.queryExecution().sparkPlan().toString()
    exploded, = [line for line in plan.splitlines() if "Generate posexplode" in line and "_axis" in line]
    assert "_axis" not in exploded.rsplit("), [", 1)[1].split("]")[0], exploded  # what a cell keeps of its chunk


def test_nan_differs_from_nan(spark):
    a = tab(spark).withColumn("val", F.lit(float("nan")))
    assert not ST.solutions_equal(a, a).collect()[0].equal


def test_dimensions_in_axis_order(spark):
    a = tab(spark, axes=("time", "ant", "pol"), n_time=3, pols=("XX", "YY"))
    d = ST.soltab_dimensions(SO.axes_of(a)).orderBy("axis_pos").collect()
    assert [(r.axis, r.length) for r in d] == [("time", 3), ("ant", 2), ("pol", 2)]


def grid_cells(spark, cells):
    rows = [("s", "t", "amplitude", ["time", "ant"], list(p), float(p[0]), None, f"ant{p[1]}", None, None, 1.0, 1.0) for p in cells]
    return spark.createDataFrame(rows, S.SOLUTION)


def test_grids_with_the_same_sums_differ(spark):
    """Repeated cells that keep the number of cells, and first and second moments of a packed cell number."""
    import random

    full = [(a, b) for a in range(5) for b in range(7)]
    assert ST.soltab_violations(grid_cells(spark, full)).count() == 0
    rng = random.Random(2)
    for _ in range(3):
        cells = list(full)
        i, j = rng.sample(range(len(full)), 2)
        cells[i] = cells[j]
        assert [r["rule"] for r in ST.soltab_violations(grid_cells(spark, cells)).collect()] == ["axes_shape"]
    swapped = [c for c in full if c not in {(0, 0), (0, 4), (0, 5)}] + [(0, 1), (0, 2), (0, 6)]
    assert [r["rule"] for r in ST.soltab_violations(grid_cells(spark, swapped)).collect()] == ["axes_shape"]


def test_violations_shuffle_no_cells(spark):
    sol = grid_cells(spark, [(a, b) for a in range(5) for b in range(7)])
    ST.soltab_violations(sol).collect()
    plan = ST.soltab_violations(sol)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hash" in line for line in plan.split("Initial Plan")[0].splitlines()) <= 6
