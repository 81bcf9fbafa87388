"""Calibration solution tables: long form, dense form, Parquet scan and sink.

Long form (``schemas.SOLUTION``): one row per cell, with the axis order in
``axes`` and the cell index in ``pos``. ``soltab_axis`` keeps the ordered
axis values (order matters and values need not be unique). The dense form
(``schemas.SOLTAB_DENSE``) mirrors the on-disk array layout; it is split into
chunks of at most ``chunk_cells`` cells, so no row grows with a large table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..plans.joins import per_observation

AXIS_VALUE_COL = {"time": "time", "freq": "freq", "ant": "ant", "pol": "pol", "dir": "dir"}


def cast_solution_types(sol: DataFrame) -> DataFrame:
    """Axis values and val as double, weight as float, names as strings."""
    return sol.select(
        F.col("solset").cast("string"), F.col("soltab").cast("string"), F.col("soltype").cast("string"),
        F.col("axes").cast("array<string>"), F.col("pos").cast("array<int>"),
        F.col("time").cast("double"), F.col("freq").cast("double"),
        F.col("ant").cast("string"), F.col("pol").cast("string"), F.col("dir").cast("string"),
        F.col("val").cast("double"), F.col("weight").cast("float"),
    )


def split_axes(text_col) -> Column:
    """``"time,freq,ant"`` -> ["time", "freq", "ant"] (AXES attribute form)."""
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.split(c, ",")


def axis_value(axis: Column) -> Column:
    """Value of the cell on the named axis, as (num_value, str_value)."""
    num = (F.when(axis == "time", F.col("time")).when(axis == "freq", F.col("freq")))
    txt = (F.when(axis == "ant", F.col("ant")).when(axis == "pol", F.col("pol"))
           .when(axis == "dir", F.col("dir")))
    return F.struct(num.alias("num_value"), txt.alias("str_value"))


def axes_of(sol: DataFrame) -> DataFrame:
    """Derive ``soltab_axis`` rows (ordered axis values) from long-form cells."""
    e = sol.select("solset", "soltab", "time", "freq", "ant", "pol", "dir", "pos",
                   F.posexplode("axes").alias("axis_pos", "axis"))
    v = axis_value(F.col("axis"))
    return (e.select("solset", "soltab", "axis", F.col("axis_pos").cast("int").alias("axis_pos"),
                     F.col("pos").getItem(F.col("axis_pos")).alias("pos"),
                     v.getField("num_value").alias("num_value"), v.getField("str_value").alias("str_value"))
            .distinct())


def scan_solutions(spark: SparkSession, path: str) -> DataFrame:
    """Load long-form solution cells; reserved members (antenna, source) are ignored."""
    df = spark.read.schema(S.SOLUTION).parquet(path)
    return cast_solution_types(df.filter(~F.col("soltab").isin(*S.RESERVED_SOLSET_KEYS)))


def default_names(sol: DataFrame, solset: str = "sol000") -> DataFrame:
    """Default names: solset ``sol000``, soltab ``<soltype>000``."""
    return (sol.withColumn("solset", F.coalesce(F.col("solset"), F.lit(solset)))
            .withColumn("soltab", F.coalesce(F.col("soltab"), F.concat(F.col("soltype"), F.lit("000")))))


def write_solutions(sol: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Save cells partitioned by solset and soltab (one folder per table).

    ``rebalance`` brings a table's cells together without one task per table: adaptive
    execution splits a large one over several tasks, and files.
    """
    (default_names(cast_solution_types(sol))
     .hint("rebalance", "solset", "soltab")
     .write.mode(mode).partitionBy("solset", "soltab").parquet(path))


def unpack_soltab(dense: DataFrame) -> DataFrame:
    """Dense chunks (ordered axes, flat val/weight) -> long-form cells.

    The flat index i = offset + k of each element is decomposed into one
    index per axis with integer division by the strides of the later axes
    (row-major order, last axis fastest).
    """
    ax = {a: F.col(f"{a}_axis") for a in S.VALID_AXIS_NAMES}
    size_of = lambda a: F.coalesce(F.size(ax[a]), F.lit(0))
    dims = F.transform("axes", lambda a: (
        F.when(a == "time", size_of("time")).when(a == "freq", size_of("freq"))
        .when(a == "ant", size_of("ant")).when(a == "pol", size_of("pol")).when(a == "dir", size_of("dir"))))
    d = dense.withColumn("_dims", dims)
    # stride_k = product of dims after k
    d = d.withColumn("_strides", F.transform("_dims", lambda x, k: F.aggregate(
        F.slice(F.col("_dims"), k + 2, F.greatest(F.size("_dims") - k - 1, F.lit(0))),
        F.lit(1).cast("bigint"), lambda acc, y: acc * y)))
    # The axis values are read where the arrays are: a cell must not carry its table's axes.
    where = {a: F.array_position("axes", a).cast("int") for a in S.VALID_AXIS_NAMES}
    d = d.withColumns({f"_{k}_{a}": F.when(where[a] > 0, F.element_at(f"_{k}", where[a]))
                       for a in S.VALID_AXIS_NAMES for k in ("strides", "dims")})

    def index_on(k: Column, stride: Column, dim: Column) -> Column:
        return F.pmod(F.floor((F.col("offset") + k) / stride), dim).cast("int")

    def cell(z: Column, k: Column) -> Column:
        at = {a: F.element_at(ax[a], index_on(k, F.col(f"_strides_{a}"), F.col(f"_dims_{a}")) + 1) for a in S.VALID_AXIS_NAMES}
        return F.struct(*[F.when(where[a] > 0, at[a]).alias(a) for a in S.VALID_AXIS_NAMES],
                        z["val"].alias("val"), z["weight"].alias("weight"))

    e = d.select("solset", "soltab", "soltype", "axes", "_dims", "_strides", "offset",
                 F.posexplode(F.transform(F.arrays_zip("val", "weight"), cell)).alias("k", "cell"))
    pos = F.transform("_dims", lambda dim, j: index_on(F.col("k"), F.element_at("_strides", j + 1), dim))
    kinds = {"time": "double", "freq": "double", "ant": "string", "pol": "string", "dir": "string"}
    return e.select(
        "solset", "soltab", "soltype", "axes", pos.alias("pos"),
        *[F.col(f"cell.{a}").cast(kind).alias(a) for a, kind in kinds.items()],
        F.col("cell.val").cast("double").alias("val"), F.col("cell.weight").cast("float").alias("weight"))


def _value_of(field: str):
    return lambda s: s.getField(field)


def pack_soltab(sol: DataFrame, soltab_axis: DataFrame | None = None, chunk_cells: int = 1 << 20) -> DataFrame:
    """Long-form cells -> dense chunks in the order given by ``axes``.

    Each output row holds the cells with flat index in
    [offset, offset + chunk_cells), sorted by flat index; axis values come
    from ``soltab_axis`` (ordered by ``pos``).
    """
    if soltab_axis is None:
        soltab_axis = axes_of(sol)
    dims = (soltab_axis.groupBy("solset", "soltab", "axis_pos").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("solset", "soltab")
            .agg(F.array_sort(F.collect_list(F.struct("axis_pos", "n"))).alias("_d")))
    c = sol.join(per_observation(dims), ["solset", "soltab"])  # one row per soltab
    dim_arr = F.transform("_d", lambda s: s.getField("n"))
    c = c.withColumn("_dims", dim_arr)
    flat = F.aggregate(F.arrays_zip(F.col("pos"), F.col("_dims")), F.lit(0).cast("bigint"),
                       lambda acc, z: acc * z.getField("_dims") + z.getField("pos"))
    c = c.withColumn("_i", flat).withColumn("_chunk", F.floor(F.col("_i") / F.lit(float(chunk_cells))).cast("bigint"))
    cells = (c.groupBy("solset", "soltab", "soltype", "axes", "_chunk")
             .agg(F.array_sort(F.collect_list(F.struct("_i", "val", "weight"))).alias("_c")))
    axis_arrays = (soltab_axis.groupBy("solset", "soltab", "axis")
                   .agg(F.array_sort(F.collect_list(F.struct("pos", "num_value", "str_value"))).alias("_v"))
                   .groupBy("solset", "soltab")
                   .agg(*[F.max(F.when(F.col("axis") == a, F.transform(
                       "_v", _value_of("num_value" if a in ("time", "freq") else "str_value"))))
                       .alias(f"{a}_axis") for a in S.VALID_AXIS_NAMES]))
    out = cells.join(axis_arrays, ["solset", "soltab"], "left")
    return out.select(
        "solset", "soltab", "soltype", "axes",
        *[F.col(f"{a}_axis") for a in S.VALID_AXIS_NAMES],
        (F.col("_chunk") * F.lit(chunk_cells)).cast("bigint").alias("offset"),
        F.transform("_c", lambda s: s.getField("val")).alias("val"),
        F.transform("_c", lambda s: s.getField("weight")).alias("weight"),
    )
