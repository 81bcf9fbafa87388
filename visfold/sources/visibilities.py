"""Visibility scans and sinks, input manifests.

At rest a visibility set is Parquet in the ``vis_rows`` layout: one row per
(observation, slot, baseline) with per-channel arrays, one folder per
observation (``obs_id=<k>`` partitions). The working form is one row per
channel (``schemas.VIS``). Many observations are read as one DataFrame and
processed by one job; ``obs_id`` leads every key downstream.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..plans.joins import per_observation

ROW_KEY = ("obs_id", "slot", "ant1", "ant2")
DATA_COLUMNS = {"DATA": "data", "CORRECTED_DATA": "corrected_data", "MODEL_DATA": "model_data"}


def rows_to_channels(rows: DataFrame, data_column: str = "data") -> DataFrame:
    """Array-per-row -> row-per-channel (``posexplode`` of the zipped channel arrays)."""
    z = F.arrays_zip(F.col("chan").alias("chan"), F.col("freq").alias("freq"), F.col("weight").alias("weight"),
                     F.col(data_column).alias("data"), F.col("flag").alias("flag"))
    e = rows.select("obs_id", "slot", "time", "ant1", "ant2", "u", "v", "w", F.explode(z).alias("c"))
    return e.select("obs_id", "slot", "time", "ant1", "ant2", F.col("c.chan").alias("chan"),
                    F.col("c.freq").alias("freq"), "u", "v", "w", F.col("c.weight").alias("weight"),
                    F.col("c.data").alias("data"), F.col("c.flag").alias("flag"))


def channels_to_rows(vis: DataFrame, extra_data: Sequence[str] = ()) -> DataFrame:
    """Row-per-channel -> array-per-row; channels sorted. A group is one (time, baseline):
    its size is the channel count, never the data size."""
    fields = ["chan", "freq", "weight", "data", "flag", *extra_data]
    g = vis.groupBy("obs_id", "slot", "time", "ant1", "ant2", "u", "v", "w").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("_c"))
    return g.select("obs_id", "slot", "time", "ant1", "ant2", "u", "v", "w",
                    *[F.transform("_c", _field_of(f)).alias(f) for f in fields])


def _field_of(name: str):
    # one-argument lambda: ``transform`` passes the element index to a second parameter
    return lambda s: s.getField(name)


def order_output(df: DataFrame, partitions: int | None = None, with_chan: bool = False) -> DataFrame:
    """Range-partition and sort by (obs_id, slot, ant1, ant2[, chan]) for the sink.

    The range partitioning also satisfies a following group-by on a superset
    of these keys, so ``channels_to_rows`` after it adds no exchange. Never
    one task per observation: ranges split inside observations.
    """
    keys = list(ROW_KEY) + (["chan"] if with_chan else [])
    # without a number, adaptive execution sizes the partitions by their bytes
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_visibilities(vis: DataFrame, output_dir: str, overwrite: bool = True,
                       extra_data: Sequence[str] = ()) -> None:
    """MsOut: write every observation under ``output_dir/obs_id=<k>``.

    ``overwrite``: replace only the observations being written (dynamic
    partition overwrite), others in the folder survive; otherwise fail if
    the folder exists.
    """
    rows = channels_to_rows(order_output(vis), extra_data)
    rows = rows.sortWithinPartitions(*ROW_KEY)
    w = rows.write.partitionBy("obs_id")
    if overwrite:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("errorifexists")
    w.parquet(output_dir)


def _norm_path(c):
    c = F.regexp_replace(c, r"^file:(//)?", "")
    return F.regexp_replace(c, r"/+$", "")


def first_slots(rows: DataFrame) -> DataFrame:
    """(obs_id, first_slot), from two columns of the rows as stored."""
    return rows.groupBy("obs_id").agg(F.min("slot").alias("first_slot"))


def scan_visibilities(spark: SparkSession, paths, data_column: str = "DATA",
                      manifest: DataFrame | None = None) -> DataFrame:
    """MsIn: read one or many observations as one set and return channel rows (see ``scan_rows``)."""
    return rows_to_channels(scan_rows(spark, paths, data_column, manifest), DATA_COLUMNS.get(data_column.upper(), data_column.lower()))


def scan_rows(spark: SparkSession, paths, data_column: str = "DATA", manifest: DataFrame | None = None) -> DataFrame:
    """Read one or many observations as one set of rows as stored.

    ``paths``: a root with ``obs_id=<k>`` partitions, or observation folders
    listed in ``manifest`` (path, obs_id), whose ``obs_id`` is attached by an
    equi-join of each file's folder with the manifest (one row per
    observation, broadcast). A file whose folder the manifest lacks is an error.
    ``data_column`` selects DATA, CORRECTED_DATA or MODEL_DATA as the ``data`` being processed.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    col = DATA_COLUMNS.get(data_column.upper(), data_column.lower())
    df = spark.read.parquet(*paths)
    if col not in df.columns:
        raise ValueError(f"the input has no data column {data_column!r}")
    if manifest is not None:
        folder = F.regexp_replace(F.col("_metadata.file_path"), r"/[^/]*$", "")
        decoded = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))  # the file path is percent-encoded
        df = df.withColumn("_dir", _norm_path(decoded))
        m = manifest.select(_norm_path(F.col("path")).alias("_dir"), F.col("obs_id").cast("bigint").alias("_oid"))
        # the folders of the files that the reader has listed anyway
        folders = sorted({unquote(f.rsplit("/", 1)[0]) for f in df.inputFiles()})
        listed = spark.createDataFrame([(f,) for f in folders], "folder string").select(_norm_path(F.col("folder")).alias("_dir"))
        if lacking := [r["_dir"] for r in listed.join(m, "_dir", "left_anti").limit(20).collect()]:
            raise ValueError(f"no manifest entry for {sorted(lacking)}")
        df = df.join(per_observation(m), "_dir").drop("_dir")
        df = df.drop("obs_id") if "obs_id" in df.columns else df
        df = df.withColumnRenamed("_oid", "obs_id")
    return df.withColumn("obs_id", F.col("obs_id").cast("bigint"))


def select_data_column(rows: DataFrame, data_column: str) -> DataFrame:
    """Choose which stored data column is processed (rows layout); others are pruned."""
    col = DATA_COLUMNS.get(data_column.upper(), data_column.lower())
    return rows.withColumn("data", F.col(col))


def scan_flags(vis: DataFrame) -> DataFrame:
    """The flag column with its key (column pruning reads nothing else)."""
    return vis.select("obs_id", "slot", "ant1", "ant2", "chan", "flag")


def write_antennas(antenna: DataFrame, path: str) -> None:
    antenna.select(F.col("obs_id").cast("bigint"), F.col("ant").cast("int"), F.col("name").cast("string")) \
        .write.mode("overwrite").parquet(path)


def scan_antennas(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.ANTENNA).parquet(path)


# ------------------------------------------------------------------ manifest

def input_manifest(paths: DataFrame, output_dir: str | None = None) -> DataFrame:
    """(path) -> (path, name, stem, obs_id[, out_path]); stem = last component minus last suffix.

    ``obs_id`` is a stable hash of the path, so it needs no global numbering.
    """
    name = F.regexp_extract(F.col("path"), r"([^/]+)/*$", 1)
    stem = F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)).otherwise(name)
    out = paths.select("path", name.alias("name"), stem.alias("stem"),
                       F.xxhash64("path").alias("obs_id"))
    if output_dir is not None:
        out = out.withColumn("out_path", F.concat_ws("/", F.lit(output_dir.rstrip("/")), F.col("name")))
    return out


def duplicate_inputs(manifest: DataFrame) -> DataFrame:
    """Inputs whose stem occurs more than once (they would share an output name).

    Stem counts are a partial-aggregated group-by, then a semi-join: a hot
    stem never buffers its paths in one task."""
    dup = manifest.groupBy("stem").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("stem")
    return manifest.join(dup, "stem", "left_semi").select("path", "stem")


def assert_no_duplicate_inputs(manifest: DataFrame, limit: int = 50) -> None:
    rows = duplicate_inputs(manifest).limit(limit).collect()
    if rows:
        lines = ["these inputs would share an output name:"] + sorted(r["path"] for r in rows)
        raise ValueError("\n".join(lines))


def time_slots(vis: DataFrame) -> DataFrame:
    """Add ``rel_slot``: dense rank of the time within its observation (0-based).

    The rank runs on the distinct (obs_id, time) pairs, one window partition
    per observation of at most its number of time steps, and is joined back
    on (obs_id, time); AQE picks the join strategy from the runtime size."""
    t = vis.select("obs_id", "time").distinct()
    t = t.withColumn("rel_slot", (F.dense_rank().over(Window.partitionBy("obs_id").orderBy("time")) - 1).cast("bigint"))
    return vis.join(t, ["obs_id", "time"])


def union_observations(*sets: DataFrame) -> DataFrame:
    """Many inputs, one configuration: one DataFrame keyed by ``obs_id``."""
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s)
    return out
