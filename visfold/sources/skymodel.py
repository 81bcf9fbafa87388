"""Sky-model text files -> ``sky_patch`` and ``sky_component`` DataFrames.

Layout: a ``FORMAT = Name, Type, Patch, Ra, Dec, I, ...`` header names the
comma-separated fields (a field may carry a default, ``Name='value'``);
blank and ``#`` lines are skipped; rows with empty Name and Type are patch
rows, the others components. Lists such as ``[0.0, -0.7]`` may contain
commas. Lines are split by Spark (``spark.read.text`` + ``split``), so a large
catalogue is parsed in parallel; only the one header line reaches the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sky import parse_angle

# Canonical field names of the format header.
FIELDS = ("Name", "Type", "Patch", "Ra", "Dec", "I", "SpectralIndex", "LogarithmicSI",
          "ReferenceFrequency", "MajorAxis", "MinorAxis", "Orientation")
_SPLIT = r",(?![^\[]*\])"
_HEADER = r"^\s*(?i:format)\s*="


def parse_header(line: str) -> dict[str, tuple[int, str | None]]:
    """``FORMAT = Name, Type, X='d'`` -> {field: (index, default)}."""
    body = line.split("=", 1)[1]
    out = {}
    for i, part in enumerate(re.split(_SPLIT, body)):
        part = part.strip()
        m = re.fullmatch(r"(\w+)\s*(?:=\s*'?([^']*)'?)?", part)
        if not m:
            raise ValueError(f"bad format field {part!r}")
        out[m.group(1)] = (i, m.group(2))
    return out


def _field(fields: Column, header: dict, name: str) -> Column:
    if name not in header:
        return F.lit(None).cast("string")
    idx, default = header[name]
    v = F.trim(F.try_element_at(fields, F.lit(idx + 1)))  # short rows: missing trailing fields
    v = F.when(v == "", F.lit(None)).otherwise(v)
    return F.coalesce(v, F.lit(default)) if default is not None else v


def _double_list(text: Column) -> Column:
    inner = F.regexp_replace(text, r"[\[\]\s]", "")
    return F.when(text.isNull() | (inner == ""), F.array().cast("array<double>")).otherwise(
        F.transform(F.split(inner, ","), lambda x: x.cast("double")))


def scan_sky_model(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read a sky-model text file (or folder of parts) -> (sky_patch, sky_component)."""
    lines = spark.read.text(path).select(F.trim("value").alias("t"))
    head = lines.filter(F.col("t").rlike(_HEADER)).limit(1).collect()
    if not head:
        raise ValueError(f"{path}: no FORMAT header")
    header = parse_header(head[0]["t"])
    rows = lines.filter((F.col("t") != "") & ~F.col("t").startswith("#") & ~F.col("t").rlike(_HEADER))
    f = F.split(F.col("t"), _SPLIT)
    g = {name: _field(f, header, name) for name in FIELDS}
    parsed = rows.select(*[g[n].alias(n) for n in FIELDS])
    is_patch = F.col("Name").isNull() & F.col("Type").isNull()
    patches = parsed.filter(is_patch).select(
        F.col("Patch").alias("patch"), parse_angle(F.col("Ra"), "ra").alias("ra"),
        parse_angle(F.col("Dec"), "dec").alias("dec"))
    comps = parsed.filter(~is_patch).select(
        F.col("Name").alias("name"), F.upper(F.col("Type")).alias("type"), F.col("Patch").alias("patch"),
        parse_angle(F.col("Ra"), "ra").alias("ra"), parse_angle(F.col("Dec"), "dec").alias("dec"),
        F.col("I").cast("double").alias("flux_i"), _double_list(F.col("SpectralIndex")).alias("si"),
        F.coalesce(F.lower(F.col("LogarithmicSI")) == "true", F.lit(True)).alias("log_si"),
        F.col("ReferenceFrequency").cast("double").alias("ref_freq"),
        F.col("MajorAxis").cast("double").alias("major"), F.col("MinorAxis").cast("double").alias("minor"),
        F.col("Orientation").cast("double").alias("orientation"))
    return patches, comps


def patch_components(patches: DataFrame, components: DataFrame) -> DataFrame:
    """Attach each component to its patch (inner equi-join; patches are few)."""
    from ..plans.joins import bounded_broadcast
    p = patches.select("patch", F.col("ra").alias("patch_ra"), F.col("dec").alias("patch_dec"))
    return components.join(bounded_broadcast(p), "patch")


def select_patches(patches: DataFrame, names) -> DataFrame:
    """Keep the named patches (``subtractsources``); unknown names raise ``ValueError``."""
    spark = patches.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], "patch string")
    unknown = [r["patch"] for r in wanted.join(patches.select("patch"), "patch", "left_anti").collect()]
    if unknown:
        raise ValueError(f"unknown patches: {sorted(unknown)}")
    return patches.join(wanted, "patch", "left_semi")


def write_sky_model(rows: DataFrame, path: str, header: str) -> None:
    """Write text lines (column ``line``) plus a header line as a sky-model folder."""
    spark = rows.sparkSession
    head = spark.createDataFrame([(header,)], "line string")
    head.unionByName(rows.select("line")).write.mode("overwrite").text(path)
