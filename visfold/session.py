"""Spark session and scratch-space helpers.

Only tests, the benchmark and the driver entry build a session here; library
operators take the caller's session (or DataFrame) and never set cluster
options of their own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark: AQE on, UI off, UTC, Arrow on."""
    master = master or os.environ.get("VISFOLD_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName("visfold")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a fused
        # stage whose generated method is larger runs interpreted and is slower than
        # Spark's per-operator fallback (the complex/Jones algebra produces such stages).
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only when it is unset and everything runs in one local process (tests,
    benchmark) a fresh folder is created and registered; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="visfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the workers, once per application.

    Python functions that run in tasks are pickled by reference, so every worker
    must be able to import them. The archive is handed to ``addPyFile``, which
    serves it to executors that join later too.
    """
    sc = spark.sparkContext
    if getattr(sc, "_visfold_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="visfold-src-")) / "visfold.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, Path(root.name) / source.relative_to(root))
    sc.addPyFile(str(archive))
    sc._visfold_shipped = True
