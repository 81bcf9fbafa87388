"""Run one step list over many observations so that a bad one stops none of the others.

Observations are processed in batches, each one Spark job over all of its inputs. A batch that
fails is halved and tried again until the bad observation stands alone, where its error is recorded. So
good inputs cost one pass, and a bad one costs the logarithm of its batch's size in further jobs.

The ledger is an append-only table with a row per change of state: ``staged`` before a batch's first job,
then ``committed`` (with the rows written) or ``failed`` (with the error). An observation's output replaces its folder in
one commit of the writer, so work that ended between output and ledger is done again with the same result. A restart
takes what isn't committed: failed inputs are tried again, committed ones aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.visibilities import DATA_COLUMNS
from .preprocess import Inputs, normalise_steps, run_pipeline

LEDGER = "run int, seq bigint, obs_id bigint, path string, state string, n_rows bigint, error string"
#: Columns that an input must have besides its data column.
NEEDED = {"slot", "time", "ant1", "ant2", "u", "v", "w", "chan", "freq", "weight", "flag"}
#: Inputs whose columns are read at a time.
CHECKS_AT_ONCE = 16
#: Letters of an error that the ledger keeps.
ERROR_CHARS = 2000


class _Writer:
    """Appends numbered rows of one run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._append([])  # makes the folder
        last = read_ledger(spark, path).agg(F.max("run").alias("run"), F.max("seq").alias("seq")).first()
        self.run, self.seq = (last["run"] or 0) + 1, (last["seq"] or 0) + 1

    def _append(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(self.path)

    def record(self, rows: Iterable[tuple]) -> None:
        """rows: (obs_id, path, state, n_rows, error)."""
        rows = list(rows)
        self._append([(self.run, self.seq + k, *r) for k, r in enumerate(rows)])
        self.seq += len(rows)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def latest_states(ledger: DataFrame) -> DataFrame:
    """The last row of each input (obs_id, path)."""
    last = F.max_by(F.struct("run", "seq", "state", "n_rows", "error"), "seq").alias("r")
    return ledger.groupBy("obs_id", "path").agg(last).select("obs_id", "path", "r.*")


def _check_input(spark: SparkSession, path: str, column: str) -> None:
    """Raise for an input whose columns can't be read or are incomplete.

    In a batch, the reader takes the columns of one file for all, and would fill a missing one with nulls.
    """
    have = set(spark.read.parquet(path).columns)
    if lacking := sorted((NEEDED | {column}) - have):
        raise ValueError(f"the input lacks the columns {lacking}")


def _input_error(spark: SparkSession, path: str, column: str) -> Exception | None:
    """What ``_check_input`` raises."""
    try:
        _check_input(spark, path, column)
    except Exception as error:
        return error
    return None


def _rows_written(spark: SparkSession, output_dir: str, ids: list) -> dict:
    """Rows in the output folders of these observations. Only they are listed: the output holds every batch before."""
    root = output_dir.rstrip("/")
    folders = ",".join(f"obs_id={o}" for o in ids if o is not None)
    there = spark.read.option("basePath", root)
    try:
        done = there.parquet(f"{root}/{{{folders}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}  # observations without rows have no folder
    return {r["obs_id"]: r["count"] for r in done.groupBy(F.col("obs_id").cast("bigint").alias("obs_id")).count().collect()}


def run_observations(spark: SparkSession, manifest: DataFrame, steps: Iterable, output_dir: str, ledger_dir: str,
                     inputs: Inputs | None = None, batch: int = 64) -> DataFrame:
    """Process every input of ``manifest`` (path, obs_id) that the ledger doesn't call committed; the latest states.

    A wrong step list, and ids or paths that repeat, are errors of the run, raised before anything is written. Observations
    being written replace their own output folder; ``overwrite`` of ``msout`` plays no part.
    """
    if batch < 1:
        raise ValueError(f"batch must be at least 1, got {batch!r}")
    listed = normalise_steps(steps)
    column = dict(listed).get("msin", {}).get("datacolumn", "DATA")
    column = DATA_COLUMNS.get(column.upper(), column.lower())
    listed = [(n, p) for n, p in listed if n != "msout"] + [("msout", {"overwrite": True})]
    manifest = manifest.select("path", F.col("obs_id").cast("bigint").alias("obs_id"))
    for key in ("obs_id", "path"):
        twice = manifest.groupBy(key).count().filter("count > 1").limit(20).collect()
        if twice:
            raise ValueError(f"inputs with the same {key}: {sorted(str(r[key]) for r in twice)}")
    ledger = _Writer(spark, ledger_dir)

    def fail(obs: tuple, error: Exception) -> None:
        if spark.sparkContext._jsc.sc().isStopped():  # not the observation's fault
            raise error
        ledger.record([(*obs, "failed", None, f"{type(error).__name__}: {error}"[:ERROR_CHARS])])

    def attempt(group: list[tuple]) -> None:
        pairs = spark.createDataFrame([(p, o) for o, p in group], "path string, obs_id bigint")
        try:
            run_pipeline(spark, [p for _, p in group], listed, output_dir, inputs, pairs)
            written = dict.fromkeys((o for o, _ in group), 0)
            written.update(_rows_written(spark, output_dir, [o for o, _ in group]))
        except Exception as error:  # any failure is the group's, until it is one observation's
            if len(group) == 1:
                fail(group[0], error)
                return
            half = len(group) // 2
            attempt(group[:half])
            attempt(group[half:])
            return
        ledger.record((o, p, "committed", written[o], None) for o, p in group)

    def start(group: list[tuple]) -> None:
        ledger.record((o, p, "staged", None, None) for o, p in group)
        readable = []
        for obs, error in zip(group, pool.map(lambda obs: _input_error(spark, obs[1], column), group)):
            if error is None:
                readable.append(obs)
            else:  # recorded, the others go on
                fail(obs, error)
        if readable:
            attempt(readable)

    committed = latest_states(read_ledger(spark, ledger_dir)).filter("state = 'committed'").select("obs_id", "path")
    todo = manifest.join(committed, ["obs_id", "path"], "left_anti").select("obs_id", "path").orderBy("obs_id")
    group: list[tuple] = []
    with ThreadPoolExecutor(CHECKS_AT_ONCE) as pool:
        for r in todo.toLocalIterator():
            group.append((r["obs_id"], r["path"]))
            if len(group) == batch:
                start(group)
                group = []
        if group:
            start(group)
    return latest_states(read_ledger(spark, ledger_dir))
