"""The registered query of the ledger: two runs over all observations, one of them bad in the first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import visibilities as VI
from . import oracle as O
from .ledger import read_ledger, run_observations
from .queries import _vis, register


@register("observation_ledger", O.with_vis("""late AS (SELECT max(obs_id) AS bad FROM vis),
ob AS (SELECT obs_id, count(DISTINCT (floor((slot - first_slot)/4e0), ant1, ant2)) AS n_rows FROM
  (SELECT v.*, min(slot) OVER (PARTITION BY obs_id) AS first_slot FROM vis v) GROUP BY obs_id)""") + """
SELECT obs_id, 1 AS run, 'staged' AS state, CAST(0 AS BIGINT) AS n_rows FROM ob
UNION ALL SELECT obs_id, 1, CASE WHEN obs_id = bad THEN 'failed' ELSE 'committed' END, CASE WHEN obs_id = bad THEN 0 ELSE n_rows END FROM ob, late
UNION ALL SELECT obs_id, 2, 'staged', 0 FROM ob, late WHERE obs_id = bad
UNION ALL SELECT obs_id, 2, 'committed', n_rows FROM ob, late WHERE obs_id = bad""")
def q_observation_ledger(spark, sf_dir):
    """Average every observation; the last one has no data column at first and is put right before the second run.

    States that write nothing count 0 rows."""
    root = scratch_path(spark, "ledger")
    rows = VI.channels_to_rows(VI.order_output(_vis(spark, sf_dir)))
    rows.write.partitionBy("obs_id").parquet(f"{root}/in")
    found = spark.read.parquet(f"{root}/in")
    ids = found.select("obs_id").distinct()
    last = ids.agg(F.max("obs_id")).first()[0]
    late = found.filter(F.col("obs_id") == last).drop("obs_id")
    late.drop("data").write.parquet(f"{root}/late")
    folder = F.when(F.col("obs_id") == last, F.lit(f"{root}/late")).otherwise(F.concat(F.lit(f"{root}/in/obs_id="), F.col("obs_id").cast("string")))
    manifest = ids.select(folder.alias("path"), "obs_id")
    steps = [{"averager": {"timestep": 4, "freqstep": 2}}]
    run_observations(spark, manifest, steps, f"{root}/out", f"{root}/states")
    late.write.mode("overwrite").parquet(f"{root}/late")
    run_observations(spark, manifest, steps, f"{root}/out", f"{root}/states")
    return read_ledger(spark, f"{root}/states").select(F.col("obs_id").cast("bigint"), "run", "state", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
