"""Averaging: unusable samples, first slots and repeated averaging."""

import math

from pyspark.sql import functions as F

from visfold.operators import averaging as A
from visfold.plans import preprocess as PP
from visfold.sources import visibilities as VI


def test_samples_that_are_not_finite_are_left_out(vis):
    odd = (F.col("slot") % 4 == 1) & (F.col("obs_id") == 0)
    bad = F.when(F.col("chan") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    spoilt = vis.withColumn("data", F.when(odd, F.col("data").withField("xx.re", bad)).otherwise(F.col("data")))
    marked = vis.withColumn("flag", F.when(odd, F.col("flag").withField("xx", F.lit(True))).otherwise(F.col("flag")))
    keys = ["obs_id", "slot", "ant1", "ant2", "chan"]
    a, b = ({tuple(r[k] for k in keys): r for r in A.average(v, 4, 2).collect()} for v in (spoilt, marked))
    assert a.keys() == b.keys()
    for k, r in a.items():
        assert r["flag"] == b[k]["flag"]
        if not r["flag"]["xx"]:
            assert r["data"] == b[k]["data"] and r["weight"] == b[k]["weight"] and math.isfinite(r["data"]["xx"]["re"])


def test_repeated_averaging_in_a_pipeline(spark, vis, tmp_path):
    late = vis.withColumn("slot", F.col("slot") + 7)  # first slots that no step divides
    VI.write_visibilities(late, f"{tmp_path}/in")
    steps = [{"averager": {"timestep": 2}}, {"averager": {"timestep": 3, "freqstep": 2}}]
    inputs = PP.Inputs()
    PP.run_pipeline(spark, f"{tmp_path}/in", steps, f"{tmp_path}/out", inputs)
    assert inputs.first_slots is None and inputs.gains_dir is None
    want = A.average(A.average(late, 2, 1), 3, 2)
    meta = late.groupBy("obs_id").agg(F.min("slot").alias("first_slot"))
    for got in (VI.scan_visibilities(spark, f"{tmp_path}/out"), PP.preprocess(late, steps, PP.Inputs(obs_meta=meta))):
        assert all(r.all_close for r in A.vis_allclose(want, got).collect())
