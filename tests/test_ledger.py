"""Isolation of bad observations and restart after them."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from visfold.plans import ledger as L
from visfold.plans import preprocess as PP
from visfold.sources import visibilities as VI

STEPS = [{"averager": {"timestep": 2, "freqstep": 2}}]


@pytest.fixture()
def inputs(spark, vis, tmp_path):
    """Four observations of their own folders, and their manifest."""
    one = vis.filter("obs_id = 0")
    for k in range(4):
        VI.channels_to_rows(one.withColumn("u", F.col("u") + k)).drop("obs_id").coalesce(1).write.parquet(f"{tmp_path}/in/o{k}")
    manifest = spark.createDataFrame([(f"{tmp_path}/in/o{k}", 10 + k) for k in range(4)], "path string, obs_id bigint")
    return manifest, str(tmp_path)


def damage(path, footer):
    file, = glob.glob(f"{path}/*.parquet")
    whole = open(file, "rb").read()
    # the checksum beside the file would tell too, but an object store keeps none
    for crc in glob.glob(f"{path}/.*.crc"):
        os.remove(crc)
    spoilt = whole[:-20] + b"x" * 20 if footer else whole[:4] + b"\xff" * (len(whole) * 2 // 3) + whole[4 + len(whole) * 2 // 3:]
    open(file, "wb").write(spoilt)
    return file, whole


def states(df):
    return {r["obs_id"]: (r["run"], r["state"]) for r in df.collect()}


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("footer", [True, False])
def test_one_bad_input_stops_no_other(spark, inputs, footer):
    manifest, root = inputs
    file, whole = damage(f"{root}/in/o2", footer)
    got = L.run_observations(spark, manifest, STEPS, f"{root}/out", f"{root}/ledger")
    assert states(got) == {10: (1, "committed"), 11: (1, "committed"), 12: (1, "failed"), 13: (1, "committed")}
    assert got.filter("obs_id = 12").first()["error"] and got.filter("obs_id <> 12 AND (error IS NOT NULL OR n_rows = 0)").count() == 0
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/out").select("obs_id").distinct().collect()) == [10, 11, 13]

    before = {f: open(f, "rb").read() for f in glob.glob(f"{root}/out/obs_id=*/*.parquet")}
    open(file, "wb").write(whole)
    again = L.run_observations(spark, manifest, STEPS, f"{root}/out", f"{root}/ledger")
    assert states(again) == {10: (1, "committed"), 11: (1, "committed"), 12: (2, "committed"), 13: (1, "committed")}
    assert {r["obs_id"] for r in L.read_ledger(spark, f"{root}/ledger").filter("run = 2").collect()} == {12}
    assert all(open(f, "rb").read() == b for f, b in before.items())

    paths = [r["path"] for r in manifest.collect()]
    PP.run_pipeline(spark, paths, STEPS, f"{root}/whole", manifest=manifest)
    assert rows_of(VI.scan_visibilities(spark, f"{root}/out")) == rows_of(VI.scan_visibilities(spark, f"{root}/whole"))
    L.run_observations(spark, manifest, STEPS, f"{root}/out", f"{root}/ledger")
    assert L.read_ledger(spark, f"{root}/ledger").filter("run = 3").count() == 0


def test_missing_folders_and_columns(spark, inputs):
    manifest, root = inputs
    spark.read.parquet(f"{root}/in/o0").drop("data").write.parquet(f"{root}/in/bare")
    more = manifest.unionByName(spark.createDataFrame([(f"{root}/in/none", 20), (f"{root}/in/bare", 21)], "path string, obs_id bigint"))
    got = L.run_observations(spark, more, [*STEPS, {"msout": {"overwrite": False}}], f"{root}/out", f"{root}/ledger", batch=4)
    assert {k for k, (_, s) in states(got).items() if s == "failed"} == {20, 21}
    assert "data" in got.filter("obs_id = 21").first()["error"]


def test_work_without_a_ledger_entry_is_done_again(spark, inputs):
    manifest, root = inputs
    PP.run_pipeline(spark, [f"{root}/in/o1"], STEPS, f"{root}/out", manifest=manifest.filter("obs_id = 11"))
    got = L.run_observations(spark, manifest.filter("obs_id = 11"), STEPS, f"{root}/out", f"{root}/ledger")
    assert states(got) == {11: (1, "committed")}
    assert got.first()["n_rows"] == spark.read.parquet(f"{root}/out").count()


def test_a_batch_reads_only_its_own_output(spark, inputs):
    """Another observation's spoilt output is nothing to this batch, and folders that aren't there count no rows."""
    manifest, root = inputs
    L.run_observations(spark, manifest.filter("obs_id < 12"), STEPS, f"{root}/out", f"{root}/ledger")
    n = spark.read.parquet(f"{root}/out").filter("obs_id = 11").count()
    for file in glob.glob(f"{root}/out/obs_id=10/*.parquet"):
        open(file, "wb").write(b"spoilt")
    assert L._rows_written(spark, f"{root}/out", [11, 99]) == {11: n}
    assert L._rows_written(spark, f"{root}/out", [99]) == {}


def test_errors_of_the_run(spark, inputs):
    manifest, root = inputs
    with pytest.raises(ValueError, match="same obs_id"):
        L.run_observations(spark, manifest.withColumn("obs_id", F.lit(1)), STEPS, f"{root}/out", f"{root}/ledger")
    with pytest.raises(ValueError, match="unknown step"):
        L.run_observations(spark, manifest, [{"zap": {}}], f"{root}/out", f"{root}/ledger")
    assert not glob.glob(f"{root}/ledger")
