"""Step lists, inputs, sinks and the sky-model reader."""

import os

import pytest
from pyspark.sql import functions as F

from visfold.operators import averaging as A
from visfold.plans import preprocess as PP
from visfold.session import scratch_path
from visfold.sources import skymodel as SM
from visfold.sources import testviews as TV
from visfold.sources import visibilities as VI


@pytest.mark.parametrize("steps", [
    [{"nosuchstep": {}}],
    [{"msin": {}}, {"msin": {}}],
    [{"averager": {}}, {"msin": {}}],
    [{"msout": {}}, {"averager": {}}],
    [{"demixer": {"skymodel": "s"}}, {"demixer": {"skymodel": "s"}}],
    [{"averager": {}, "preflagger": {}}],
])
def test_invalid_step_lists(steps):
    with pytest.raises(ValueError):
        PP.normalise_steps(steps)


@pytest.mark.parametrize("step", [
    {"averager": {"timestep": 2.9}}, {"averager": {"timestep": 0}}, {"averager": {"timestep": True}}, {"averager": {"timesteps": 2}},
    {"preflagger": {"baseline": "*"}}, {"preflagger": {"freqrange": 3}}, {"msin": {"name": "x"}}, {"msin": {"datacolumn": 1}},
    {"msout": {"overwrite": "yes"}}, {"aoflagger": {"strategy": "x"}}, {"applycal": {}}, {"demixer": {}}, {"demixer": {"skymodel": "s", "solint_t": "4"}},
])
def test_unknown_or_mistyped_parameters(step):
    with pytest.raises(ValueError):
        PP.normalise_steps([step])


def test_data_column_is_honoured(vis):
    with pytest.raises(ValueError, match="NO_SUCH"):
        PP.preprocess(vis, [{"msin": {"datacolumn": "NO_SUCH"}}])
    both = vis.withColumn("corrected_data", F.col("data")).withColumn("data", F.lit(None).cast(vis.schema["data"].dataType))
    out = PP.preprocess(both, [{"MsIn": {"DataColumn": "CORRECTED_DATA"}}]).select(vis.columns)
    assert all(r.all_close for r in A.vis_allclose(vis, out).collect())


def test_antenna_names_in_the_pipeline(vis):
    from visfold.operators import flagging as FL

    ant = TV.antenna_table(vis)
    got = PP.preprocess(vis, [{"preflagger": {"antennas": ["ant2", 0]}}], PP.Inputs(antenna=ant)).filter("flag.xx").count()
    assert got == FL.flag_antennas(vis, ["ant2", 0], antenna_table=ant).filter("flag.xx").count() > vis.filter("flag.xx").count()
    with pytest.raises(ValueError, match="antenna table"):
        PP.preprocess(vis, [{"preflagger": {"antennas": ["ant2"]}}])


def test_solutions_are_validated_before_they_are_applied(vis):
    ant, sol = TV.antenna_table(vis), TV.solution_fixture(vis, "scalar")
    for bad in (sol.withColumn("soltype", F.lit("zzz")), sol.filter(~((F.col("soltype") == "amplitude") & (F.col("ant") == "ant3"))).filter("pos[0] > 0 OR ant <> 'ant1'"),
                sol.filter("ant <> 'ant3'")):
        with pytest.raises(ValueError):
            PP.preprocess(vis, [{"applycal": {"parmdb": "x"}}], PP.Inputs(solutions={"x": bad}, antenna=ant))
    with pytest.raises(ValueError, match="no solution set named"):
        PP.preprocess(vis, [{"applycal": {"parmdb": "y"}}], PP.Inputs(solutions={"x": sol}, antenna=ant))


def test_manifest_with_odd_folder_names(spark, vis, tmp_path):
    folders = [f"{tmp_path}/with space", f"{tmp_path}/a+b%20c"]
    one = vis.filter("obs_id = 0")
    for f in folders:
        VI.channels_to_rows(one).drop("obs_id").write.parquet(f)
    manifest = spark.createDataFrame([(f, k) for k, f in enumerate(folders)], "path string, obs_id bigint")
    back = VI.scan_visibilities(spark, folders, manifest=manifest)
    assert {(r["obs_id"], r["count"]) for r in back.groupBy("obs_id").count().collect()} == {(0, one.count()), (1, one.count())}
    with pytest.raises(Exception, match="no manifest entry"):
        VI.scan_visibilities(spark, folders, manifest=manifest.limit(1)).count()


def test_gains_of_other_observations_stay(spark, vis):
    two = vis.filter("obs_id = 0").unionByName(vis.filter("obs_id = 0").withColumn("obs_id", F.lit(1).cast("bigint")))
    folder = scratch_path(spark, "kept-gains")
    for part in (two, two.filter("obs_id = 1")):
        inputs = PP.Inputs(sky_models={"s": TV.sky_components(spark)}, gains_dir=folder)
        PP.preprocess(part, [{"demixer": {"skymodel": "s", "method": "scalar"}}], inputs)
    assert {r[0] for r in spark.read.parquet(f"{folder}/{PP.DEFAULT_GAINS}").select("obs_id").distinct().collect()} == {0, 1}


def test_rows_are_written_in_order(spark, vis):
    path = scratch_path(spark, "ordered")
    VI.write_visibilities(vis, path)
    rows = spark.read.parquet(path).select("slot", "ant1", "ant2", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    for _, part in rows.toPandas().groupby("f"):
        keys = list(part.sort_values("i")[["slot", "ant1", "ant2"]].itertuples(index=False, name=None))
        assert keys == sorted(keys)


def test_no_shared_folder_on_a_cluster_is_an_error():
    from visfold import session

    class Unset:
        get = staticmethod(lambda key, default=None: default)

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(lambda: Unset)
        conf = Unset
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster)


def test_names_are_case_insensitive_and_steps_repeat():
    names = [n for n, _ in PP.normalise_steps([{"MsIn": {}}, {"PreFlagger": {}}, {"PreFlagger": {}}, {"MsOut": {}}])]
    assert names == ["msin", "preflagger", "preflagger", "msout"]


def test_empty_step_list_is_a_copy(vis):
    out = PP.preprocess(vis, [])
    assert all(r.all_close for r in A.vis_allclose(vis, out).collect())


def test_full_pipeline_runs_and_writes(spark, vis):
    inputs = PP.Inputs(solutions={"diagonal.h5": TV.solution_fixture(vis, "diagonal")},
                       sky_models={"sky_model.txt": TV.sky_components(spark)}, antenna=TV.antenna_table(vis))
    steps = [{"MsIn": {}}, {"PreFlagger": {}},
             {"Demixer": {"skymodel": "sky_model.txt", "subtractsources": ["bright_a", "bright_b"]}},
             {"AOFlagger": {"memorymax": 8.0}}, {"ApplyCal": {"parmdb": "diagonal.h5"}},
             {"Averager": {"timestep": 4, "freqstep": 4}}, {"MsOut": {"overwrite": True}}]
    path = scratch_path(spark, "pipeline-out")
    inputs.gains_dir = f"{path}-gains"
    out = PP.preprocess(vis, steps, inputs)
    VI.write_visibilities(out, path)
    back = VI.scan_visibilities(spark, path)
    assert back.count() == out.count() > 0
    assert "demixer" in inputs.gains


def test_overwrite_keeps_other_observations(spark, vis):
    path = scratch_path(spark, "overwrite")
    VI.write_visibilities(vis, path)
    VI.write_visibilities(vis.filter(F.col("obs_id") == 0), path, overwrite=True)
    assert VI.scan_visibilities(spark, path).count() == vis.count()
    with pytest.raises(Exception):
        VI.write_visibilities(vis, path, overwrite=False)


def test_duplicate_stems_raise(spark):
    paths = spark.createDataFrame([("/x/dir1/data.ms",), ("/x/dir2/data.ms",), ("/x/a.ms",), ("/x/a.MS",),
                                   ("/x/b.ms",)], "path string")
    m = VI.input_manifest(paths)
    dup = sorted(r.path for r in VI.duplicate_inputs(m).collect())
    assert dup == ["/x/a.MS", "/x/a.ms", "/x/dir1/data.ms", "/x/dir2/data.ms"]
    with pytest.raises(ValueError, match="share an output name"):
        VI.assert_no_duplicate_inputs(m)


def test_stem_rules(spark):
    paths = spark.createDataFrame([("/d/a.tar.gz",), ("/d/.hidden",), ("/d/noext",), ("/d/x.ms/",)], "path string")
    got = {r.path: r.stem for r in VI.input_manifest(paths).collect()}
    assert got == {"/d/a.tar.gz": "a.tar", "/d/.hidden": ".hidden", "/d/noext": "noext", "/d/x.ms/": "x"}


SKY_TEXT = """FORMAT = Name, Type, Patch, Ra, Dec, I, SpectralIndex, LogarithmicSI, ReferenceFrequency, MajorAxis, MinorAxis, Orientation

, , bright_a, 41.25deg, -31.75deg
, , bright_b, 43.5deg, -29.5deg

point_a, POINT, bright_a, 41.25deg, -31.75deg, 1.0, [0.0], true, 1.2e9
point_b, POINT, bright_b, 43.5deg, -29.5deg, 1.0, [0.0], true, 1.2e9
gauss_c, GAUSSIAN, bright_b, 03:32:10.5, -27.35.20.5, 0.5, [-0.7, 0.1], false, 1.4e8, 60.0, 30.0, 45.0
"""


def test_sky_model_file(spark, tmp_path):
    path = os.path.join(tmp_path, "sky_model.txt")
    with open(path, "w") as fh:
        fh.write(SKY_TEXT)
    patches, comps = SM.scan_sky_model(spark, path)
    p = {r.patch: (r.ra, r.dec) for r in patches.collect()}
    assert set(p) == {"bright_a", "bright_b"}
    assert p["bright_a"][0] == pytest.approx(math_radians(41.25), abs=1e-12)
    c = {r.name: r for r in comps.collect()}
    assert c["point_a"].si == [0.0] and c["point_a"].log_si and c["point_a"].major is None
    g = c["gauss_c"]
    assert g.type == "GAUSSIAN" and g.si == [-0.7, 0.1] and not g.log_si and g.major == 60.0
    assert g.ra == pytest.approx(math_radians((3 + 32 / 60 + 10.5 / 3600) * 15), abs=1e-12)
    assert g.dec == pytest.approx(-math_radians(27 + 35 / 60 + 20.5 / 3600), abs=1e-12)
    assert SM.select_patches(patches, ["bright_b"]).count() == 1
    with pytest.raises(ValueError, match="unknown patches"):
        SM.select_patches(patches, ["bright_z"])
    assert SM.patch_components(patches, comps).count() == 3


def math_radians(x):
    import math
    return math.radians(x)


def test_row_local_steps_on_a_stream(spark, vis):
    from visfold.streaming.rowlocal import preprocess_stream
    path = scratch_path(spark, "stream-in")
    VI.write_visibilities(vis, path)
    rows = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    stream = VI.rows_to_channels(rows)
    inputs = PP.Inputs(solutions={"cal": TV.solution_fixture(vis, "scalar")}, antenna=TV.antenna_table(vis))
    out = preprocess_stream(stream, [{"preflagger": {"chan": "[0]"}}, {"applycal": {"parmdb": "cal"}}], inputs)
    q = out.writeStream.format("memory").queryName("rowlocal_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM rowlocal_out")
    assert got.count() == vis.count()
    assert got.filter((F.col("chan") == 0) & ~F.col("flag.xx")).count() == 0
    with pytest.raises(ValueError):
        preprocess_stream(stream, [{"averager": {"timestep": 2}}])
