"""Visibility fixtures derived from the driver's ``events`` table.

``event_id`` is dense from 0, so it indexes a grid: 4 channels x 10 baselines
(4 antennas with autos) x slots, 100 slots per observation. Every fixture
here is computed by Spark from the given tables, so its work grows with them;
``VIS_CTE`` is the same derivation as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cplx as C
from ..functions.compare import qround

POLS = C.POLS

# Fixed values of the fixture grid.
N_ANT = 4
N_CHAN = 4
N_BL = 10
SLOTS_PER_OBS = 100
ANT1_OF_BL = (0, 0, 0, 0, 1, 1, 1, 2, 2, 3)
ANT2_OF_BL = (0, 1, 2, 3, 1, 2, 3, 2, 3, 3)

VIS_CTE = """bl(bl, ant1, ant2) AS (VALUES (0,0,0),(1,0,1),(2,0,2),(3,0,3),(4,1,1),(5,1,2),(6,1,3),(7,2,2),(8,2,3),(9,3,3)),
g AS (SELECT *, CAST(floor(event_id/4e3) AS BIGINT) AS obs_id, CAST(floor(event_id/4e1) AS BIGINT) AS slot,
             CAST(CAST(floor(event_id/4e0) AS BIGINT) % 10 AS INT) AS bl, CAST(event_id % 4 AS INT) AS chan FROM events),
vis AS (SELECT g.obs_id, g.slot, 17e8 + 8e0*g.slot AS time, b.ant1, b.ant2, g.chan, 96e7 + 1e6*g.chan AS freq,
  1e2*(b.ant2-b.ant1) + 1e-1*g.slot AS u, 4e1*(b.ant2*b.ant2-b.ant1*b.ant1) - 1e-1*g.slot AS v, 5e0*(b.ant2-b.ant1) AS w,
  1e0 + (g.event_id % 3) AS weight,
  g.value*cos(1e-1*g.user_id) AS xx_re, g.value*sin(1e-1*g.user_id) AS xx_im,
  1e-1*g.value AS xy_re, -5e-2*g.value AS xy_im, 1e-1*g.value AS yx_re, 5e-2*g.value AS yx_im,
  9e-1*g.value*cos(1e-1*g.user_id) AS yy_re, 9e-1*g.value*sin(1e-1*g.user_id) AS yy_im,
  (g.event_type = 'error') AS flag
  FROM g JOIN bl b ON g.bl = b.bl)"""


#: A quiet background with interference: amplitudes of 10 and noise (two digits-of-the-value numbers, about
#: triangular) by event, and bursts of one sample, a few slots, a channel of a baseline, and a slot of all channels.
BURSTS_SQL = """(1e1 + (value*129.898e0 - floor(value*129.898e0)) + (value*782.33e0 - floor(value*782.33e0))
  + CASE WHEN (event_id % 40) BETWEEN 4 AND 7 AND event_id % 4 = 2 THEN 8e0 ELSE 0e0 END
  + CASE WHEN (event_id % 40) BETWEEN 8 AND 15 AND CAST(floor(event_id/4e1) AS BIGINT) % 100 = 50 THEN 8e0 ELSE 0e0 END
  + CASE WHEN (event_id % 40) = 17 AND CAST(floor(event_id/4e1) AS BIGINT) % 100 BETWEEN 20 AND 23 THEN 6e0 ELSE 0e0 END
  + CASE WHEN (event_id % 40) = 23 AND CAST(floor(event_id/4e1) AS BIGINT) % 100 BETWEEN 60 AND 75 THEN 4e0 ELSE 0e0 END
  + CASE WHEN event_id % 97 = 0 THEN 1.2e1 ELSE 0e0 END)"""
BURSTS_CTE = VIS_CTE.replace("SELECT *, CAST(floor(event_id/4e3)", f"SELECT * REPLACE ({BURSTS_SQL} AS value), CAST(floor(event_id/4e3)", 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vis_flat_from_events(events: DataFrame) -> DataFrame:
    """Flat visibility rows (pol columns ``xx_re .. yy_im``, one ``flag``)."""
    e = events.select("event_id", "user_id", "value", "event_type")
    eid = F.col("event_id")
    g = e.select(
        "*",
        F.floor(eid / F.lit(4e3)).cast("bigint").alias("obs_id"),
        F.floor(eid / F.lit(4e1)).cast("bigint").alias("slot"),
        (F.floor(eid / F.lit(4e0)).cast("bigint") % 10).cast("int").alias("bl"),
        (eid % 4).cast("int").alias("chan"),
    )
    a1 = F.element_at(F.array(*[F.lit(x) for x in ANT1_OF_BL]), F.col("bl") + 1)
    a2 = F.element_at(F.array(*[F.lit(x) for x in ANT2_OF_BL]), F.col("bl") + 1)
    g = g.withColumn("ant1", a1).withColumn("ant2", a2)
    val, ph = F.col("value"), F.lit(1e-1) * F.col("user_id")
    da, aa = F.col("ant2") - F.col("ant1"), F.col("ant2") * F.col("ant2") - F.col("ant1") * F.col("ant1")
    return g.select(
        "obs_id", "slot",
        (F.lit(17e8) + F.lit(8e0) * F.col("slot")).alias("time"),
        "ant1", "ant2", "chan",
        (F.lit(96e7) + F.lit(1e6) * F.col("chan")).alias("freq"),
        (F.lit(1e2) * da + F.lit(1e-1) * F.col("slot")).alias("u"),
        (F.lit(4e1) * aa - F.lit(1e-1) * F.col("slot")).alias("v"),
        (F.lit(5e0) * da).alias("w"),
        (F.lit(1e0) + (eid % 3)).alias("weight"),
        (val * F.cos(ph)).alias("xx_re"), (val * F.sin(ph)).alias("xx_im"),
        (F.lit(1e-1) * val).alias("xy_re"), (F.lit(-5e-2) * val).alias("xy_im"),
        (F.lit(1e-1) * val).alias("yx_re"), (F.lit(5e-2) * val).alias("yx_im"),
        (F.lit(9e-1) * val * F.cos(ph)).alias("yy_re"), (F.lit(9e-1) * val * F.sin(ph)).alias("yy_im"),
        (F.col("event_type") == F.lit("error")).alias("flag"),
    )


def to_struct_vis(flat: DataFrame) -> DataFrame:
    """Wrap flat pol columns into the canonical ``data`` / ``flag`` structs."""
    data = F.struct(*[C.cpx(F.col(f"{p}_re"), F.col(f"{p}_im")).alias(p) for p in POLS])
    flag_src = F.col("flag")
    flag = F.struct(*[flag_src.alias(p) for p in POLS])
    return flat.select("obs_id", "slot", "time", "ant1", "ant2", "chan", "freq", "u", "v", "w",
                       "weight", data.alias("data"), flag.alias("flag"))


def load_vis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical ``vis`` DataFrame derived from ``events``."""
    return to_struct_vis(vis_flat_from_events(read_table(spark, sf_dir, "events")))


def load_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vis`` with a quiet background and interference, derived from ``events``."""
    return to_struct_vis(vis_flat_from_events(read_table(spark, sf_dir, "events").withColumn("value", F.expr(BURSTS_SQL))))


def flatten(vis: DataFrame, digits: int | None = 6, keep=("obs_id", "slot", "ant1", "ant2", "chan"),
            extra=("time", "freq", "u", "v", "w", "weight")) -> DataFrame:
    """Flatten ``data``/``flag`` structs to scalar columns for comparison."""
    def r(c):
        return qround(c, digits) if digits is not None else c
    cols = [F.col(k) for k in keep] + [r(F.col(x)).alias(x) for x in extra]
    for p in POLS:
        d = F.col("data").getField(p)
        cols += [r(d.getField("re")).alias(f"{p}_re"), r(d.getField("im")).alias(f"{p}_im")]
    cols += [F.col("flag").getField(p).alias(f"flag_{p}") for p in POLS]
    return vis.select(*cols)


def antenna_table(vis: DataFrame) -> DataFrame:
    """(obs_id, ant, name) for every observation in ``vis``: ``ant<k>`` names."""
    obs = vis.select("obs_id").distinct()
    return (obs.select("obs_id", F.explode(F.sequence(F.lit(0), F.lit(N_ANT - 1))).alias("ant"))
            .select("obs_id", F.col("ant").cast("int").alias("ant"),
                    F.concat(F.lit("ant"), F.col("ant").cast("string")).alias("name")))


ANTENNA_SQL = """antenna AS (SELECT o.obs_id, a.ant, a.name FROM (SELECT DISTINCT obs_id FROM vis) o,
  (VALUES (0,'ant0'),(1,'ant1'),(2,'ant2'),(3,'ant3')) a(ant, name))"""


# Fixed values of the solution fixtures: one solution every 25 slots.
SOL_EVERY = 25
SOL_FREQS = (960.25e6, 962.25e6)
POLS_OF_KIND = {"scalar": (), "diagonal": ("XX", "YY"), "fulljones": ("XX", "XY", "YX", "YY")}


def solution_fixture(vis: DataFrame, kind: str = "scalar", with_freq: bool = False,
                     identity: bool = False, soltypes=("amplitude", "phase")) -> DataFrame:
    """Long-form solution cells derived from the slots of ``vis``.

    amplitude = (1 + 1e-2 ant + 1e-4 slot) [x 0.9 for YY, x (1 + 5e-2 f) with a freq axis],
    1e-2 for XY/YX; phase = 1e-1 ant (0 for XY/YX); tec = 1e-2 ant.
    ``identity``: no time axis, amplitude 1 (0 off-diagonal), phase 0.
    """
    pols = POLS_OF_KIND[kind]
    names = F.array(*[F.lit(f"ant{k}") for k in range(N_ANT)])
    if identity:
        base = (vis.select("obs_id").distinct().select(F.posexplode(names).alias("aidx", "ant"))
                .distinct().select("aidx", "ant", F.lit(None).cast("bigint").alias("slot")))
        axes = ["ant"]
    else:
        base = (vis.select("slot").distinct().filter(F.col("slot") % SOL_EVERY == 0)
                .select("slot", (F.lit(17e8) + F.lit(8e0) * F.col("slot")).alias("time"),
                        F.floor(F.col("slot") / F.lit(float(SOL_EVERY))).cast("int").alias("tidx"),
                        F.posexplode(names).alias("aidx", "ant")))
        axes = ["time"]
        if with_freq:
            base = base.select("*", F.posexplode(F.array(*[F.lit(f) for f in SOL_FREQS])).alias("fidx", "freq"))
            axes.append("freq")
        axes.append("ant")
    if pols:
        base = base.select("*", F.posexplode(F.array(*[F.lit(p) for p in pols])).alias("pidx", "pol"))
        axes.append("pol")
    pol = F.col("pol") if pols else F.lit(None).cast("string")
    off = pol.isin("XY", "YX") if pols else F.lit(False)
    if identity:
        amp = F.when(off, F.lit(0e0)).otherwise(F.lit(1e0))
        ph = F.lit(0e0)
        tec = F.lit(0e0)
    else:
        amp = F.lit(1e0) + F.lit(1e-2) * F.col("aidx") + F.lit(1e-4) * F.col("slot")
        if with_freq:
            amp = amp * (F.lit(1e0) + F.lit(5e-2) * F.col("fidx"))
        amp = F.when(off, F.lit(1e-2)).when(pol == "YY", amp * F.lit(9e-1)).otherwise(amp)
        ph = F.when(off, F.lit(0e0)).otherwise(F.lit(1e-1) * F.col("aidx"))
        tec = F.lit(1e-2) * F.col("aidx")
    vals = {"amplitude": amp, "phase": ph, "tec": tec}
    parts = F.array(*[F.struct(F.lit(t).alias("soltype"), vals[t].cast("double").alias("val")) for t in soltypes])
    idx_of = {"time": F.col("tidx"), "freq": F.col("fidx"), "ant": F.col("aidx"), "pol": F.col("pidx")}
    e = base.select("*", F.explode(parts).alias("_s"))
    return e.select(
        F.lit("sol000").alias("solset"), F.concat(F.col("_s.soltype"), F.lit("000")).alias("soltab"),
        F.col("_s.soltype").alias("soltype"), F.array(*[F.lit(a) for a in axes]).alias("axes"),
        F.array(*[idx_of[a].cast("int") for a in axes]).alias("pos"),
        (F.col("time") if "time" in axes else F.lit(None)).cast("double").alias("time"),
        (F.col("freq") if "freq" in axes else F.lit(None)).cast("double").alias("freq"),
        F.col("ant").cast("string").alias("ant"), pol.alias("pol"), F.lit(None).cast("string").alias("dir"),
        F.col("_s.val").alias("val"), F.lit(1.0).cast("float").alias("weight"))


def solution_fixture_sql(kind: str = "scalar", with_freq: bool = False, identity: bool = False,
                         soltypes=("amplitude", "phase"), name: str = "sol") -> str:
    """The same fixture as SQL text (CTE ``name``), for the oracle."""
    pols = POLS_OF_KIND[kind]
    ants = "(VALUES " + ", ".join(f"({k}, 'ant{k}')" for k in range(N_ANT)) + ") a(aidx, ant)"
    src = [ants]
    cols = ["a.aidx", "a.ant"]
    if identity:
        cols += ["CAST(NULL AS BIGINT) AS slot", "CAST(NULL AS DOUBLE) AS time"]
    else:
        src.insert(0, f"(SELECT DISTINCT slot FROM vis WHERE slot % {SOL_EVERY} = 0) s")
        cols += ["s.slot", "17e8 + 8e0*s.slot AS time", f"CAST(floor(s.slot/{SOL_EVERY}e0) AS INT) AS tidx"]
    if with_freq and not identity:
        src.append("(VALUES " + ", ".join(f"({i}, CAST({f!r} AS DOUBLE))" for i, f in enumerate(SOL_FREQS)) + ") f(fidx, freq)")
        cols += ["f.fidx", "f.freq"]
    else:
        cols += ["CAST(NULL AS DOUBLE) AS freq"]
    if pols:
        src.append("(VALUES " + ", ".join(f"({i}, '{p}')" for i, p in enumerate(pols)) + ") p(pidx, pol)")
        cols += ["p.pidx", "p.pol"]
    else:
        cols += ["CAST(NULL AS VARCHAR) AS pol"]
    types = "(VALUES " + ", ".join(f"('{t}')" for t in soltypes) + ") t(soltype)"
    src.append(types)
    cols.append("t.soltype")
    base = f"(SELECT {', '.join(cols)} FROM {', '.join(src)})"
    off = "pol IN ('XY','YX')" if pols else "false"
    if identity:
        amp, ph, tec = f"CASE WHEN {off} THEN 0e0 ELSE 1e0 END", "0e0", "0e0"
    else:
        a = "(1e0 + 1e-2*aidx + 1e-4*slot)"
        if with_freq:
            a = f"({a} * (1e0 + 5e-2*fidx))"
        amp = f"CASE WHEN {off} THEN 1e-2 WHEN pol = 'YY' THEN {a} * 9e-1 ELSE {a} END"
        ph = f"CASE WHEN {off} THEN 0e0 ELSE 1e-1*aidx END"
        tec = "1e-2*aidx"
    val = (f"CASE soltype WHEN 'amplitude' THEN {amp} WHEN 'phase' THEN {ph} ELSE {tec} END")
    axes = (["ant"] if identity else ["time"] + (["freq"] if with_freq else []) + ["ant"]) + (["pol"] if pols else [])
    idx = {"time": "tidx", "freq": "fidx", "ant": "aidx", "pol": "pidx"}
    axes_sql = "[" + ", ".join(f"'{a}'" for a in axes) + "]"
    pos_sql = "[" + ", ".join(f"CAST({idx[a]} AS INTEGER)" for a in axes) + "]"
    return (f"{name} AS (SELECT 'sol000' AS solset, soltype || '000' AS soltab, soltype, {axes_sql} AS axes, "
            f"{pos_sql} AS pos, time, freq, ant, pol, CAST(NULL AS VARCHAR) AS dir, "
            f"CAST({val} AS DOUBLE) AS val, CAST(1 AS FLOAT) AS weight FROM {base} b)")


def solution_catalog(vis: DataFrame) -> DataFrame:
    """Many solution sets in one table: valid ones and one per broken rule."""
    scalar = solution_fixture(vis, "scalar")
    diag = solution_fixture(vis, "diagonal")
    amp = F.col("soltype") == "amplitude"
    t0, t1 = F.col("time") == F.lit(17e8), F.col("time") == F.lit(17e8 + 8e0 * SOL_EVERY)
    a0, a3 = F.col("ant") == "ant0", F.col("ant") == "ant3"
    parts = {
        "scalar": scalar,
        "diagonal": diag,
        "fulljones": solution_fixture(vis, "fulljones"),
        "tec": solution_fixture(vis, "scalar", soltypes=("tec",)),
        "phase_full": solution_fixture(vis, "fulljones", soltypes=("phase",)),
        "three": solution_fixture(vis, "scalar", soltypes=("amplitude", "phase", "tec")),
        "bad_soltype": scalar.withColumn("soltype", F.when(amp, F.lit("zzz")).otherwise(F.col("soltype"))),
        "bad_axis": scalar.withColumn("axes", F.array(F.lit("time"), F.lit("zzz"))),
        "bad_pol": diag.withColumn("pol", F.when(F.col("pol") == "YY", F.lit("zzz")).otherwise(F.col("pol"))),
        "bad_vw": scalar.withColumn("weight", F.when(amp & a0, F.lit(None).cast("float"))
                                    .otherwise(F.col("weight"))),
        "bad_cells": scalar.filter(~(amp & t1 & a3)),
        "bad_1d": scalar.withColumn("time", F.when(amp & t0 & a0, F.col("time") + F.lit(1e0))
                                    .otherwise(F.col("time"))),
    }
    out = None
    for name, df in parts.items():
        df = df.withColumn("solset", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


CATALOG_SQL = ",\n".join([
    solution_fixture_sql("scalar", name="s_scalar"),
    solution_fixture_sql("diagonal", name="s_diag"),
    solution_fixture_sql("fulljones", name="s_full"),
    solution_fixture_sql("scalar", soltypes=("tec",), name="s_tec"),
    solution_fixture_sql("fulljones", soltypes=("phase",), name="s_phase_full"),
    solution_fixture_sql("scalar", soltypes=("amplitude", "phase", "tec"), name="s_three"),
    """cat AS (
  SELECT * REPLACE ('scalar' AS solset) FROM s_scalar
  UNION ALL BY NAME SELECT * REPLACE ('diagonal' AS solset) FROM s_diag
  UNION ALL BY NAME SELECT * REPLACE ('fulljones' AS solset) FROM s_full
  UNION ALL BY NAME SELECT * REPLACE ('tec' AS solset) FROM s_tec
  UNION ALL BY NAME SELECT * REPLACE ('phase_full' AS solset) FROM s_phase_full
  UNION ALL BY NAME SELECT * REPLACE ('three' AS solset) FROM s_three
  UNION ALL BY NAME SELECT * REPLACE ('bad_soltype' AS solset,
      CASE WHEN soltype = 'amplitude' THEN 'zzz' ELSE soltype END AS soltype) FROM s_scalar
  UNION ALL BY NAME SELECT * REPLACE ('bad_axis' AS solset, ['time', 'zzz'] AS axes) FROM s_scalar
  UNION ALL BY NAME SELECT * REPLACE ('bad_pol' AS solset, CASE WHEN pol = 'YY' THEN 'zzz' ELSE pol END AS pol) FROM s_diag
  UNION ALL BY NAME SELECT * REPLACE ('bad_vw' AS solset,
      CASE WHEN soltype = 'amplitude' AND ant = 'ant0' THEN CAST(NULL AS FLOAT) ELSE weight END AS weight) FROM s_scalar
  UNION ALL BY NAME SELECT * REPLACE ('bad_cells' AS solset) FROM s_scalar
      WHERE NOT (soltype = 'amplitude' AND time = 1700000200e0 AND ant = 'ant3')
  UNION ALL BY NAME SELECT * REPLACE ('bad_1d' AS solset,
      CASE WHEN soltype = 'amplitude' AND time = 17e8 AND ant = 'ant0' THEN time + 1e0 ELSE time END AS time) FROM s_scalar)""",
    """sax AS (SELECT DISTINCT solset, soltab, axes[k] AS axis, CAST(k - 1 AS INTEGER) AS axis_pos, pos[k] AS pos,
    CASE axes[k] WHEN 'time' THEN time WHEN 'freq' THEN freq END AS num_value,
    CASE axes[k] WHEN 'ant' THEN ant WHEN 'pol' THEN pol WHEN 'dir' THEN dir END AS str_value
  FROM cat, range(1, 6) r(k) WHERE k <= len(axes))""",
])


# Fixed values of the sky fixture: two point sources, direction cosines given.
SKY_COMPONENTS = (("point_a", "POINT", "bright_a", 1e-3, 2e-3, 1e0),
                  ("point_b", "POINT", "bright_b", -2e-3, 1e-3, 5e-1))
SKY_PATCHES = (("bright_a", 1e-3, 2e-3), ("bright_b", -2e-3, 1e-3))
SKY_COMP_SQL = ("sky_comp AS (SELECT * FROM (VALUES ('point_a','POINT','bright_a',1e-3,2e-3,1e0),"
                "('point_b','POINT','bright_b',-2e-3,1e-3,5e-1)) t(name, type, patch, l, m, flux_i))")


def sky_components(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SKY_COMPONENTS),
                                 "name string, type string, patch string, l double, m double, flux_i double")


SKY_HEADER = ("FORMAT = Name, Type, Patch, Ra, Dec, I, SpectralIndex, LogarithmicSI, ReferenceFrequency, "
              "MajorAxis, MinorAxis, Orientation")


def sky_text_lines(events: DataFrame) -> DataFrame:
    """Sky-model text lines derived from ``events``: one component per user,
    one patch per user_id % 10, angles in deg, rad, plain degrees and sexagesimal."""
    u = events.groupBy("user_id").agg(F.avg("value").alias("v"))
    uid = F.col("user_id")
    ra_deg = F.lit(5.2e1) + F.lit(1e-3) * uid
    dec_deg = F.lit(-2.8e1) - F.lit(5e-4) * uid
    gauss = uid % 7 == 0
    s = lambda c: c.cast("string")
    ra_txt = F.when(uid % 5 == 0, F.concat(s(F.radians(ra_deg)), F.lit("rad"))).otherwise(F.concat(s(ra_deg), F.lit("deg")))
    comp = u.select(F.concat_ws(
        ", ", F.concat(F.lit("src"), s(uid)), F.when(gauss, "GAUSSIAN").otherwise("POINT"),
        F.concat(F.lit("patch"), s(uid % 10)), ra_txt, F.concat(s(dec_deg), F.lit("deg")), s(F.col("v")),
        F.concat(F.lit("[-0.7, "), s(F.lit(1e-1) * (uid % 3)), F.lit("]")),
        F.when(uid % 2 == 0, "true").otherwise("false"), F.lit("1.4e8"),
        F.when(gauss, "6e1").otherwise(""), F.when(gauss, "3e1").otherwise(""),
        F.when(gauss, s(F.lit(1e1) * (uid % 18))).otherwise("")).alias("line"))
    k = F.col("k")
    pra = F.when(k % 2 == 0, F.concat(s(F.lit(5.2e1) + F.lit(1e-1) * k), F.lit("deg"))).otherwise(
        F.concat(F.lit("03:"), F.lpad(s(F.lit(2) * k), 2, "0"), F.lit(":"), s(F.lit(10) + k), F.lit(".25")))
    pdec = F.when(k % 3 == 0, F.concat(F.lit("-27."), F.lpad(s(F.lit(3) * k), 2, "0"), F.lit("."),
                                       F.lpad(s(F.lit(5) * k), 2, "0"), F.lit(".5"))).otherwise(
        s(F.lit(-2.8e1) + F.lit(1e-1) * k))
    patch = (events.select((F.col("user_id") % 10).alias("k")).distinct()
             .select(F.concat_ws(", ", F.lit(""), F.lit(""), F.concat(F.lit("patch"), s(k)), pra, pdec).alias("line")))
    return comp.unionByName(patch)


SKY_TEXT_SQL = """users AS (SELECT user_id AS uid, avg(value) AS v FROM events GROUP BY user_id),
scomp AS (SELECT 'src' || CAST(uid AS VARCHAR) AS name, CASE WHEN uid % 7 = 0 THEN 'GAUSSIAN' ELSE 'POINT' END AS type,
  'patch' || CAST(uid % 10 AS VARCHAR) AS patch, radians(5.2e1 + 1e-3*uid) AS ra, radians(-2.8e1 - 5e-4*uid) AS dec,
  v AS flux_i, -0.7e0 AS si_0, 1e-1*(uid % 3) AS si_1, uid % 2 = 0 AS log_si, 1.4e8 AS ref_freq,
  CASE WHEN uid % 7 = 0 THEN 6e1 END AS major, CASE WHEN uid % 7 = 0 THEN 3e1 END AS minor,
  CASE WHEN uid % 7 = 0 THEN 1e1*(uid % 18) END AS orientation FROM users),
spatch AS (SELECT 'patch' || CAST(k AS VARCHAR) AS patch,
  CASE WHEN k % 2 = 0 THEN radians(5.2e1 + 1e-1*k) ELSE radians((3e0 + (2*k)/6e1 + (10 + k + 0.25e0)/3.6e3) * 1.5e1) END AS ra,
  CASE WHEN k % 3 = 0 THEN -radians(27e0 + (3*k)/6e1 + (5*k + 0.5e0)/3.6e3) ELSE radians(-2.8e1 + 1e-1*k) END AS dec
  FROM (SELECT DISTINCT user_id % 10 AS k FROM events))"""


def sky_model_from_events(spark: SparkSession, sf_dir: str):
    """Write the derived sky text under the checkpoint folder and parse it back."""
    from ..session import scratch_path
    from .skymodel import scan_sky_model, write_sky_model
    path = scratch_path(spark, "sky")
    write_sky_model(sky_text_lines(read_table(spark, sf_dir, "events")), path, SKY_HEADER)
    return scan_sky_model(spark, path)
