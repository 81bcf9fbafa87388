"""Model visibilities from a sky model (Predict) and per-patch models (for demixing).

A sky model of up to ``MAX_COMPONENTS`` becomes one constant array of components; their direction cosines, which depend on an observation's phase
centre, are worked out once per observation, and each observation's array is joined
to its visibilities (a broadcast while the arrays are small, else a join on obs_id).
The sum over components is then one ``aggregate`` over the row's own array: every
visibility row is computed where it is read, with no shuffle and no pairs. The same path
serves every model, from one flat point source to a sky file with spectra and
Gaussians, given by (ra, dec) or by (l, m). Beyond ``FEW_COMPONENTS`` the same sum is taken by numpy in an Arrow function
(``sky_sums``), for a batch of rows and a tile of components at a time. The rows of a baseline are dealt and sorted side by side for it, as
the sum over a smooth track of points costs little more than that at a few of them.

A larger sky stays a table: its components are dealt into rows of at most ``BLOCK``, every distinct (observation, u, v, w, freq)
meets each block through a salted equi-join, and partial sums per block are added up. What is shuffled is narrow beside the
work per row (a sine, cosine and more for each of a block's components), and no task or constant holds the whole sky.

Conventions (decisions): unpolarised sky, XX = YY = model, XY = YX = 0; model
phase exp(-2 pi i f/c (u l + v m + w (n - 1))).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cplx as C
from ..functions import sky as SK
from ..plans.joins import per_observation, row_count_at_most
from ..session import ensure_checkpoint_dir, ship_package
from .sky_sums import SkyArrays, model_function

#: Components up to which a row's sum is one expression.
FEW_COMPONENTS = 64
#: Components that a plan holds as one constant (about 100 bytes each); beyond, the sky is joined in blocks.
MAX_COMPONENTS = 1 << 18
#: Components in a row of a larger sky, a power of two (about 130 bytes each).
BLOCK = 1 << 14
#: Components x observations up to which the arrays are broadcast.
BROADCAST_CELLS = 2_000_000

_FIELDS = {"name": "string", "type": "string", "patch": "string", "l": "double", "m": "double", "ra": "double", "dec": "double",
           "flux_i": "double", "si": "array<double>", "log_si": "boolean", "ref_freq": "double", "major": "double", "minor": "double",
           "orientation": "double"}


def _cells(components: DataFrame) -> Column:
    """A component's known columns as one struct."""
    have = set(components.columns)
    return F.struct(*[F.col(k).cast(t).alias(k) if k in have else F.lit(None).cast(t).alias(k) for k, t in _FIELDS.items()])


def placed(components: Column, by_phase_centre: bool) -> Column:
    """An array of components with their direction cosines; (ra, dec) ones need columns ra0 and dec0."""
    def place(c: Column) -> Column:
        l_, m_ = c["l"], c["m"]
        n_ = F.sqrt(F.lit(1.0) - l_ * l_ - m_ * m_)
        if by_phase_centre:
            dc = SK.direction_cosines(c["ra"], c["dec"], F.col("ra0"), F.col("dec0"))
            own = l_.isNull() | m_.isNull()
            l_, m_, n_ = (F.when(own, dc.getField(k)).otherwise(x) for k, x in (("l", l_), ("m", m_), ("n", n_)))
        return F.struct(l_.alias("l"), m_.alias("m"), n_.alias("n"), c["patch"].alias("patch"), c["flux_i"].alias("flux_i"),
                        c["si"].alias("si"), c["log_si"].alias("log_si"), c["ref_freq"].alias("ref_freq"),
                        F.upper(F.coalesce(c["type"], F.lit("POINT"))).alias("type"), c["major"].alias("major"),
                        c["minor"].alias("minor"), F.coalesce(c["orientation"], F.lit(0.0)).alias("orientation"))
    return F.transform(components, place)


class Sky:
    """A sky model as one constant array of components, in order of (patch, name)."""

    def __init__(self, components: DataFrame):
        rows = components.select(_cells(components).alias("c"))
        one = rows.agg(F.to_json(F.sort_array(F.collect_list(F.struct(F.col("c.patch").alias("p"), F.col("c.name").alias("n"), "c")))).alias("j"),
                       F.count(F.lit(1)).alias("n"), F.max(F.col("c.l").isNull() | F.col("c.m").isNull()).alias("radec"),
                       F.sort_array(F.collect_set("c.patch")).alias("patches")).first()
        self.size, self.patches, self.needs_phase_centre = int(one["n"]), list(one["patches"]), bool(one["radec"])
        kind = ", ".join(f"{k}: {t}" for k, t in _FIELDS.items())
        self.components = F.transform(F.from_json(F.lit(one["j"]), f"array<struct<p: string, n: string, c: struct<{kind}>>>"), lambda x: x["c"])

    def placed(self) -> Column:
        return placed(self.components, self.needs_phase_centre)


def _with_sky(vis: DataFrame, sky: Sky, obs_meta: DataFrame | None) -> DataFrame:
    """Add ``_sky``: the placed components of the row's observation."""
    if not sky.needs_phase_centre:
        return vis.withColumn("_sky", sky.placed())
    if obs_meta is None:
        raise ValueError("components given by (ra, dec) need obs_meta (obs_id, ra0, dec0)")
    per_obs = obs_meta.select("obs_id", "ra0", "dec0").distinct().select("obs_id", sky.placed().alias("_sky"))
    if row_count_at_most(obs_meta, BROADCAST_CELLS // max(1, sky.size)):
        per_obs = F.broadcast(per_obs)
    return vis.join(per_obs, "obs_id", "left")


def component_term(c: Column) -> Column:
    """Complex contribution of one placed component to a visibility row."""
    freq = F.col("freq")
    flux = F.when(c["ref_freq"].isNull(), c["flux_i"]).otherwise(SK.component_flux(c["flux_i"], c["si"], c["log_si"], c["ref_freq"], freq))
    amp = flux * SK.component_shape(c["type"], F.col("u"), F.col("v"), freq, c["major"], c["minor"], c["orientation"])
    ph = -SK.geometric_phase(F.col("u"), F.col("v"), F.col("w"), freq, c["l"], c["m"], c["n"])
    return C.cpx(amp * F.cos(ph), amp * F.sin(ph))


def model_sum(sky: Column) -> Column:
    """Sum over an array of placed components."""
    def add(acc: Column, t: Column) -> Column:
        return F.struct((acc["re"] + t["re"]).alias("re"), (acc["im"] + t["im"]).alias("im"))
    return F.aggregate(F.transform(sky, component_term), C.c_zero(), add)


def unpolarised(m: Column) -> Column:
    return C.jones(m, C.c_zero(), C.c_zero(), m)


_POINT = ["obs_id", "u", "v", "w", "freq"]


def _models_of(vis: DataFrame, components: DataFrame, obs_meta: DataFrame | None, per_patch: bool):
    """Add ``_m0 ..``: the model of all components or of each patch, for a sky that a plan may hold; returns (df, patches)."""
    sky = Sky(components)
    patches = sky.patches if per_patch else [None]
    if sky.size <= FEW_COMPONENTS:
        v = _with_sky(vis, sky, obs_meta)

        def of(patch: str) -> Column:
            return F.filter("_sky", lambda c: c["patch"] == F.lit(patch))
        for k, p in enumerate(patches):
            v = v.withColumn(f"_m{k}", model_sum(of(p) if per_patch else F.col("_sky")))
        return v.drop("_sky"), patches
    args = [F.col(c) for c in ("u", "v", "w", "freq")]
    v = vis
    if sky.needs_phase_centre:
        if obs_meta is None:
            raise ValueError("components given by (ra, dec) need obs_meta (obs_id, ra0, dec0)")
        centres = obs_meta.select("obs_id", F.col("ra0").cast("double").alias("_ra0"), F.col("dec0").cast("double").alias("_dec0"),
                                  F.lit(True).alias("_placed")).distinct()
        v = v.join(per_observation(centres), "obs_id", "left")
        args += [F.col("_ra0"), F.col("_dec0")]
    ship_package(vis.sparkSession)
    held = components.select(_cells(components).alias("c")).select("c.*", (F.lit(1.0) / F.col("c.ref_freq")).alias("per_ref"))
    arrays = SkyArrays.of(held.collect())  # as many as the plan may hold
    # little input, much work: as many tasks as keep all cores busy, however few the input has
    spark = vis.sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    track = [c for c in ("obs_id", "ant1", "ant2") if c in v.columns]
    if "slot" in v.columns:  # a track's points side by side, in pieces of 256 slots
        v = v.repartition(n, *track, "freq", F.floor(F.col("slot") / 256)).sortWithinPartitions(*track, "freq", "slot")
    else:
        v = v.repartition(n, *_POINT)
    v = v.withColumn("_models", model_function(arrays, patches)(F.xxhash64(*track), *args))
    for k in range(len(patches)):
        m = F.col("_models").getField(f"m{k}")
        v = v.withColumn(f"_m{k}", F.when(F.col("_placed"), m) if sky.needs_phase_centre else m)
    return v.drop("_models", "_ra0", "_dec0", "_placed"), patches


def _held(components: DataFrame, max_components: int) -> bool:
    """May the plan hold this sky as one constant?"""
    return row_count_at_most(components, max_components)


def _block_sums(vis: DataFrame, components: DataFrame, obs_meta: DataFrame | None, per_patch: bool, block: int = BLOCK):
    """Add ``_m0 ..``: the model of all components or of each patch, for a sky joined in blocks; returns (df, patches).

    The sky is written once, so that a component's number, which names its block, stays the same whatever is computed again.
    """
    spark = vis.sparkSession
    ensure_checkpoint_dir(spark)
    sky = components.select(_cells(components).alias("c")).checkpoint()
    part = F.shiftright(F.monotonically_increasing_id(), block.bit_length() - 1)  # numbers are dense within a partition
    patch = F.col("c.patch") if per_patch else F.lit(None).cast("string")
    named = sky.select(part.alias("part"), patch.alias("patch"), "c")
    if per_patch:
        named = named.filter("patch IS NOT NULL")
    radec = sky.filter("c.l IS NULL OR c.m IS NULL").limit(1).count() > 0
    blocks = named.select("part", "patch").distinct().orderBy("patch", "part").collect()  # a row per block
    patches = sorted({r["patch"] for r in blocks}) if per_patch else [None]
    if not blocks:  # a sky whose components have no patch
        return vis, patches
    numbers = spark.createDataFrame([(r["part"], r["patch"], i, patches.index(r["patch"])) for i, r in enumerate(blocks)],
                                    "part long, patch string, block int, k int")
    salts = max(1, -(-4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // len(blocks)))
    rows = (named.groupBy("part", "patch").agg(F.collect_list("c").alias("c")).alias("s")
            .join(F.broadcast(numbers).alias("n"), F.col("s.part").eqNullSafe(F.col("n.part")) & F.col("s.patch").eqNullSafe(F.col("n.patch")))
            .select("n.block", "n.k", "s.c", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")))
    points = vis.select(*_POINT).distinct()
    if radec:
        if obs_meta is None:
            raise ValueError("components given by (ra, dec) need obs_meta (obs_id, ra0, dec0)")
        points = points.join(per_observation(obs_meta.select("obs_id", "ra0", "dec0").distinct()), "obs_id", "left")
    dealt = points.select("*", F.pmod(F.xxhash64(*_POINT), F.lit(salts)).cast("int").alias("salt"),
                          F.explode(F.sequence(F.lit(0), F.lit(len(blocks) - 1))).alias("block"))
    terms = dealt.join(rows, ["block", "salt"]).select(*_POINT, "k", model_sum(placed(F.col("c"), radec)).alias("_t"))
    aggs = [F.sum(F.when(F.col("k") == i, F.col(f"_t.{x}"))).alias(f"_{x}{i}") for i in range(len(patches)) for x in ("re", "im")]
    sums = terms.groupBy(*_POINT).agg(*aggs).select(*[F.col(c).alias(f"_{c}") for c in _POINT],
                                                    *[C.cpx(F.col(f"_re{i}"), F.col(f"_im{i}")).alias(f"_m{i}") for i in range(len(patches))])
    same = F.lit(True)
    for c in _POINT:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return vis.join(sums, same, "left").drop(*[f"_{c}" for c in _POINT]), patches


def predict(vis: DataFrame, components: DataFrame, obs_meta: DataFrame | None = None, max_components: int = MAX_COMPONENTS,
            block: int = BLOCK) -> DataFrame:
    """Replace ``data`` by the model visibilities of the whole sky model, of any size."""
    if _held(components, max_components):
        v, _ = _models_of(vis, components, obs_meta, False)
    else:
        v, _ = _block_sums(vis, components, obs_meta, False, block)
    return v.withColumn("data", unpolarised(F.col("_m0"))).select(vis.columns)


def patch_models(vis: DataFrame, components: DataFrame, obs_meta: DataFrame | None = None, max_components: int = MAX_COMPONENTS,
                 block: int = BLOCK):
    """Add one model column per patch (``model_<k>``, struct<re,im>); returns (df, patches)."""
    if _held(components, max_components):
        v, patches = _models_of(vis, components, obs_meta, True)
    else:
        v, patches = _block_sums(vis, components, obs_meta, True, block)
    return v.withColumnsRenamed({f"_m{k}": f"model_{k}" for k in range(len(patches))}), patches


def predict_per_patch(vis: DataFrame, components: DataFrame, obs_meta: DataFrame | None = None) -> DataFrame:
    """One row per (visibility, patch) with that patch's model (long form)."""
    v, patches = patch_models(vis, components, obs_meta)
    arr = F.array(*[F.struct(F.lit(p).alias("patch"), F.col(f"model_{k}").alias("model"))
                    for k, p in enumerate(patches)])
    keep = [c for c in vis.columns if c not in ("data", "flag")]
    return v.select(*keep, F.explode(arr).alias("_p")).select(*keep, "_p.patch", "_p.model")


def phase_rotate(vis: DataFrame, l_: float, m_: float) -> DataFrame:
    """Shift the phase centre towards (l, m): multiply by exp(+2 pi i f/c (u l + v m + w (n - 1)))."""
    return vis.withColumn("data", SK.phase_rotate(F.col("data"), "u", "v", "w", "freq", l_, m_))
