"""Apply an ordered list of steps to all observations in one lazy plan.

A step is ``{name: params}`` (the configuration-file shape) or a
``(name, params)`` pair. Names are case-insensitive. Steps may repeat,
except ``msin`` / ``msout`` (at most one each, first / last) and ``demixer``
(at most one). The fold builds one DataFrame; nothing runs until the sink
(or the caller) acts. An empty list is a plain copy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators import applycal as AC
from ..operators import averaging as A
from ..operators import demix as DX
from ..operators import dynamic_flagging as DF
from ..operators import flagging as FL
from ..operators import predict as PR
from ..operators import soltab as ST
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.visibilities import DATA_COLUMNS, first_slots, rows_to_channels, scan_rows, write_visibilities


#: Folder name of the Demixer's gains when the step names none.
DEFAULT_GAINS = "demixer_gains"


@dataclass
class Inputs:
    """Tables the steps refer to by name (solutions, sky models, antennas, metadata)."""
    solutions: Mapping[str, DataFrame] = field(default_factory=dict)
    sky_models: Mapping[str, DataFrame] = field(default_factory=dict)
    antenna: DataFrame | None = None
    obs_meta: DataFrame | None = None
    gains: dict[str, DataFrame] = field(default_factory=dict)
    #: Folder under which the Demixer's gains are always written; a scratch folder when unset.
    gains_dir: str | None = None
    #: (obs_id, first_slot) of the input's own slots; ``run_pipeline`` takes it from the scan.
    first_slots: DataFrame | None = None
    #: Whether a step has numbered the slots anew from 0.
    slots_restart: bool = False
    #: Whether a step so far shuffles the visibilities.
    shuffled: bool = False

    def first(self) -> DataFrame | int | None:
        """First slot per observation at the current step, where it is known."""
        if self.slots_restart:
            return 0
        if self.obs_meta is not None and "first_slot" in self.obs_meta.columns:
            return self.obs_meta.select("obs_id", "first_slot")
        return self.first_slots


def _named(tables: Mapping[str, DataFrame], key, what: str) -> DataFrame:
    if not isinstance(key, str):
        return key
    if key not in tables:
        raise ValueError(f"no {what} named {key!r}; there are {sorted(tables)}")
    return tables[key]


def _msin(vis, p, inp):
    name = p.get("datacolumn", "DATA")
    column = DATA_COLUMNS.get(name.upper(), name.lower())
    if column not in vis.columns:
        raise ValueError(f"the input has no data column {name!r}")
    return vis if column == "data" else vis.withColumn("data", vis[column])


def _preflagger(vis, p, inp):
    return FL.preflag(vis, antenna_table=inp.antenna, **p)


def _aoflagger(vis, p, inp):
    inp.shuffled = True
    return DF.dynamic_flag(vis, **{k: v for k, v in p.items() if k != "memorymax"})  # Spark manages memory


def check_solutions(sol: DataFrame, antenna: DataFrame) -> None:
    """Raise for a set that breaks a rule or lacks an antenna of the data."""
    ST.raise_on_violations(ST.soltab_violations(sol).unionByName(ST.solset_violations(sol)))
    lacking = AC.antenna_coverage(antenna, sol).select("name").distinct().limit(20).collect()
    if lacking and "ant" in AC.solution_layout(sol)["axes"]:
        raise ST.InvalidSolutions(f"no solutions for antennas {sorted(r['name'] for r in lacking)}")


def _applycal(vis, p, inp):
    sol = _named(inp.solutions, p["parmdb"], "solution set")
    if inp.antenna is None:
        raise ValueError("applycal needs an antenna table")
    check_solutions(sol, inp.antenna)
    return AC.applycal(vis, sol, inp.antenna, mode=p.get("interpolation", "nearest"), direction=p.get("direction"))


def _averager(vis, p, inp):
    first, step = inp.first(), p.get("timestep", 1)
    inp.slots_restart |= step > 1
    inp.shuffled = True
    return A.average(vis, timestep=step, freqstep=p.get("freqstep", 1), obs_first=first)


def _predict(vis, p, inp):
    return PR.predict(vis, _named(inp.sky_models, p["sourcedb"], "sky model"), inp.obs_meta)


def _written(vis: DataFrame) -> DataFrame:
    """The visibilities as a table in the shared folder: columnar, so a later scan reads only what it needs."""
    path = scratch_path(vis.sparkSession, "before-demixing")
    vis.write.parquet(path)
    return vis.sparkSession.read.schema(vis.schema).parquet(path)


def _demixer(vis, p, inp):
    """Fit and subtract. The rows up to here are needed twice: the fit reads them and leaves small sums, the subtraction
    reads them again. Row-local steps are simply run twice, without a copy of the visibilities; what a shuffling step
    made is written once. The gains are always written, one folder per observation."""
    folder = inp.gains_dir or scratch_path(vis.sparkSession, "gains")
    ensure_checkpoint_dir(vis.sparkSession)
    vis = _written(vis) if inp.shuffled else vis
    out, gains = DX.demix(vis, _named(inp.sky_models, p["skymodel"], "sky model"), subtract=p.get("subtractsources"),
                          timestep=p.get("demixtimestep", 1), freqstep=p.get("demixfreqstep", 1),
                          solint_t=p.get("solint_t", 4), solint_f=p.get("solint_f", 4), obs_meta=inp.obs_meta, obs_first=inp.first(),
                          method=p.get("method", "lm"), gain=p.get("gain", "scalar"), gains_path=f"{folder.rstrip('/')}/{p.get('instrumentmodel', DEFAULT_GAINS)}")
    inp.gains["demixer"] = gains
    return out


STEPS: dict[str, Callable[[DataFrame, Any, Inputs], DataFrame]] = {
    "msin": _msin,
    "msout": lambda vis, p, inp: vis,
    "preflagger": _preflagger,
    "aoflagger": _aoflagger,
    "applycal": _applycal,
    "averager": _averager,
    "predict": _predict,
    "demixer": _demixer,
}

_TABLE = (str, DataFrame)
_NUMBER = (int, float)
#: Parameters of each step: name -> accepted types; ``required`` ones must be given.
PARAMETERS: dict[str, dict[str, Any]] = {
    "msin": {"datacolumn": str},
    "msout": {"overwrite": bool},
    "preflagger": {"mode": str, "chan": (str, list, tuple), "freqrange": (str, list, tuple), "timerange": (list, tuple),
                   "uvmrange": (list, tuple), "amplmin": _NUMBER, "amplmax": _NUMBER, "autocorr": bool, "antennas": (list, tuple)},
    "aoflagger": {"memorymax": _NUMBER, "sensitivity": _NUMBER, "half_width": "step", "sizes": (list, tuple), "eta": _NUMBER, "rounds": "step"},
    "applycal": {"parmdb": _TABLE, "interpolation": str, "direction": str},
    "averager": {"timestep": "step", "freqstep": "step"},
    "predict": {"sourcedb": _TABLE},
    "demixer": {"gain": str, "skymodel": _TABLE, "subtractsources": (list, tuple), "demixtimestep": "step", "demixfreqstep": "step",
                "solint_t": "step", "solint_f": "step", "method": str, "instrumentmodel": str},
}
REQUIRED = {"applycal": ("parmdb",), "predict": ("sourcedb",), "demixer": ("skymodel",)}


def check_parameters(name: str, params: Mapping[str, Any]) -> None:
    """Raise for an unknown or missing parameter, or one that isn't of its natural type."""
    known = PARAMETERS[name]
    if unknown := sorted(set(params) - set(known)):
        raise ValueError(f"step {name!r} has no parameters {unknown}; it has {sorted(known)}")
    if missing := [k for k in REQUIRED.get(name, ()) if k not in params]:
        raise ValueError(f"step {name!r} needs {missing}")
    for key, value in params.items():
        kind = known[key]
        if kind == "step":
            good = isinstance(value, int) and not isinstance(value, bool) and value >= 1
        else:
            good = isinstance(value, kind) and (kind is bool or not isinstance(value, bool))
        if not good:
            raise ValueError(f"step {name!r}: {key} can't be {value!r}")


def normalise_steps(steps: Iterable) -> list[tuple[str, dict]]:
    """Accept {name: params} or (name, params); check names and the once-only rules."""
    out = []
    for s in steps:
        if isinstance(s, Mapping):
            if len(s) != 1:
                raise ValueError(f"a step must have exactly one name, got {list(s)}")
            (name, params), = s.items()
        else:
            name, params = s
        name = str(name).lower()
        if name not in STEPS:
            raise ValueError(f"unknown step {name!r}")
        params = {str(k).lower(): v for k, v in dict(params or {}).items()}
        check_parameters(name, params)
        out.append((name, params))
    names = [n for n, _ in out]
    for once in ("msin", "msout", "demixer"):
        if names.count(once) > 1:
            raise ValueError(f"step {once!r} may appear at most once")
    if "msin" in names and names.index("msin") != 0:
        raise ValueError("msin must be the first step")
    if "msout" in names and names.index("msout") != len(names) - 1:
        raise ValueError("msout must be the last step")
    return out


def preprocess(vis: DataFrame, steps: Iterable, inputs: Inputs | None = None) -> DataFrame:
    """Fold the steps over ``vis`` (``DataFrame.transform`` chain), lazily."""
    inputs = inputs or Inputs()
    inputs.slots_restart = inputs.shuffled = False
    for name, params in normalise_steps(steps):
        vis = vis.transform(lambda df, n=name, p=params: STEPS[n](df, p, inputs))
    return vis


def run_pipeline(spark: SparkSession, paths, steps: Iterable, output_dir: str, inputs: Inputs | None = None,
                 manifest: DataFrame | None = None) -> None:
    """Read observations, apply the steps and write them: ``msin`` and ``msout`` are always there,
    their parameters come from the list. Gains go to ``output_dir`` with ``_gains`` appended."""
    listed = normalise_steps(steps)
    params = dict(listed)
    column = params.get("msin", {}).get("datacolumn", "DATA")
    rows = scan_rows(spark, paths, column, manifest)
    inputs = inputs or Inputs()
    # a copy: folder and slots are this run's own
    inputs = replace(inputs, gains_dir=inputs.gains_dir or f"{output_dir.rstrip('/')}_gains", first_slots=first_slots(rows))
    vis = rows_to_channels(rows, DATA_COLUMNS.get(column.upper(), column.lower()))
    out = preprocess(vis, [(n, p) for n, p in listed if n not in ("msin", "msout")], inputs)
    write_visibilities(out, output_dir, overwrite=params.get("msout", {}).get("overwrite", False))


def copy_through(vis: DataFrame) -> DataFrame:
    """An empty step list: the data unchanged."""
    return preprocess(vis, [])
