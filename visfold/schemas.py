"""Canonical schemas. Explicit StructTypes, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

COMPLEX = T.StructType([T.StructField("re", T.DoubleType()), T.StructField("im", T.DoubleType())])
POL_COMPLEX = T.StructType([T.StructField(p, COMPLEX) for p in ("xx", "xy", "yx", "yy")])
POL_FLAG = T.StructType([T.StructField(p, T.BooleanType()) for p in ("xx", "xy", "yx", "yy")])

# Visibility key: one row per (observation, time slot, baseline, channel).
VIS_KEY = ("obs_id", "slot", "ant1", "ant2", "chan")

VIS = T.StructType([
    T.StructField("obs_id", T.LongType()),
    T.StructField("slot", T.LongType()),
    T.StructField("time", T.DoubleType()),
    T.StructField("ant1", T.IntegerType()),
    T.StructField("ant2", T.IntegerType()),
    T.StructField("chan", T.IntegerType()),
    T.StructField("freq", T.DoubleType()),
    T.StructField("u", T.DoubleType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("w", T.DoubleType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("data", POL_COMPLEX),
    T.StructField("flag", POL_FLAG),
])

# At rest: one row per (observation, time slot, baseline), channels as arrays.
VIS_ROWS = T.StructType([
    T.StructField("obs_id", T.LongType()),
    T.StructField("slot", T.LongType()),
    T.StructField("time", T.DoubleType()),
    T.StructField("ant1", T.IntegerType()),
    T.StructField("ant2", T.IntegerType()),
    T.StructField("u", T.DoubleType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("w", T.DoubleType()),
    T.StructField("chan", T.ArrayType(T.IntegerType())),
    T.StructField("freq", T.ArrayType(T.DoubleType())),
    T.StructField("weight", T.ArrayType(T.DoubleType())),
    T.StructField("data", T.ArrayType(POL_COMPLEX)),
    T.StructField("flag", T.ArrayType(POL_FLAG)),
])

ANTENNA = T.StructType([
    T.StructField("obs_id", T.LongType()),
    T.StructField("ant", T.IntegerType()),
    T.StructField("name", T.StringType()),
])

SOLUTION = T.StructType([
    T.StructField("solset", T.StringType()),
    T.StructField("soltab", T.StringType()),
    T.StructField("soltype", T.StringType()),
    T.StructField("axes", T.ArrayType(T.StringType())),
    T.StructField("pos", T.ArrayType(T.IntegerType())),
    T.StructField("time", T.DoubleType()),
    T.StructField("freq", T.DoubleType()),
    T.StructField("ant", T.StringType()),
    T.StructField("pol", T.StringType()),
    T.StructField("dir", T.StringType()),
    T.StructField("val", T.DoubleType()),
    T.StructField("weight", T.FloatType()),
])

SOLTAB_AXIS = T.StructType([
    T.StructField("solset", T.StringType()),
    T.StructField("soltab", T.StringType()),
    T.StructField("axis", T.StringType()),
    T.StructField("axis_pos", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("num_value", T.DoubleType()),
    T.StructField("str_value", T.StringType()),
])

SOLTAB_DENSE = T.StructType([
    T.StructField("solset", T.StringType()),
    T.StructField("soltab", T.StringType()),
    T.StructField("soltype", T.StringType()),
    T.StructField("axes", T.ArrayType(T.StringType())),
    T.StructField("time_axis", T.ArrayType(T.DoubleType())),
    T.StructField("freq_axis", T.ArrayType(T.DoubleType())),
    T.StructField("ant_axis", T.ArrayType(T.StringType())),
    T.StructField("pol_axis", T.ArrayType(T.StringType())),
    T.StructField("dir_axis", T.ArrayType(T.StringType())),
    T.StructField("offset", T.LongType()),
    T.StructField("val", T.ArrayType(T.DoubleType())),
    T.StructField("weight", T.ArrayType(T.FloatType())),
])

SKY_PATCH = T.StructType([
    T.StructField("patch", T.StringType()),
    T.StructField("ra", T.DoubleType()),
    T.StructField("dec", T.DoubleType()),
])

SKY_COMPONENT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("patch", T.StringType()),
    T.StructField("ra", T.DoubleType()),
    T.StructField("dec", T.DoubleType()),
    T.StructField("flux_i", T.DoubleType()),
    T.StructField("si", T.ArrayType(T.DoubleType())),
    T.StructField("log_si", T.BooleanType()),
    T.StructField("ref_freq", T.DoubleType()),
    T.StructField("major", T.DoubleType()),
    T.StructField("minor", T.DoubleType()),
    T.StructField("orientation", T.DoubleType()),
])

# Fixed vocabulary of the solution-table model (values that must match).
VALID_AXIS_NAMES = ("time", "freq", "ant", "pol", "dir")
STRING_AXES = ("ant", "pol", "dir")
VALID_SOLTYPES = ("amplitude", "phase", "tec")
VALID_POL_TUPLES = (("XX", "YY"), ("XX", "XY", "YX", "YY"))
RESERVED_SOLSET_KEYS = ("antenna", "source")
