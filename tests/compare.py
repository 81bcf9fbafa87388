"""Exact comparison of a Spark result with DuckDB oracle SQL (shared by tests and tools)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
from pyspark.sql.types import IntegralType

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return (0, "")
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, bool):
        return (3, str(v))
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, repr(v))
    if isinstance(v, int):
        return (2, repr(float(v)))
    return (4, str(v))


def rows(pdf, cols):
    return sorted(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


def compare(sdf, con, sql) -> str | None:
    """None when equal, else a short description of the first difference."""
    a = sdf.toPandas()
    for f in sdf.schema:  # a null among whole numbers is no NaN
        if isinstance(f.dataType, IntegralType) and f.name in a and a[f.name].isna().any():
            a[f.name] = a[f.name].astype("Int64")
    b = con.sql(sql).df()
    ca, cb = sorted(a.columns), sorted(b.columns)
    if ca != cb:
        return f"columns differ: {ca} vs {cb}"
    if len(a) != len(b):
        return f"row counts differ: {len(a)} vs {len(b)}"
    ra, rb = rows(a, ca), rows(b, ca)
    for x, y in zip(ra, rb):
        if x != y:
            return f"first differing row:\n spark={x}\n duck ={y}"
    return None
