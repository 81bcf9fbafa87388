"""Exact median and median absolute deviation per group, without a window and without buffering a group.

One aggregation keeps a mergeable quantile sketch per group (``percentile_approx``: partial per task, bounded
size). Its points bracket the median and the deviation; a second aggregation counts what lies below and
between the brackets and keeps only the distinct values inside them, with their numbers. The order statistics
are read off those. Equal values are one entry, so ties don't lengthen a bracket's list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Quantile steps, and the sketch's accuracy: a point's rank is off by at most a share 1 / ACCURACY.
STEPS, ACCURACY = 500, 10_000


def median_and_deviation(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, n, median, mad) of the non-null, finite values of each group; both as of sorted lists, the
    mean of the middle two if their number is even. A group without such a value has no row."""
    rows = df.select(*keys, F.col(value).cast("double").alias("v")).filter("v - v = 0")
    off = 2.0 / ACCURACY
    shares = [i / STEPS for i in range(STEPS + 1)] + [0.5 - off, 0.5 + off]
    sketch = rows.groupBy(*keys).agg(F.count("v").alias("n"), F.percentile_approx("v", shares, ACCURACY).alias("q"))
    sketch = sketch.select(
        *keys, "n", F.expr(f"q[{STEPS + 1}]").alias("m_lo"), F.expr(f"q[{STEPS + 2}]").alias("m_hi"),
        F.expr(f"sort_array(transform(slice(q, 1, {STEPS + 1}), x -> abs(x - (q[{STEPS + 1}] + q[{STEPS + 2}]) / 2)))").alias("d"))
    # Grid points within a distance of the middle are neighbours; so many of them hold at least, or at most, half of the values.
    bracket = sketch.select(*keys, "n", "m_lo", "m_hi", F.expr(f"d[{STEPS // 2 - 4}] - (m_hi - m_lo)").alias("t_lo"),
                            F.expr(f"d[{STEPS // 2 + 4}] + (m_hi - m_lo)").alias("t_hi"))

    placed = rows.join(bracket, list(keys)).withColumn("zone", F.expr("""CASE WHEN v < m_lo THEN 0 WHEN v <= m_hi THEN 1 ELSE 2 END""")) \
        .withColumn("ring", F.expr("""CASE WHEN greatest(m_hi - v, v - m_lo) < t_lo THEN 0
                                           WHEN least(abs(v - m_lo), abs(v - m_hi)) <= t_hi OR (v >= m_lo AND v <= m_hi) THEN 1 ELSE 2 END"""))
    # distinct values in a bracket, numbers elsewhere
    placed = placed.withColumn("kept", F.expr("CASE WHEN zone = 1 OR ring = 1 THEN v END"))
    counts = placed.groupBy(*keys, "zone", "ring", "kept").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
    entry = F.struct(F.col("kept").alias("x"), F.col("c").alias("c"))
    found = counts.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("zone") == 0, F.col("c"))), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(F.col("ring") == 0, F.col("c"))), F.lit(0)).alias("inside"),
        F.array_sort(F.collect_list(F.when(F.col("zone") == 1, entry))).alias("middle"),
        F.collect_list(F.when(F.col("ring") == 1, entry)).alias("around"))
    found = found.withColumn("median", F.expr(_middle("middle", "below")))
    found = found.withColumn("around", F.expr("array_sort(transform(around, e -> named_struct('x', abs(e.x - median), 'c', e.c)))"))
    return found.withColumn("mad", F.expr(_middle("around", "inside"))).select(*keys, "n", "median", "mad")


def _middle(entries: str, before: str) -> str:
    """SQL of the median, from sorted (value, number) entries that follow ``before`` smaller values."""
    def at(rank: str) -> str:
        # the entry in which the rank falls: one running sum over the list
        return (f"aggregate({entries}, named_struct('left', CAST({rank} - {before} AS BIGINT), 'x', CAST(NULL AS DOUBLE)), "
                f"(s, e) -> named_struct('left', s.left - e.c, 'x', CASE WHEN s.left > 0 THEN e.x ELSE s.x END), s -> s.x)")
    return f"({at('floor((n + 1) / 2)')} + {at('ceil((n + 1) / 2)')}) / 2"
