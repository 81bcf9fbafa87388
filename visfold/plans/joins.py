"""Join helpers: broadcast only behind a proven size bound.

``bounded_broadcast`` checks the row count of a small side with a bounded
``limit(n + 1).count()`` (it never reads more than n + 1 rows of a scan) and
hints a broadcast only when the bound holds. Beyond it the join is left to
the planner (sort-merge / shuffled hash, with AQE re-planning at run time),
so a side that grows with the data can never be shipped to every executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows per small dimension table that may be broadcast (antennas, solutions,
# ranges, sky components). 2M narrow rows stay well below 100 MB.
DEFAULT_BROADCAST_ROWS = 2_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast-hinted ``df`` when it has at most ``max_rows`` rows, else ``df``."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


#: Rows of a metadata table (antennas, observations, hit channels) that the driver may hold.
DEFAULT_SMALL_ROWS = 100_000


def per_observation(df: DataFrame, max_rows: int = DEFAULT_SMALL_ROWS) -> DataFrame:
    """A metadata table, read once: broadcast when it has at most ``max_rows`` rows, else as it is.

    The size check and the broadcast use the same rows, so whatever the table is derived from (a
    scan of the visibilities, a fit) runs once. At most ``max_rows`` + 1 rows reach the driver.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
