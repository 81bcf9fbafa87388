"""Result quantiser used when results are compared across engines.

The fixture values are short decimals, so averages often land exactly on a
decimal rounding tie, where summation order decides the direction of a
plain ``round``. ``qround`` rounds on a grid shifted by an irrational
fraction of one step, which no short decimal hits, and shifts back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: grid shift as a fraction of one rounding step (1/pi).
GRID_SHIFT = 0.3183098861837907


def shift(digits: int) -> float:
    return GRID_SHIFT * 10.0 ** (-digits)


def qround(c: Column, digits: int = 6) -> Column:
    s = F.lit(shift(digits))
    return F.round(c + s, digits) - s


def qround_sql(expr: str, digits: int = 6) -> str:
    s = repr(shift(digits))
    return f"(round(({expr}) + {s}, {digits}) - {s})"
