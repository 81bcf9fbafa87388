"""Row-local steps on a streaming visibility DataFrame.

The reference has no streaming operators. Steps that only rewrite columns
of each row (static flags, calibration against a static solution table,
prediction from a sky model) need no state, so the same ``preprocess``
fold applies unchanged to a ``readStream`` DataFrame. Steps that group or
window (averager, aoflagger, demixer) are refused here: on a stream they
would need watermarks and state the reference does not define.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..plans.preprocess import Inputs, normalise_steps, preprocess

ROW_LOCAL_STEPS = frozenset({"msin", "msout", "preflagger", "applycal", "predict"})


def preprocess_stream(stream: DataFrame, steps: Iterable, inputs: Inputs | None = None) -> DataFrame:
    """Apply row-local steps to a streaming DataFrame (raises for stateful steps)."""
    steps = normalise_steps(steps)
    stateful = sorted({n for n, _ in steps} - ROW_LOCAL_STEPS)
    if stateful:
        raise ValueError(f"steps {stateful} group or window rows and are not supported on streams")
    return preprocess(stream, steps, inputs)
