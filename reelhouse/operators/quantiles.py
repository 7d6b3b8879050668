"""Per-group quantiles (A10).

``exact``: ``percentile`` (linear interpolation between closest ranks, the same
definition as a continuous quantile).  Its buffer is a count per *distinct*
value, so for ratings (ten half-star values) it is bounded no matter how many
rows a group holds; it supports partial aggregation.
``approx``: ``percentile_approx`` with a fixed accuracy, for unbounded domains.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

APPROX_ACCURACY = 10000


def quantiles(x: Column, probs: list[float], mode: str = "exact", weight: Column | None = None) -> Column:
    """One aggregate returning ``array<double>`` of the requested quantiles."""
    if mode == "exact":
        if weight is not None:
            return F.percentile(x, probs, weight)
        return F.percentile(x, probs)
    if mode == "approx":
        if weight is not None:
            raise ValueError("approx quantiles take no frequency column")
        return F.percentile_approx(x.cast("double"), probs, APPROX_ACCURACY).cast("array<double>")
    raise ValueError(f"unknown quantile mode: {mode!r}")
