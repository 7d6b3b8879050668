"""Mode and quantiles from a per-key value histogram.

``value_counts`` is a plain hash aggregate on (keys, value) with map-side partial
aggregation, so a key holding a third of all rows is reduced on every mapper
before the shuffle.  Mode and quantiles then run over the histogram, which has
one row per distinct value per key, instead of keeping a value map per group
inside a larger aggregation (where Spark's distinct-count rewrite multiplies
those buffers).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import quantiles


def value_counts(df: DataFrame, keys: Sequence[str], value: str, count_col: str = "cnt") -> DataFrame:
    """(keys..., value, cnt) for non-null values."""
    return (df.where(F.col(value).isNotNull())
            .groupBy(*keys, value).agg(F.count(F.lit(1)).alias(count_col)))


def mode_from_counts(counts: DataFrame, keys: Sequence[str], value: str, alias: str,
                     count_col: str = "cnt") -> DataFrame:
    """Most frequent value per key; ties go to the smallest value (numeric values).

    Spark plans ``max_by`` over a struct as a sort aggregate on both sides of the shuffle.
    """
    order = F.struct(F.col(count_col), -F.col(value))
    return counts.groupBy(*keys).agg(F.max_by(value, order).alias(alias))


def small_mode_from_counts(counts: DataFrame, keys: Sequence[str], value: str, alias: str,
                           count_col: str = "cnt") -> DataFrame:
    """``mode_from_counts`` for whole values from 0 to 63 (hours, weekdays): count and value share one
    bigint, so the mode is a plain maximum and a hash aggregate.  Other values raise."""
    v = F.col(value)
    checked = F.when(v.between(0, 63), F.lit(63) - v).otherwise(F.raise_error(F.lit(f"{value} is not from 0 to 63")).cast("bigint"))
    best = F.max(F.col(count_col) * 64 + checked)
    return counts.groupBy(*keys).agg((F.lit(63) - F.pmod(best, F.lit(64))).cast(counts.schema[value].dataType).alias(alias))


def modes(df: DataFrame, keys: Sequence[str], values: dict[str, str], small: Sequence[str] = ()) -> DataFrame:
    """Several modes per key from one joint histogram (one pass over ``df``).

    ``values`` maps a value column to its output alias; ``small`` names those with whole values from 0 to 63.
    """
    cols = list(values)
    joint = df.groupBy(*keys, *cols).agg(F.count(F.lit(1)).alias("cnt"))
    out = None
    for c, alias in values.items():
        per = (joint.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.sum("cnt").alias("cnt")))
        m = (small_mode_from_counts if c in small else mode_from_counts)(per, keys, c, alias)
        out = m if out is None else out.join(m, list(keys), "full_outer")
    return out


def quantiles_from_counts(counts: DataFrame, keys: Sequence[str], value: str, probs: list[float],
                          alias: str = "_q", count_col: str = "cnt") -> DataFrame:
    """Exact quantiles per key from (value, frequency) rows: ``array<double>``.

    (``percentile_approx`` has no frequency argument; approximate quantiles are
    computed on raw rows with ``quantiles(..., "approx")``.)
    """
    q = quantiles(F.col(value), probs, "exact", weight=F.col(count_col))
    return counts.groupBy(*keys).agg(q.alias(alias))

