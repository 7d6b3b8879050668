"""Approximate quantiles by stored, mergeable KLL sketches (A10).

Sketches are built per fine key once, kept in a table, and merged to any coarser key without reading
the rows again.  The normalised rank error of one quantile is below ``rank_error(k)`` in 99 of 100 cases,
whatever the number of rows; sketches hold about 3 * k values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: the published fit of the KLL sketch's error to its parameter k -------
ERROR_FACTOR, ERROR_POWER = 2.296, 0.9723
# ------------------------------------------------------------------------------------


def rank_error(k: int) -> float:
    """The normalised rank error that 99 of 100 single quantiles stay below."""
    return ERROR_FACTOR / k ** ERROR_POWER


def value_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = 400) -> DataFrame:
    """(keys..., sketch) of the non-null values."""
    x = F.col(value).cast("double")
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(x, k).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], k: int = 400) -> DataFrame:
    """(keys..., sketch): the sketches of finer keys as one."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def rank_errors(sketches: DataFrame, counts: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                count: str = "cnt") -> DataFrame:
    """(keys..., n, <name>, <name>_error): each quantile of the sketch, and how far its true rank is off.

    ``counts`` has the exact rows (keys..., value, count).  A value holds all ranks from the share of
    smaller rows to the share of rows up to it; the error is the distance of the asked rank from these.
    """
    asked = sketches.select(*keys, *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in probs.items()])
    j = counts.join(asked, list(keys))
    n, c, x = F.sum(count), F.col(count), F.col(value)
    sums = [s for name in probs for s in (F.sum(F.when(x < F.col(name), c).otherwise(0)).alias(f"{name}_lt"),
                                          F.sum(F.when(x <= F.col(name), c).otherwise(0)).alias(f"{name}_le"))]
    out = j.groupBy(*keys, *probs).agg(n.cast("bigint").alias("n"), *sums)
    return out.select(*keys, "n", *probs, *[
        F.greatest(F.lit(0.0), F.col(f"{name}_lt") / F.col("n") - p, p - F.col(f"{name}_le") / F.col("n")).alias(f"{name}_error")
        for name, p in probs.items()])
