"""Aggregates over implicitly repeated rows (a row with weight w stands for w copies).

Used to evaluate a one-to-many-twice join (ratings x tags per movie) without
materialising the product: each side is pre-aggregated per key and weighted by
the other side's row count.  Counts and sums are exact; the sample standard
deviation comes from the weighted first and second moments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wcount(w: Column, cond: Column | None = None) -> Column:
    """``count(*)`` (or ``sum(case when cond then 1 else 0 end)``) over the repeated rows."""
    term = w if cond is None else F.when(cond, w).otherwise(F.lit(0))
    return F.coalesce(F.sum(term), F.lit(0)).cast("bigint")


def wavg(x: Column, w: Column) -> Column:
    return F.sum(x * w) / F.nullif(F.sum(F.when(x.isNotNull(), w)), F.lit(0)).cast("double")


def wstddev_samp(x: Column, w: Column) -> Column:
    """Sample standard deviation of the repeated values; null for fewer than two."""
    n = F.sum(F.when(x.isNotNull(), w)).cast("double")
    s1 = F.sum(x * w)
    s2 = F.sum(x * x * w)
    var = (s2 - s1 * s1 / n) / F.nullif(n - F.lit(1.0), F.lit(0.0))
    # greatest() skips nulls, so keep the null (fewer than two values) explicitly
    return F.when(var.isNotNull(), F.sqrt(F.greatest(var, F.lit(0.0))))
