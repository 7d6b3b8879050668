"""Old/new load batches derived from ``orders`` (for the load operators).

``old``: orders before 1997 (the table as loaded).  ``new``: orders from mid-1996
with a changed status, price and priority; every tenth key also appears a second
time one day later (a newer version of the same key).  The overlap (second half
of 1996) are updates, the rest inserts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# ---- fixed values of the batch split ------------------------------------------
OLD_BEFORE = "1997-01-01"
NEW_FROM = "1996-07-01"
NEW_STATUS, NEW_PRIORITY = "U", "X-NEW"
LATE_STATUS, LATE_PRIORITY = "L", "X-LATE"
LATE_KEY_MOD = 10
# -------------------------------------------------------------------------------

ORDER_KEY = ["o_orderkey"]
ORDER_CURSOR = "o_orderdate"


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def orders_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = read_table(spark, sf_dir, "orders")
    cols = orders.columns
    old = orders.where(F.col("o_orderdate") < _ts(OLD_BEFORE))
    recent = orders.where(F.col("o_orderdate") >= _ts(NEW_FROM))
    updated = recent.withColumns({
        "o_orderstatus": F.lit(NEW_STATUS),
        "o_totalprice": F.col("o_totalprice") + F.lit(1.0),
        "o_orderpriority": F.lit(NEW_PRIORITY),
    }).select(*cols)
    late = recent.where(F.col("o_orderkey") % LATE_KEY_MOD == 0).withColumns({
        "o_orderstatus": F.lit(LATE_STATUS),
        "o_totalprice": F.col("o_totalprice") + F.lit(2.0),
        "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"),
        "o_orderpriority": F.lit(LATE_PRIORITY),
    }).select(*cols)
    return old, updated.unionByName(late)


def late_rows_missing(old: DataFrame) -> DataFrame:
    """``old`` as a load left it before some rows with the last cursor value arrived."""
    last = old.select(F.max(ORDER_CURSOR)).scalar()
    return old.where(~((F.col(ORDER_CURSOR) == last) & (F.col("o_orderkey") % 4 == 0)))


def overlapping(spark: SparkSession, sf_dir: str, new: DataFrame) -> DataFrame:
    """A source that holds unchanged orders (even keys) and changed ones (odd keys) from mid-1996 on."""
    orders = read_table(spark, sf_dir, "orders")
    same = orders.where((F.col("o_orderdate") >= _ts(NEW_FROM)) & (F.col("o_orderkey") % 2 == 0))
    return same.unionByName(new.where(F.col("o_orderkey") % 2 == 1))
