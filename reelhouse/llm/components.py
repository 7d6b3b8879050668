"""Connected components of a distributed edge list by alternating large-star and small-star steps.

Each round is two grouped minima and two joins on the node; nothing is collected.  Rounds
are written to the shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import tables


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Row count and order-free checksum of an edge list."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftright(h, 32))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has an edge to another; component is its smallest node."""
    now = tables.written(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "components")
    mark = _mark(now)
    while True:
        now = tables.written(_stars(now), "components")
        last, mark = mark, _mark(now)
        if last == mark:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
