"""Centroid clustering of integer vectors, with a vantage-point tree over the centroids.

Each round builds a vantage-point tree over the current centroids on the driver (their number is a
parameter), broadcasts it, and assigns every vector by a best-first branch-and-bound search: each
vector opens the tree node with its smallest lower bound, until no open node can hold a centroid as
near as the best one.  The pruning radius is inclusive: a node whose bound equals the best distance
is opened, so a tie is found and goes to the smaller centroid number.  Leaf distances are exact
integers; bounds are floating point and reduced by more than their rounding error, so they never
prune a centroid that is nearest.  The searches of a batch advance together, as one array operation
for each tree node that is the next one of some vectors.

Tasks add up their vectors by centroid and component before the shuffle; the driver receives one row
a centroid and component.  Vectors are written to the shared folder once, as integers.

Defined results: a vector with a null or non-finite component, another number of components, or none
is left out; a null vec_id counts as the empty id for the first centroids; rows that repeat are all kept
and may start several centroids (ties of the hash go by components, then the id); fewer vectors than
centroids give as many centroids as vectors; an empty table gives no rows.  Components whose integer
exceeds 2^27 raise an error, as 64 of them have distances beyond a bigint.  Other columns of the input
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import tables

LIMIT = 1 << 27
#: Cells of the (vector, node) bound table that one step of the search may hold.
CELLS = 1 << 21


@dataclass(frozen=True)
class Node:
    """A vantage centroid with two children, or a leaf of ``members``; low and high bound the distances to the parent's vantage."""

    members: np.ndarray
    vantage: int = -1
    children: tuple[int, ...] = ()
    low: float = 0.0
    high: float = 0.0


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one point."""
    diff = rows - point
    return np.einsum("ij,ij->i", diff, diff)


class VantageTree:
    """A vantage-point tree over the rows of ``points`` (int64)."""

    def __init__(self, points: np.ndarray, leaf: int = 4) -> None:
        self.points = points
        self.nodes: list[Node] = []
        if len(points):
            self._build(np.arange(len(points)), max(1, leaf), 0.0, 0.0)

    def _build(self, members: np.ndarray, leaf: int, low: float, high: float) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(members, low=low, high=high))
        if len(members) > leaf:
            # the member with the widest spread of distances to its fellows tells them apart best
            table = np.stack([squared(self.points[members], self.points[m]) for m in members[:64]])
            pick = int(np.argmax(np.sqrt(table.astype(np.float64)).var(axis=1)))
            rest, far = np.delete(members, pick), np.delete(table[pick], pick)
            order = np.argsort(far, kind="stable")
            rest, dist = rest[order], np.sqrt(far[order].astype(np.float64))
            half = len(rest) // 2
            children = tuple(self._build(rest[a:b], leaf, float(dist[a]), float(dist[b - 1]))
                             for a, b in ((0, half), (half, len(rest))) if b > a)
            self.nodes[at] = Node(members[pick:pick + 1], int(members[pick]), children, low, high)
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the nearest point's number (ties: the smaller) and its exact squared distance."""
        numbers = np.empty(len(vectors), dtype=np.int64)
        dists = np.empty(len(vectors), dtype=np.int64)
        step = max(1, CELLS // max(1, len(self.nodes)))
        for i in range(0, len(vectors), step):
            numbers[i:i + step], dists[i:i + step] = self._search(vectors[i:i + step])
        return numbers, dists

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(vectors)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.points), dtype=np.int64)
        bound = np.full((n, len(self.nodes)), np.inf)
        bound[:, 0] = 0.0
        rows = np.arange(n)
        while len(rows):
            node_of = bound[rows].argmin(axis=1)
            for at in np.unique(node_of).tolist():
                node, mine = self.nodes[at], rows[node_of == at]
                own = bound[mine, at]
                bound[mine, at] = np.inf
                for point in node.members.tolist():
                    d = squared(vectors[mine], self.points[point])
                    better = (d < best[mine]) | ((d == best[mine]) & (point < number[mine]))
                    hit = mine[better]
                    best[hit], number[hit] = d[better], point
                if node.children:
                    away = np.sqrt(d.astype(np.float64))
                    slack = 1e-6 + away * 1e-12
                    for child in node.children:
                        c = self.nodes[child]
                        gap = np.maximum(c.low - away, away - c.high) - slack - c.high * 1e-12
                        bound[mine, child] = np.maximum(own, gap)
            # inclusive: a bound equal to the best distance may still hold a tie
            radius = np.sqrt(best[rows].astype(np.float64)) * (1 + 1e-12) + 1e-6
            rows = rows[bound[rows].min(axis=1) <= radius]
        return number, best


def _kept(vector: Column, size: int) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | F.abs(x.cast("double")).isin(float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & ~bad


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 256) -> DataFrame:
    """(vec_id, q): the kept vectors with each component x as the integer floor(scale * x)."""
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(_kept(F.col("v"), size))

    def integer(x: Column) -> Column:
        y = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.when(F.abs(y) > LIMIT, F.raise_error(F.lit("a component exceeds 2^27"))).otherwise(y).cast("long")

    return own.select("vec_id", F.transform("v", integer).alias("q"))


def seeds(points: DataFrame, k: int, salt: str) -> np.ndarray:
    """The first centroids: the ``k`` vectors with the smallest sha256 of ``<salt>:<vec_id>``."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.select(key.alias("h"), "q", "vec_id").orderBy("h", "q", F.col("vec_id").asc_nulls_last()).limit(k).collect()
    return np.array([r.q for r in rows], dtype=np.int64)


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, size)


def _sums(points: DataFrame, tree, size: int) -> DataFrame:
    """(cluster, component, total, n): sums by centroid, added up in the tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = tree.value
        total, count = np.zeros((len(found.points), size), dtype=np.int64), np.zeros(len(found.points), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                q = _matrix(batch.column(0), size)
                number, _ = found.nearest(q)
                np.add.at(total, number, q)
                count += np.bincount(number, minlength=len(count))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, size), pa.int32()), pa.array(np.tile(np.arange(size), len(used)), pa.int32()),
             pa.array(total[used].ravel(), pa.int64()), pa.array(np.repeat(count[used], size), pa.int64())],
            names=["cluster", "component", "total", "n"])

    parts = points.select("q").mapInArrow(run, "cluster int, component int, total long, n long")
    return parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n"))


def _assigned(points: DataFrame, tree, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = tree.value
        for batch in batches:
            number, dist = found.nearest(_matrix(batch.column(1), size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), pa.array(dist, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return points.select("vec_id", "q").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(points: DataFrame, k: int = 40, rounds: int = 5, salt: str = "2", size: int = 64, leaf: int = 4) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every row of ``points`` (vec_id, q), and the final centroids.

    The driver holds ``k`` centroids of ``size`` integers and nothing else.
    """
    spark = points.sparkSession
    tables.ship(spark)
    centroids = seeds(points, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids.reshape(0, size)
    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(VantageTree(centroids, leaf))
        centroids = centroids.copy()
        for r in _sums(points, tree, size).collect():
            centroids[r.cluster, r.component] = int(r.total) // r.n  # floor, also below zero
        tree.unpersist()
    return _assigned(points, spark.sparkContext.broadcast(VantageTree(centroids, leaf)), size), centroids


def report(vectors: DataFrame, k: int = 40, rounds: int = 5, salt: str = "2", size: int = 64, scale: int = 256,
           vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row a kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    points = tables.written(quantised(vectors, vec_id, vector, size, scale), "vectors")
    found, centroids = cluster(points, k, rounds, salt, size)
    found = tables.written(found, "clusters")
    inertia = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}
    rows = [(i, inertia.get(i, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(centroids.tolist())]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row a centroid, and their number is a parameter
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
