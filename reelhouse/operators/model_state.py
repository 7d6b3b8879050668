"""Models kept up to date by merging partial aggregates (S13): an increment is aggregated alone and merged
into the stored state of the keys it touches; nothing else is read or written.

A state is a table of partial aggregates in key buckets (``KeyedTarget``).  ``merge`` adds a load once: every
bucket keeps the id of the last load merged into it, and a bucket is replaced as a whole, so a load that is
run again after a failure skips the buckets that have it.  Load ids ascend.

Movie ratings (M06): ``rating_cells`` counts rows by (movie, rating) with the first and last time, which gives
counts, moments, extremes and exact quantiles; bitmaps by (movie, user bucket) give the distinct users.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import as_bigint, day_boundaries, round_to
from .bitmaps import distinct_ids, id_bitmaps, merged_bitmaps
from .histograms import quantiles_from_counts
from .loads import BUCKET, KeyedTarget, staged
from .weighted import wavg, wstddev_samp

LOAD = "_load_id"


class ModelState:
    def __init__(self, base: str, keys: Sequence[str], combine: Callable[[DataFrame], DataFrame], buckets: int = 64) -> None:
        self.target = KeyedTarget(base, tuple(keys), buckets)
        self.combine = combine

    def read(self, spark: SparkSession) -> DataFrame:
        return self.target.read(spark).drop(LOAD)

    def merge(self, spark: SparkSession, partial: DataFrame, load_id: int) -> list[int]:
        """Merge the partial aggregates of one load; returns the buckets that were replaced."""
        new = self.target._bucketed(staged(partial))
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # ``buckets`` numbers at most
        if self.target.exists(spark):
            stored = self.target._stored(spark).where(F.col(BUCKET).isin(touched))
            have = {r[0] for r in stored.groupBy(BUCKET).agg(F.max(LOAD).alias("last")).where(F.col("last") >= load_id).collect()}
            touched = [b for b in touched if b not in have]
            rows = stored.drop(LOAD).unionByName(new).where(F.col(BUCKET).isin(touched))
        else:
            rows = new
        if touched:
            merged = self.target._bucketed(self.combine(rows.drop(BUCKET))).withColumn(LOAD, F.lit(load_id).cast("bigint"))
            self.target._put(merged, dynamic=self.target.exists(spark))
        return sorted(touched)


# --- movie ratings ---------------------------------------------------------------------------
CELL = ["movie_id", "rating", "rating_category"]


def rating_cells(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy(*CELL).agg(F.count(F.lit(1)).alias("cnt"), F.min("rating_datetime").alias("first_at"),
                                      F.max("rating_datetime").alias("last_at"))


def combined_cells(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*CELL).agg(F.sum("cnt").alias("cnt"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))


class MovieRatingState:
    """The state of ``movie_rating_metrics``: rating cells and user bitmaps by movie."""

    def __init__(self, base: str, buckets: int = 64) -> None:
        self.cells = ModelState(f"{base}/cells", ["movie_id"], combined_cells, buckets)
        self.users = ModelState(f"{base}/users", ["movie_id"], lambda b: merged_bitmaps(b, ["movie_id"]), buckets)

    def merge(self, spark: SparkSession, ratings: DataFrame, load_id: int) -> None:
        """Add the rows of one load."""
        rows = staged(ratings.select(*CELL, "rating_datetime", "user_id"))
        self.cells.merge(spark, rating_cells(rows), load_id)
        self.users.merge(spark, id_bitmaps(rows, ["movie_id"], "user_id"), load_id)

    def metrics(self, spark: SparkSession) -> DataFrame:
        """The columns of ``gold_movies.movie_rating_metrics``, from the state alone."""
        cells = self.cells.read(spark)
        n, x, cat = F.col("cnt"), F.col("rating"), F.col("rating_category")

        def of(category: str):
            return as_bigint(F.coalesce(F.sum(F.when(cat == category, n)), F.lit(0)))

        agg = cells.groupBy("movie_id").agg(
            as_bigint(F.sum(n)).alias("total_ratings"),
            round_to(wavg(x, n), 2).alias("avg_rating"),
            round_to(wstddev_samp(x, n), 2).alias("stddev_rating"),
            F.min(x).alias("min_rating"), F.max(x).alias("max_rating"),
            of("Excelente").alias("ratings_excelente"), of("Bom").alias("ratings_bom"),
            of("Regular").alias("ratings_regular"), of("Ruim").alias("ratings_ruim"),
            F.min("first_at").alias("first_rating_date"), F.max("last_at").alias("last_rating_date"))
        known = cells.where(x.isNotNull())
        q = quantiles_from_counts(known, ["movie_id"], "rating", [0.25, 0.5, 0.75])
        users = distinct_ids(self.users.read(spark), ["movie_id"], "total_users")
        out = agg.join(q, "movie_id", "left").join(users, "movie_id", "left")
        return out.select(
            "movie_id", F.coalesce("total_users", F.lit(0)).alias("total_users"), "total_ratings", "avg_rating", "stddev_rating",
            "min_rating", "max_rating", F.col("_q")[0].alias("rating_p25"), F.col("_q")[1].alias("rating_median"),
            F.col("_q")[2].alias("rating_p75"), "ratings_excelente", "ratings_bom", "ratings_regular", "ratings_ruim",
            "first_rating_date", "last_rating_date",
            day_boundaries(F.col("first_rating_date"), F.col("last_rating_date")).alias("days_active"))
