"""M08 gold_temporal_trends: one row per rating month.

Plan: ratings join a slim movie projection (six columns; broadcast by Spark only
when its estimated size is under the broadcast threshold, otherwise a
sort-merge join with AQE skew splitting), then one hash aggregate by month with
partial (map-side) aggregation.  The two distinct counts are planned by Catalyst
as Expand + two-level aggregation keyed by (month, value), so a month holding a
third of all rows is still spread over many tasks.  ``distinct="bitmap"`` gives the same
numbers without Expand: ratings are reduced to (month, movie) before the join, and users
are counted by one bitmap per month and bucket of user ids.  The window functions run on
the monthly aggregate, whose size is bounded by the number of months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_bigint, distinct_count, pct, round_to, safe_ratio
from ..operators.bitmaps import distinct_ids, id_bitmaps


def _count_if(cond):
    return as_bigint(F.count_if(cond))


GENRES = ["action", "comedy", "drama", "thriller", "romance"]
DECADES = [1990, 2000, 2010]


def _monthly_from_month_movie(ratings: DataFrame, movies: DataFrame, distinct: str) -> DataFrame:
    """The form that aggregates before the join.

    Ratings are reduced to one row per (month, movie) with counts, sums and, for ``approx``, an HLL
    sketch of the users; only those rows meet the movie table (one row per movie
    id, weighted by how many movie rows carry each flag, which equals the inner
    join's row counts).  Per month: sums, the number of (month, movie) rows
    (= distinct movies) and the union of the user sketches.  For ``bitmap`` the users of
    ratings of known movies are counted exactly in a narrow branch of their own.
    """
    sketch = [F.hll_sketch_agg("user_id").alias("users")] if distinct == "approx" else []
    x = F.col("rating")
    pre = ratings.groupBy(F.col("rating_month").alias("month"), "movie_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("s"),
        F.count_if(x >= 4.5).alias("c_ex"), F.count_if((x >= 3.5) & (x < 4.5)).alias("c_go"),
        F.count_if((x >= 2.5) & (x < 3.5)).alias("c_av"), F.count_if(x < 2.5).alias("c_po"),
        *sketch)
    flags = movies.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("w"),
        *[F.count_if(F.col(f"is_{g}")).alias(f"w_{g}") for g in GENRES],
        *[F.count_if(F.col("decade") == d).alias(f"w_{d}") for d in DECADES])
    j = pre.join(flags, "movie_id")
    n, sm, w = F.col("n"), F.col("s"), F.col("w")

    def wsum(c, weight):
        return as_bigint(F.sum(c * weight))

    def wavg(weight):
        return round_to(F.sum(sm * weight) / F.nullif(F.sum(n * weight), F.lit(0)).cast("double"), 2)

    users = [F.hll_sketch_estimate(F.hll_union_agg("users")).cast("bigint").alias("active_users")] if sketch else []
    out = j.groupBy("month").agg(
        wsum(n, w).alias("total_ratings"),
        *users,
        F.count(F.lit(1)).cast("bigint").alias("movies_rated"),
        wavg(w).alias("avg_rating"),
        wsum(F.col("c_ex"), w).alias("ratings_excellent"),
        wsum(F.col("c_go"), w).alias("ratings_good"),
        wsum(F.col("c_av"), w).alias("ratings_average"),
        wsum(F.col("c_po"), w).alias("ratings_poor"),
        *[wsum(n, F.col(f"w_{g}")).alias(f"{g}_ratings") for g in GENRES],
        *[wavg(F.col(f"w_{g}")).alias(f"{g}_avg_rating") for g in ("action", "comedy", "drama")],
        *[wsum(n, F.col(f"w_{d}")).alias(f"ratings_{d}s") for d in DECADES],
    ).withColumns({
        "year": as_bigint(F.year("month")),
        "month_num": as_bigint(F.month("month")),
    })
    if distinct == "bitmap":
        known = ratings.join(movies.select("movie_id"), "movie_id", "left_semi")
        bitmaps = id_bitmaps(known.withColumn("month", F.col("rating_month")), ["month"], "user_id")
        counted = distinct_ids(bitmaps, ["month"], "active_users").select(F.col("month").alias("_month"), "active_users")
        # months without any user id have no bitmap
        out = out.join(counted, F.col("month").eqNullSafe(F.col("_month")), "left").drop("_month")
        out = out.withColumn("active_users", F.coalesce("active_users", F.lit(0)))
    return out


def monthly_metrics(ratings: DataFrame, movies: DataFrame, distinct: str = "exact") -> DataFrame:
    """Per-month metrics.  ``distinct="approx"`` and ``"bitmap"`` aggregate per (month, movie) before
    the join and count users with sketches or bitmaps (see ``_monthly_from_month_movie``)."""
    if distinct in ("approx", "bitmap"):
        return _monthly_from_month_movie(ratings, movies, distinct)
    m = movies.select("movie_id", "is_action", "is_comedy", "is_drama", "is_thriller",
                      "is_romance", "decade")
    r = ratings.select("movie_id", "user_id", "rating", F.col("rating_month").alias("month"))
    j = r.join(m, "movie_id")
    rating = F.col("rating")
    return j.groupBy("month").agg(
        as_bigint(F.count(F.lit(1))).alias("total_ratings"),
        distinct_count("user_id", distinct).alias("active_users"),
        distinct_count("movie_id", distinct).alias("movies_rated"),
        round_to(F.avg(rating), 2).alias("avg_rating"),
        _count_if(rating >= 4.5).alias("ratings_excellent"),
        _count_if((rating >= 3.5) & (rating < 4.5)).alias("ratings_good"),
        _count_if((rating >= 2.5) & (rating < 3.5)).alias("ratings_average"),
        _count_if(rating < 2.5).alias("ratings_poor"),
        _count_if(F.col("is_action")).alias("action_ratings"),
        _count_if(F.col("is_comedy")).alias("comedy_ratings"),
        _count_if(F.col("is_drama")).alias("drama_ratings"),
        _count_if(F.col("is_thriller")).alias("thriller_ratings"),
        _count_if(F.col("is_romance")).alias("romance_ratings"),
        round_to(F.avg(F.when(F.col("is_action"), rating)), 2).alias("action_avg_rating"),
        round_to(F.avg(F.when(F.col("is_comedy"), rating)), 2).alias("comedy_avg_rating"),
        round_to(F.avg(F.when(F.col("is_drama"), rating)), 2).alias("drama_avg_rating"),
        _count_if(F.col("decade") == 1990).alias("ratings_1990s"),
        _count_if(F.col("decade") == 2000).alias("ratings_2000s"),
        _count_if(F.col("decade") == 2010).alias("ratings_2010s"),
    ).withColumns({
        "year": as_bigint(F.year("month")),
        "month_num": as_bigint(F.month("month")),
    })


def with_trends(monthly: DataFrame) -> DataFrame:
    """Growth (W03 lag), 3-month moving averages (W04) and global ranks.

    One partition by design: the input has one row per month.  Ranks break ties
    on the month so they are deterministic.
    """
    by_month = Window.orderBy("month")
    ma3 = by_month.rowsBetween(-2, Window.currentRow)

    def growth(c):
        prev = F.lag(c).over(by_month)
        return round_to(F.lit(100.0) * (F.col(c) - prev).cast("double") / F.nullif(prev, F.lit(0)).cast("double"), 2)

    return monthly.select(
        "*",
        growth("total_ratings").alias("ratings_growth_pct"),
        growth("active_users").alias("users_growth_pct"),
        round_to(F.avg("total_ratings").over(ma3), 2).alias("ratings_ma3"),
        round_to(F.avg("active_users").over(ma3), 2).alias("users_ma3"),
        round_to(F.avg("avg_rating").over(ma3), 2).alias("avg_rating_ma3"),
        F.row_number().over(Window.orderBy(F.desc("total_ratings"), F.asc("month"))).alias("rank_by_ratings"),
        F.row_number().over(Window.orderBy(F.desc("active_users"), F.asc("month"))).alias("rank_by_users"),
        pct(F.col("action_ratings"), F.col("total_ratings")).alias("action_pct"),
        pct(F.col("comedy_ratings"), F.col("total_ratings")).alias("comedy_pct"),
        pct(F.col("drama_ratings"), F.col("total_ratings")).alias("drama_pct"),
    )


def gold_temporal_trends(ratings: DataFrame, movies: DataFrame, distinct: str = "exact") -> DataFrame:
    return with_trends(monthly_metrics(ratings, movies, distinct)).orderBy(F.desc("month"))
