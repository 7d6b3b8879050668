"""M05 gold_genre_analytics: one row per genre.

The reference joins each exploded (movie, genre) row to ALL ratings and ALL tags
of the movie, so every rating is counted once per tag of its movie and every tag
once per rating.  ``fanout="reference"`` reproduces those numbers without forming
the product:

* per movie: rating counts by rating value (one pass over ratings, partial
  aggregation, a few rows per movie), rating count ``n_r``, tag counts ``n_t``;
* each rating value row is weighted by ``k * max(n_t, 1)`` (``k`` = times the
  genre occurs in the movie's genre text), each tag by ``k * max(n_r, 1)`` and each
  movie row by ``k * max(n_r, 1) * max(n_t, 1)``;
* distinct users / tags per genre come from the unweighted (genre, movie) join.

``fanout="dedup"`` counts each rating and tag once per genre and each movie once.
All per-genre frames are tiny (one row per genre) and join on ``genre``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_bigint, distinct_count, round_to, split_pipe
from ..functions.labels import genre_popularity_tier, genre_quality_tier, genre_score
from ..operators.quantiles import quantiles
from ..operators.weighted import wavg, wcount, wstddev_samp

NO_GENRES = "(no genres listed)"  # fixed value: excluded from genre analytics
DECADES = [1990, 2000, 2010]


def genre_exploded(movies: DataFrame) -> DataFrame:
    """One row per genre occurrence (repeats kept, no-genre movies dropped)."""
    return movies.where(F.col("genres") != F.lit(NO_GENRES)).select(
        "movie_id", "title_clean", "release_year", "decade",
        F.explode(split_pipe(F.col("genres"))).alias("genre"))


def genre_counts(movies: DataFrame) -> DataFrame:
    """Movies and decades per genre (the unweighted part of M05)."""
    return genre_exploded(movies).groupBy("genre").agg(
        as_bigint(F.count_distinct("movie_id")).alias("total_movies"),
        as_bigint(F.count_distinct("decade")).alias("decades_active"),
        F.min("release_year").alias("first_movie_year"),
        F.max("release_year").alias("last_movie_year"),
    )


def _genre_rows(movies: DataFrame, fanout: str) -> DataFrame:
    """(genre, movie_id, release_year, decade, k) with k = occurrences (1 in dedup mode)."""
    ge = genre_exploded(movies)
    keys = ["genre", "movie_id", "release_year", "decade"]
    if fanout == "reference":
        return ge.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"))
    if fanout == "dedup":
        return ge.select(*keys).distinct().withColumn("k", F.lit(1).cast("bigint"))
    raise ValueError(f"unknown fanout mode: {fanout!r}")


def _sketch_per_genre(facts: DataFrame, value: str, genre_movie: DataFrame, alias: str) -> DataFrame:
    per_movie = facts.groupBy("movie_id").agg(F.hll_sketch_agg(value).alias("_sk"))
    return (per_movie.join(genre_movie, "movie_id").groupBy("genre")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("_sk")).cast("bigint").alias(alias)))


def genre_metrics(movies: DataFrame, ratings: DataFrame, tags: DataFrame,
                  fanout: str = "reference", quantile_mode: str = "exact", distinct: str = "exact") -> DataFrame:
    ref = fanout == "reference"
    rows = _genre_rows(movies, fanout)
    genre_movie = rows.select("genre", "movie_id").distinct()

    # per-movie pre-aggregates (the only passes over the fact tables)
    by_value = ratings.groupBy("movie_id", "rating").agg(F.count(F.lit(1)).alias("cnt"))
    n_r = by_value.groupBy("movie_id").agg(F.sum("cnt").alias("n_r"))
    t = F.col("sentiment")
    per_tag = tags.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("n_t"),
        F.count_if(t == "Positivo").alias("pos_t"),
        F.count_if(t == "Negativo").alias("neg_t"),
    )

    w_rows = (rows.join(n_r, "movie_id", "left").join(per_tag, "movie_id", "left")
              .withColumns({
                  "n_r": F.coalesce("n_r", F.lit(0)),
                  "n_t": F.coalesce("n_t", F.lit(0)),
                  "pos_t": F.coalesce("pos_t", F.lit(0)),
                  "neg_t": F.coalesce("neg_t", F.lit(0)),
              })
              .withColumns({
                  "rw": F.greatest("n_r", F.lit(1)) if ref else F.lit(1),
                  "tw": F.greatest("n_t", F.lit(1)) if ref else F.lit(1),
              }))

    k, rw, tw = F.col("k"), F.col("rw"), F.col("tw")
    decade = F.col("decade")
    if ref:
        dec_aggs = [wcount(k * rw * tw, decade == d).alias(f"movies_{d}s") for d in DECADES]
    else:
        dec_aggs = [as_bigint(F.count_distinct(F.when(decade == d, F.col("movie_id")))).alias(f"movies_{d}s")
                    for d in DECADES]
    base = w_rows.groupBy("genre").agg(
        as_bigint(F.count_distinct("movie_id")).alias("total_movies"),
        as_bigint(F.count_distinct("decade")).alias("decades_active"),
        F.min("release_year").alias("first_movie_year"),
        F.max("release_year").alias("last_movie_year"),
        wcount(k * rw * F.col("pos_t")).alias("positive_tags"),
        wcount(k * rw * F.col("neg_t")).alias("negative_tags"),
        wcount(k * rw * F.col("n_t")).alias("tag_rows"),
        *dec_aggs,
    )

    # rating side: one row per (genre, movie, rating value), weight = k * tw * count
    rv = w_rows.select("genre", "movie_id", "k", "tw").join(by_value, "movie_id")
    x, w = F.col("rating"), F.col("k") * F.col("tw") * F.col("cnt")
    rating_part = rv.groupBy("genre").agg(
        wcount(w).alias("total_ratings"),
        round_to(wavg(x, w), 2).alias("avg_rating"),
        round_to(wstddev_samp(x, w), 2).alias("stddev_rating"),
        quantiles(x, [0.5], quantile_mode, weight=w)[0].alias("median_rating"),
        wcount(w, x >= 4.5).alias("excellent_ratings"),
        wcount(w, (x >= 3.5) & (x < 4.5)).alias("good_ratings"),
        wcount(w, (x >= 2.5) & (x < 3.5)).alias("average_ratings"),
        wcount(w, x < 2.5).alias("poor_ratings"),
        wcount(w, x >= 4.0).alias("_positive"),
    )

    if distinct == "approx":
        # one sketch per movie, joined to the (genre, movie) list and unioned per
        # genre: the raw ratings and tags never meet the genre table
        users = _sketch_per_genre(ratings, "user_id", genre_movie, "total_users")
        uniq_tags = _sketch_per_genre(tags, "tag_normalized", genre_movie, "unique_tags")
    else:
        users = (ratings.select("movie_id", "user_id").join(genre_movie, "movie_id")
                 .groupBy("genre").agg(distinct_count("user_id", distinct).alias("total_users")))
        uniq_tags = (tags.select("movie_id", "tag_normalized").join(genre_movie, "movie_id")
                     .groupBy("genre").agg(distinct_count("tag_normalized", distinct).alias("unique_tags")))

    j = (base.join(rating_part, "genre", "left").join(users, "genre", "left")
         .join(uniq_tags, "genre", "left"))
    total_ratings = F.coalesce("total_ratings", F.lit(0)).cast("bigint")
    movies_d = F.col("total_movies").cast("double")
    zero = F.lit(0).cast("bigint")
    return j.select(
        "genre", "total_movies", "decades_active", "first_movie_year", "last_movie_year",
        total_ratings.alias("total_ratings"),
        F.coalesce("total_users", zero).alias("total_users"),
        "avg_rating", "stddev_rating", "median_rating",
        *[F.coalesce(c, zero).alias(c) for c in
          ("excellent_ratings", "good_ratings", "average_ratings", "poor_ratings")],
        round_to(F.lit(100.0) * F.col("_positive").cast("double")
                 / F.nullif(total_ratings, F.lit(0)).cast("double"), 2).alias("pct_positive"),
        F.coalesce("unique_tags", zero).alias("unique_tags"),
        "positive_tags", "negative_tags",
        round_to(total_ratings.cast("double") / F.nullif(movies_d, F.lit(0.0)), 2).alias("avg_ratings_per_movie"),
        round_to(F.col("tag_rows").cast("double") / F.nullif(movies_d, F.lit(0.0)), 2).alias("avg_tags_per_movie"),
        "movies_1990s", "movies_2000s", "movies_2010s",
    )


def with_rankings(metrics: DataFrame) -> DataFrame:
    """W01 ranks on the per-genre table (one row per genre: a single small partition)."""
    def rank(c):
        return F.row_number().over(Window.orderBy(F.desc(c), F.asc("genre")))

    return metrics.select(
        "*",
        rank("total_movies").alias("rank_by_movies"),
        rank("total_ratings").alias("rank_by_ratings"),
        rank("avg_rating").alias("rank_by_quality"),
        rank("avg_ratings_per_movie").alias("rank_by_engagement"),
        genre_quality_tier(F.col("avg_rating")).alias("quality_tier"),
        genre_popularity_tier(F.col("total_ratings")).alias("popularity_tier"),
        genre_score(F.col("avg_rating"), F.col("total_ratings"), F.col("avg_ratings_per_movie")).alias("genre_score"),
    )


def gold_genre_analytics(movies: DataFrame, ratings: DataFrame, tags: DataFrame,
                         fanout: str = "reference", quantile_mode: str = "exact",
                         distinct: str = "exact") -> DataFrame:
    metrics = genre_metrics(movies, ratings, tags, fanout, quantile_mode, distinct)
    return with_rankings(metrics).orderBy(F.desc("total_ratings"), "genre")
