"""M09 gold_user_behavior: one row per user who rated.

The reference aggregates ratings per user twice (once alone, once inner-joined to
movies).  Here both come from ONE pass: ratings left-join a per-movie flag table
(one row per movie id, so the join never multiplies ratings), then one hash
aggregate by user.  Genre counts are weighted by how many movie rows carry the
flag, which equals the inner join's row count even if the movie table repeats an
id; a user with no matched movie gets null genre columns, as the reference's
left join to its genre CTE does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_bigint, day_boundaries, pct, round_to
from ..functions.labels import favorite_genre, user_engagement_level, user_profile
from ..operators.bitmaps import distinct_ids, id_bitmaps
from ..operators.histograms import small_mode_from_counts

GENRES = ["action", "comedy", "drama", "thriller", "romance", "horror", "scifi"]
AVG_GENRES = ["action", "comedy", "drama", "thriller", "romance"]


def movie_flag_counts(movies: DataFrame) -> DataFrame:
    """One row per movie id: rows for the id and rows carrying each genre flag."""
    return movies.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f"is_{g}")).alias(f"n_{g}") for g in GENRES],
    )


def user_calendar(ratings: DataFrame) -> DataFrame:
    """Active years and months and the favourite hour and weekday (A11) of each user.

    All come from one (user, month, hour, weekday) histogram.  Each is reduced to its own rows a user before
    it is dealt by user, in a stage of its own, so no task holds the cells of its users three times at once.
    """
    cells = (ratings.groupBy("user_id", "rating_month", "hour_of_day", "day_of_week")
             .agg(F.count(F.lit(1)).alias("cnt")))
    months = cells.select("user_id", F.year("rating_month").alias("_year"), "rating_month").distinct()
    years = months.groupBy("user_id", "_year").agg(F.count("rating_month").alias("_months"))
    out = years.groupBy("user_id").agg(
        as_bigint(F.count("_year")).alias("years_active"), as_bigint(F.sum("_months")).alias("months_active"))
    for slot, name in (("hour_of_day", "favorite_hour"), ("day_of_week", "favorite_day_of_week")):
        counts = cells.groupBy("user_id", slot).agg(F.sum("cnt").alias("cnt"))
        out = out.join(small_mode_from_counts(counts, ["user_id"], slot, name), "user_id")
    return out


def user_activity(ratings: DataFrame, movies: DataFrame, calendar: bool = True) -> DataFrame:
    """Per-user rating metrics and genre preferences in one aggregation, and the distinct movies apart:
    beside a distinct count Spark keeps all other buffers for each user and movie.

    ``calendar=False`` leaves out the distinct movies and what ``user_calendar`` adds.
    """
    flags = movie_flag_counts(movies)
    r = ratings.select("user_id", "movie_id", "rating", "rating_datetime")
    j = r.join(flags, "movie_id", "left")
    rating = F.col("rating")
    matched = F.sum("n_rows")
    has_match = F.coalesce(matched, F.lit(0)) > 0

    def genre_count(g):
        return F.when(has_match, as_bigint(F.coalesce(F.sum(f"n_{g}"), F.lit(0))))

    def genre_avg(g):
        w = F.col(f"n_{g}")
        return round_to(F.sum(rating * w) / F.nullif(F.sum(w), F.lit(0)).cast("double"), 2)

    agg = j.groupBy("user_id").agg(
        as_bigint(F.count(F.lit(1))).alias("total_ratings"),
        round_to(F.avg(rating), 2).alias("avg_rating_given"),
        round_to(F.stddev_samp(rating), 2).alias("stddev_rating"),
        F.min(rating).alias("min_rating_given"),
        F.max(rating).alias("max_rating_given"),
        as_bigint(F.count_if(rating >= 4.5)).alias("ratings_5_stars"),
        as_bigint(F.count_if((rating >= 3.5) & (rating < 4.5))).alias("ratings_4_stars"),
        as_bigint(F.count_if((rating >= 2.5) & (rating < 3.5))).alias("ratings_3_stars"),
        as_bigint(F.count_if(rating < 2.5)).alias("ratings_low"),
        pct(F.count_if(rating >= 4.0), F.count(F.lit(1))).alias("pct_positive_ratings"),
        F.min("rating_datetime").alias("first_rating_date"),
        F.max("rating_datetime").alias("last_rating_date"),
        has_match.alias("has_genre_match"),
        *[genre_count(g).alias(f"{g}_count") for g in GENRES],
        *[genre_avg(g).alias(f"{g}_avg_rating") for g in AVG_GENRES],
    )
    if calendar:
        rated = ratings.groupBy("user_id").agg(as_bigint(F.count_distinct("movie_id")).alias("movies_rated"))
        agg = agg.join(rated, "user_id", "left").join(user_calendar(ratings), "user_id", "left")
    return agg.withColumn(
        "days_active", day_boundaries(F.col("first_rating_date"), F.col("last_rating_date")))


def user_rating_metrics(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    return user_activity(ratings, movies).select(
        "user_id", "total_ratings", "movies_rated", "avg_rating_given", "stddev_rating",
        "min_rating_given", "max_rating_given", "ratings_5_stars", "ratings_4_stars",
        "ratings_3_stars", "ratings_low", "pct_positive_ratings", "first_rating_date",
        "last_rating_date", "days_active", "years_active", "months_active",
        "favorite_hour", "favorite_day_of_week")


def user_genre_preferences(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Users with at least one rating of a known movie (the reference's inner-join CTE)."""
    return user_activity(ratings, movies, calendar=False).where("has_genre_match").select(
        "user_id", *[f"{g}_count" for g in GENRES], *[f"{g}_avg_rating" for g in AVG_GENRES])


def user_tag_metrics_by_bitmap(tags: DataFrame) -> DataFrame:
    """``user_tag_metrics`` without Expand: movies by bitmaps, tags and counts from (user, tag, sentiment) rows."""
    cells = tags.groupBy("user_id", "tag_normalized", "sentiment").agg(F.count(F.lit(1)).alias("cnt"))
    s, n = F.col("sentiment"), F.sum("cnt")

    def of(mood: str):
        return F.coalesce(F.sum(F.when(s == mood, F.col("cnt"))), F.lit(0))

    agg = cells.groupBy("user_id").agg(
        as_bigint(n).alias("total_tags_created"), as_bigint(F.count_distinct("tag_normalized")).alias("unique_tags_used"),
        as_bigint(of("Positivo")).alias("positive_tags"), as_bigint(of("Negativo")).alias("negative_tags"),
        pct(of("Positivo"), n).alias("pct_positive_tags"))
    movies = distinct_ids(id_bitmaps(tags, ["user_id"], "movie_id"), ["user_id"], "movies_tagged")
    out = agg.join(movies.withColumnRenamed("user_id", "_user"), F.col("user_id").eqNullSafe(F.col("_user")), "left")
    return out.select("user_id", "total_tags_created", F.coalesce("movies_tagged", F.lit(0)).alias("movies_tagged"),
                      "unique_tags_used", "positive_tags", "negative_tags", "pct_positive_tags")


def user_tag_metrics(tags: DataFrame) -> DataFrame:
    s = F.col("sentiment")
    return tags.groupBy("user_id").agg(
        as_bigint(F.count(F.lit(1))).alias("total_tags_created"),
        as_bigint(F.count_distinct("movie_id")).alias("movies_tagged"),
        as_bigint(F.count_distinct("tag_normalized")).alias("unique_tags_used"),
        as_bigint(F.count_if(s == "Positivo")).alias("positive_tags"),
        as_bigint(F.count_if(s == "Negativo")).alias("negative_tags"),
        pct(F.count_if(s == "Positivo"), F.count(F.lit(1))).alias("pct_positive_tags"),
    )


def gold_user_behavior(ratings: DataFrame, tags: DataFrame, movies: DataFrame) -> DataFrame:
    u = user_activity(ratings, movies)
    t = user_tag_metrics(tags)
    j = u.join(t, "user_id", "left")
    c = {g: F.col(f"{g}_count") for g in GENRES}
    counts_sum = c["action"] + c["comedy"] + c["drama"] + c["thriller"] + c["romance"] + c["horror"] + c["scifi"]
    top = F.greatest(*[c[g] for g in GENRES])
    return j.select(
        "user_id", "total_ratings", "movies_rated", "avg_rating_given", "stddev_rating",
        "pct_positive_ratings", "ratings_5_stars", "ratings_4_stars", "ratings_3_stars",
        "ratings_low", "first_rating_date", "last_rating_date", "days_active",
        "years_active", "months_active",
        round_to(F.col("total_ratings").cast("double") / F.nullif(F.col("days_active"), F.lit(0)).cast("double"), 2)
        .alias("ratings_per_day"),
        "favorite_hour", "favorite_day_of_week",
        *[f"{g}_count" for g in GENRES],
        "action_avg_rating", "comedy_avg_rating", "drama_avg_rating",
        favorite_genre({"Action": c["action"], "Comedy": c["comedy"], "Drama": c["drama"],
                        "Thriller": c["thriller"], "Romance": c["romance"]}).alias("favorite_genre"),
        as_bigint(F.coalesce(F.col("total_tags_created"), F.lit(0))).alias("total_tags_created"),
        as_bigint(F.coalesce(F.col("unique_tags_used"), F.lit(0))).alias("unique_tags_used"),
        F.coalesce(F.col("positive_tags"), F.lit(0)).alias("positive_tags"),
        F.coalesce(F.col("negative_tags"), F.lit(0)).alias("negative_tags"),
        user_profile(F.col("avg_rating_given")).alias("user_profile"),
        user_engagement_level(F.col("total_ratings")).alias("engagement_level"),
        round_to(counts_sum.cast("double") / F.nullif(top, F.lit(0)).cast("double"), 2)
        .alias("genre_diversity_score"),
    )
