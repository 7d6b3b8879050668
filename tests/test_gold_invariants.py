"""Gold-layer invariants on sf0.001 and edge cases on hand fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from reelhouse.plans import gold_genres, gold_movies, gold_temporal, gold_users
from reelhouse.plans.registry import SilverFrames


@pytest.fixture(scope="module")
def s(spark):
    return SilverFrames(spark, SF_SMALL)


def _in_range(df, cols, lo=0.0, hi=100.0):
    for c in cols:
        bad = df.where(F.col(c).isNotNull() & ((F.col(c) < lo) | (F.col(c) > hi))).count()
        assert bad == 0, c


def test_percent_columns_in_range(s):
    m, r, t = s["silver_movies"], s["silver_ratings"], s["silver_tags"]
    _in_range(gold_temporal.gold_temporal_trends(r, m), ["action_pct", "comedy_pct", "drama_pct"])
    _in_range(gold_users.gold_user_behavior(r, t, m), ["pct_positive_ratings"])
    _in_range(gold_users.user_tag_metrics(t), ["pct_positive_tags"])
    _in_range(gold_genres.gold_genre_analytics(m, r, t), ["pct_positive"])


def test_label_counts_sum_to_totals(s):
    m, r, t = s["silver_movies"], s["silver_ratings"], s["silver_tags"]
    mm = gold_movies.movie_rating_metrics(r)
    assert mm.where(F.col("ratings_excelente") + F.col("ratings_bom") + F.col("ratings_regular")
                    + F.col("ratings_ruim") != F.col("total_ratings")).count() == 0
    tr = gold_temporal.monthly_metrics(r, m)
    assert tr.where(F.col("ratings_excellent") + F.col("ratings_good") + F.col("ratings_average")
                    + F.col("ratings_poor") != F.col("total_ratings")).count() == 0
    ub = gold_users.gold_user_behavior(r, t, m)
    assert ub.where(F.col("ratings_5_stars") + F.col("ratings_4_stars") + F.col("ratings_3_stars")
                    + F.col("ratings_low") != F.col("total_ratings")).count() == 0
    ga = gold_genres.gold_genre_analytics(m, r, t)
    assert ga.where(F.col("excellent_ratings") + F.col("good_ratings") + F.col("average_ratings")
                    + F.col("poor_ratings") != F.col("total_ratings")).count() == 0
    # every rating belongs to exactly one month
    assert tr.agg(F.sum("total_ratings")).first()[0] == r.join(m.select("movie_id"), "movie_id").count()


def test_ranks_are_permutations(s):
    m, r, t = s["silver_movies"], s["silver_ratings"], s["silver_tags"]
    ga = gold_genres.gold_genre_analytics(m, r, t)
    n = ga.count()
    for c in ["rank_by_movies", "rank_by_ratings", "rank_by_quality", "rank_by_engagement"]:
        assert sorted(x[0] for x in ga.select(c).collect()) == list(range(1, n + 1))


def test_movie_and_user_edge_cases(spark):
    movies = spark.createDataFrame(
        [(1, "One", 1999, 1990.0, "Drama", 1, True, False, True, False, False, False, False),
         (2, "None", None, None, "Comedy", 1, False, True, False, False, False, False, False)],
        "movie_id bigint, title_clean string, release_year int, decade double, genres string, genres_count bigint, "
        "is_action boolean, is_comedy boolean, is_drama boolean, is_thriller boolean, is_romance boolean, "
        "is_horror boolean, is_scifi boolean")
    ts = dt.datetime(2020, 5, 1, 12, 0)
    ratings = spark.createDataFrame(
        [(7, 1, 4.0, "Bom", ts, dt.datetime(2020, 1, 1), dt.datetime(2020, 5, 1), 12, 5),
         (8, 99, 2.0, "Ruim", ts, dt.datetime(2020, 1, 1), dt.datetime(2020, 5, 1), 12, 5)],
        "user_id bigint, movie_id bigint, rating double, rating_category string, rating_datetime timestamp, "
        "rating_year timestamp, rating_month timestamp, hour_of_day bigint, day_of_week bigint")
    tags = spark.createDataFrame([], "user_id bigint, movie_id bigint, tag_normalized string, sentiment string")
    ma = {x.movie_id: x for x in gold_movies.gold_movie_analytics(movies, ratings, tags).collect()}
    assert ma[1].stddev_rating is None and ma[1].total_ratings == 1 and ma[1].days_active == 0
    assert ma[2].total_ratings == 0 and ma[2].avg_rating is None and ma[2].popularity_score == 0.0
    assert ma[2].quality_tier == "Pouco Avaliado" and ma[2].engagement_level == "Muito Baixo"
    ub = {x.user_id: x for x in gold_users.gold_user_behavior(ratings, tags, movies).collect()}
    assert ub[7].ratings_per_day is None                  # zero days active
    assert ub[7].favorite_genre == "Action" and ub[7].genre_diversity_score == 2.0
    # user 8 rated only an unknown movie: no genre row, so counts are null
    assert ub[8].action_count is None and ub[8].favorite_genre == "Romance"
    assert ub[8].genre_diversity_score is None and ub[8].total_tags_created == 0


def test_user_buffers_are_not_kept_for_each_movie(spark):
    ratings = spark.sql("""
        select id % 5 as user_id, id % 3 as movie_id, cast(id % 9 as double) / 2 as rating, t as rating_datetime,
               date_trunc('month', t) as rating_month, cast(hour(t) as bigint) as hour_of_day, cast(dayofweek(t) - 1 as bigint) as day_of_week
        from (select id, timestamp'2019-11-03 00:00:00' + make_interval(0, id % 4, 0, 0, id % 7) as t from range(60))""")
    movies = spark.createDataFrame([(0, *[True] * 7), (2, *[False] * 7)], "movie_id bigint, " + ", ".join(
        f"is_{g} boolean" for g in gold_users.GENRES))
    df = gold_users.user_rating_metrics(ratings, movies)
    want = ratings.groupBy("user_id").agg(F.count_distinct("movie_id"), F.count_distinct("rating_month"), F.count_distinct(F.year("rating_month")),
                                          F.mode("hour_of_day", True), F.mode("day_of_week", True))
    got = df.select("user_id", "movies_rated", "months_active", "years_active", "favorite_hour", "favorite_day_of_week")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in plan.splitlines() if "Aggregate(" in x and "stddev" in x]
    assert wide and not [x for x in wide if "movie_id" in x.split("functions=")[0]]
    assert "REPARTITION_BY_COL" not in plan


APPROX_COLS = {
    "temporal": ["active_users", "movies_rated"],
    "genres": ["total_users", "unique_tags"],
}


def _builders(s, distinct):
    m, r, t = s["silver_movies"], s["silver_ratings"], s["silver_tags"]
    return {
        "temporal": (gold_temporal.gold_temporal_trends(r, m, distinct=distinct), "month"),
        "genres": (gold_genres.genre_metrics(m, r, t, distinct=distinct), "genre"),
    }


def test_approx_distinct_option(spark):
    import contextlib
    import io

    s = SilverFrames(spark, "/root/testdata/sf0.01")
    exact, approx = _builders(s, "exact"), _builders(s, "approx")
    for name, (df_e, key) in exact.items():
        df_a = approx[name][0]
        a = {r[key]: r for r in df_a.collect()}
        for r in df_e.collect():
            other = a[r[key]]
            for c in df_e.columns:
                if c in APPROX_COLS[name]:
                    assert abs(other[c] - r[c]) <= max(2, 0.05 * r[c]), (name, c, r[c], other[c])
                elif c not in ("rank_by_ratings", "rank_by_users", "users_growth_pct", "users_ma3"):
                    assert other[c] == r[c], (name, c)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        approx["temporal"][0].explain()
    assert "Expand" not in buf.getvalue()
