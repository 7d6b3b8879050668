"""The two composite rewrites equal their naive forms (fan-out join, movie pairs)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from reelhouse.plans import gold_genres as G
from reelhouse.plans import gold_recommendations as RC
from reelhouse.plans.registry import SilverFrames


@pytest.fixture(scope="module")
def silver(spark):
    return SilverFrames(spark, SF_SMALL)


def test_weighted_fanout_equals_naive_join(spark, silver):
    m, r, t = silver["silver_movies"], silver["silver_ratings"], silver["silver_tags"]
    ge = G.genre_exploded(m).alias("ge")
    naive = (ge.join(r.alias("r"), F.col("ge.movie_id") == F.col("r.movie_id"), "left")
               .join(t.alias("t"), F.col("ge.movie_id") == F.col("t.movie_id"), "left")
               .groupBy("ge.genre").agg(
                   F.count("r.rating").alias("total_ratings"),
                   F.count("t.tag_normalized").alias("tag_rows"),
                   F.count_if(F.col("t.sentiment") == "Positivo").alias("positive_tags"),
                   F.count_if(F.col("ge.decade") == 1990).alias("movies_1990s"),
                   F.percentile("r.rating", 0.5).alias("median_rating"),
                   F.count_distinct("r.user_id").alias("total_users")))
    fast = G.genre_metrics(m, r, t).select(
        "genre", "total_ratings",
        F.round(F.col("avg_tags_per_movie") * F.col("total_movies")).cast("bigint").alias("tag_rows_approx"),
        "positive_tags", "movies_1990s", "median_rating", "total_users")
    a = {x.genre: x for x in naive.collect()}
    b = {x.genre: x for x in fast.collect()}
    assert set(a) == set(b)
    for g in a:
        assert (a[g].total_ratings, a[g].positive_tags, a[g].movies_1990s, a[g].total_users) == \
               (b[g].total_ratings, b[g].positive_tags, b[g].movies_1990s, b[g].total_users)
        assert a[g].median_rating == b[g].median_rating


def _naive_recs(stats):
    s1, s2 = stats.alias("m1"), stats.alias("m2")
    g1 = F.split(F.col("m1.genres"), r"\|")
    g2 = F.split(F.col("m2.genres"), r"\|")
    common = F.size(F.array_intersect(g1, g2))
    jac = common.cast("double") / F.size(F.array_union(g1, g2)).cast("double")
    from reelhouse.functions.exprs import round_to
    from reelhouse.functions.labels import recommendation_score
    from pyspark.sql import Window
    pairs = (s1.crossJoin(s2)
             .where((F.col("m1.movie_id") != F.col("m2.movie_id")) & (common > 0))
             .select(F.col("m1.movie_id").alias("movie_id"), F.col("m2.movie_id").alias("similar_movie_id"),
                     F.col("m2.rating_count").alias("cnt"),
                     round_to(jac, 3).alias("sim"),
                     recommendation_score(jac, F.abs(F.col("m1.release_year") - F.col("m2.release_year")),
                                          F.col("m2.avg_rating")).alias("score"))
             .where(F.col("sim") >= 0.3))
    w = Window.partitionBy("movie_id").orderBy(F.desc("score"), F.desc("cnt"), F.asc("similar_movie_id"))
    return pairs.withColumn("rank", F.row_number().over(w)).where("rank <= 10") \
                .select("movie_id", "similar_movie_id", "score", "rank")


def test_recommendations_equal_cross_join(spark, silver):
    m, r = silver["silver_movies"], silver["silver_ratings"]
    fast = RC.gold_movie_recommendations(m, r).select(
        "movie_id", "similar_movie_id", F.col("recommendation_score").alias("score"),
        F.col("recommendation_rank").alias("rank"))
    assert rows(fast) == rows(_naive_recs(RC.movie_stats(m, r)))


def test_recommendations_edge_fixture(spark):
    """Ties, missing years, no-genre movies and groups larger than the candidate cut."""
    movies = spark.createDataFrame(
        [(i, f"t{i}", None if i % 7 == 0 else 1990 + i % 3,
          "(no genres listed)" if i % 11 == 0 else ("A|B" if i % 2 else "B|A|A"), ) for i in range(1, 60)],
        "movie_id bigint, title_clean string, release_year int, genres string")
    ratings = spark.createDataFrame(
        [(u, i, 4.0 if (i + u) % 3 else 3.5) for i in range(1, 60) for u in range(10 + i % 4)],
        "user_id bigint, movie_id bigint, rating double")
    fast = RC.gold_movie_recommendations(movies, ratings).select(
        "movie_id", "similar_movie_id", F.col("recommendation_score").alias("score"),
        F.col("recommendation_rank").alias("rank"))
    assert rows(fast) == rows(_naive_recs(RC.movie_stats(movies, ratings)))


def test_recommendations_dense_groups_against_cross_join(spark):
    """Many movies per (set, year) with finely spaced averages: exercises both
    candidate prunes, including score ties created by rounding."""
    movies = spark.createDataFrame(
        [(i, f"m{i}", 2000 + (i % 2), "Drama|Comedy" if i % 5 else "Drama") for i in range(1, 161)],
        "movie_id bigint, title_clean string, release_year int, genres string")
    data = []
    for i in range(1, 161):
        n = 10 + (i * 7) % 23
        for u in range(n):
            data.append((u, i, 0.5 * (1 + (u * i + i) % 10)))
    ratings = spark.createDataFrame(data, "user_id bigint, movie_id bigint, rating double")
    fast = RC.gold_movie_recommendations(movies, ratings).select(
        "movie_id", "similar_movie_id", F.col("recommendation_score").alias("score"),
        F.col("recommendation_rank").alias("rank"))
    assert rows(fast) == rows(_naive_recs(RC.movie_stats(movies, ratings)))


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.01"])
def test_bound_pruning_is_exact(spark, sf):
    s = SilverFrames(spark, sf)
    m, r = s["silver_movies"], s["silver_ratings"]
    with_bound = RC.gold_movie_recommendations(m, r, bound_pruning=True)
    without = RC.gold_movie_recommendations(m, r, bound_pruning=False)
    assert rows(with_bound) == rows(without)


def test_recommendations_with_duplicate_movie_ids(spark):
    """Movie ids repeated with different titles / years / genres: the caps widen to
    top_k + dmax and each movie's top-10 (score, count) multiset equals the cross join's."""
    from collections import defaultdict

    from pyspark.sql import Window

    from reelhouse.functions.exprs import round_to
    from reelhouse.functions.labels import recommendation_score

    base = [(i, f"t{i}", 2000 + i % 3, "A|B" if i % 2 else "B|C") for i in range(1, 80)]
    dups = [(i, f"t{i}-alt", 2001, "A|B") for i in range(1, 80, 4)] + [(5, "t5-third", 1999, "A|B")]
    movies = spark.createDataFrame(base + dups, "movie_id bigint, title_clean string, release_year int, genres string")
    ratings = spark.createDataFrame(
        [(u, i, 0.5 * (1 + (u + 3 * i) % 10)) for i in range(1, 80) for u in range(10 + i % 5)],
        "user_id bigint, movie_id bigint, rating double")
    fast = RC.gold_movie_recommendations(movies, ratings)
    stats = RC.movie_stats(movies, ratings)
    s1, s2 = stats.alias("m1"), stats.alias("m2")
    g1, g2 = F.split(F.col("m1.genres"), r"\|"), F.split(F.col("m2.genres"), r"\|")
    jac = F.size(F.array_intersect(g1, g2)).cast("double") / F.size(F.array_union(g1, g2)).cast("double")
    pairs = (s1.crossJoin(s2).where((F.col("m1.movie_id") != F.col("m2.movie_id"))
                                    & (F.size(F.array_intersect(g1, g2)) > 0) & (round_to(jac, 3) >= 0.3))
             .select(F.col("m1.movie_id").alias("movie_id"), F.col("m2.rating_count").alias("cnt"),
                     recommendation_score(jac, F.abs(F.col("m1.release_year") - F.col("m2.release_year")),
                                          F.col("m2.avg_rating")).alias("score")))
    w = Window.partitionBy("movie_id").orderBy(F.desc("score"), F.desc("cnt"))
    naive = pairs.withColumn("rk", F.row_number().over(w)).where("rk <= 10")

    def per_movie(df, score, cnt):
        out = defaultdict(list)
        for r in df.select("movie_id", score, cnt).collect():
            out[r[0]].append((r[1], r[2]))
        return {k: sorted(v) for k, v in out.items()}

    assert per_movie(fast, "recommendation_score", "similar_movie_ratings_count") == per_movie(naive, "score", "cnt")


def test_duplicate_id_filling_the_top_of_a_group(spark):
    """Movie 1 has three stat rows at the top of the only candidate group: its own
    rows are excluded, and each candidate appears once per row of movie 1, exactly
    as in the cross join."""
    movies = spark.createDataFrame(
        [(1, t, 2000, "A|B") for t in ("one", "one-b", "one-c")]
        + [(i, f"m{i}", 2000, "A|B") for i in range(2, 31)],
        "movie_id bigint, title_clean string, release_year int, genres string")
    ratings = spark.createDataFrame(
        [(u, i, 4.0) for i in range(1, 31) for u in range(40 if i == 1 else 10 + i % 7)],
        "user_id bigint, movie_id bigint, rating double")
    recs = RC.gold_movie_recommendations(movies, ratings)
    per_movie = {r.movie_id: r.n for r in recs.groupBy("movie_id").agg(F.count("*").alias("n")).collect()}
    assert per_movie[1] == 10 and all(n == 10 for n in per_movie.values())
    assert rows(recs.select("movie_id", "similar_movie_id", "recommendation_score", "recommendation_rank")) == \
        rows(_naive_recs(RC.movie_stats(movies, ratings)))
