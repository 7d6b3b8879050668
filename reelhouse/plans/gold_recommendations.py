"""M07 gold_movie_recommendations: up to 10 similar movies per movie.

The reference scores every pair of movies with at least ``min_ratings`` ratings
(a cross join).  Here the same top 10 is computed exactly without any pair of
movies being formed blindly:

1. ``movie_stats``: ratings aggregated per movie first (partial aggregation),
   then joined to the movie dimension.
2. Genre-set pairs (``operators.genre_pairs``) with rounded Jaccard >= 0.3.
3. A candidate's score for a query movie depends only on (query set, query year,
   candidate set, candidate year, candidate avg rating); candidates that agree on
   (set, year, avg) are ordered among themselves by (count desc, id asc) for every
   query, so only the first 11 of each such group can reach a top 10 (one may be
   the query movie itself).  Spark plans that filter as a partial top-k
   (WindowGroupLimit) before the shuffle, so a huge group never lands whole in
   one task.
4. Queries are deduplicated the same way: every movie with the same (set, year)
   has the same candidate list, so the top 11 is computed once per (set, year)
   key and then attached to each movie, which drops itself and keeps 10.
5. Within a (set, year) group a candidate whose average is more than 0.03 below
   the group's 11th best loses to 11 others for every query (``_prune_by_rating_margin``),
   and a per-key score bound limits the years scored per partner set
   (``_scored_candidates``).  Both are exact.

Ties in score and count are broken by the similar movie's id (the reference
leaves them arbitrary).  "11" above is ``top_k + dmax`` in general, where dmax is
the largest number of stat rows sharing one movie id (1 when the movie table is
keyed), so the pruning stays exact for any input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import round_to
from ..functions.labels import recommendation_score
from ..operators.genre_pairs import genre_set, set_pairs
from ..session import checkpoint_dir

MIN_RATINGS = 10
MIN_SIMILARITY = 0.3
TOP_K = 10


def movie_stats(movies: DataFrame, ratings: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """Movies with at least ``min_ratings`` ratings, their count and rounded average.

    Equal to grouping the movie/ratings left join by all movie columns: a movie row
    repeated d times counts each rating d times.
    """
    per_movie = ratings.groupBy("movie_id").agg(
        F.count("rating").alias("n"), F.avg("rating").alias("a"))
    m = movies.groupBy("movie_id", "title_clean", "release_year", "genres").agg(
        F.count(F.lit(1)).alias("d"))
    return (m.join(per_movie, "movie_id")
            .select("movie_id", "title_clean", "release_year", "genres",
                    (F.col("d") * F.col("n")).alias("rating_count"),
                    round_to(F.col("a"), 2).alias("avg_rating"))
            .where(F.col("rating_count") >= F.lit(min_ratings)))


def _ranked(df: DataFrame, partition, limit: int, order) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")


# Within one (candidate set, year) group every query adds the same offset to
# 0.2 * avg / 5; two averages more than this apart differ by more than 0.0012 in raw
# score, i.e. by more than one rounding step (0.001), so their order is fixed.
RATING_MARGIN = 0.03


def _prune_by_rating_margin(cand: DataFrame, keep: int) -> DataFrame:
    """Drop candidates that at least ``keep`` others beat for every query (exact).

    T = the ``keep``-th best average of a (set, year) group (a partial top-k, so a
    huge group is reduced map-side); a member with average below T - margin ranks
    below ``keep`` members for any query movie, so it never reaches a top 10.
    """
    top = _ranked(cand, ["sid2", "similar_movie_year"], keep,
                  [F.desc("similar_movie_rating"), F.desc("similar_movie_ratings_count"),
                   F.asc("similar_movie_id")])
    thr = (top.groupBy("sid2", "similar_movie_year")
              .agg(F.min("similar_movie_rating").alias("_t"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") >= keep)
              .select(F.col("sid2").alias("_s"), F.col("similar_movie_year").alias("_y"), "_t"))
    j = cand.join(thr, (cand.sid2 == thr._s) & cand.similar_movie_year.eqNullSafe(thr._y), "left")
    return j.where(F.col("_t").isNull() | (F.col("similar_movie_rating") >= F.col("_t") - F.lit(RATING_MARGIN))) \
            .drop("_s", "_y", "_t")


# score = round3(0.6 J + 0.2 (5 - min(dy / 10, 5)) / 5 + 0.2 avg / 5): per year of
# difference the year term loses 0.004, and it is 0 from 50 years on (or when a
# year is missing)
YEAR_STEP, YEAR_CAP, AVG_WEIGHT, J_WEIGHT, YEAR_MAX_TERM = 0.004, 50, 0.04, 0.6, 0.2
HALF_STEP, EPS = 0.0005, 1e-9


def _score(df: DataFrame) -> DataFrame:
    return (df.withColumn("year_diff", F.abs(F.col("year1") - F.col("similar_movie_year")))
              .withColumn("recommendation_score",
                          recommendation_score(F.col("jaccard"), F.col("year_diff"),
                                               F.col("similar_movie_rating"))))


def _scored_candidates(key_sets: DataFrame, cand: DataFrame, keep: int, score_order,
                       bound_pruning: bool = True) -> DataFrame:
    """Score the candidates each (set, year) key may rank; exact.

    Without pruning every candidate of every partner set is scored.  With it:
    phase 1 scores same-set candidates within one year of the key; if at least
    ``keep`` exist, the ``keep``-th best score L bounds the key's final cut from
    below.  Phase 2 keeps, per (key, partner set), only candidates whose best
    possible score (year term + the set's best average) can reach L: partner sets
    that cannot are dropped before the join, the rest are joined with the
    condition |y1 - y2| <= D.  A candidate below L is beaten by at least ``keep``
    others, so the ranked result is unchanged.
    """
    if not bound_pruning:
        return _score(cand.join(key_sets, "sid2"))

    # phase 1: same set (Jaccard 1), years y1-1 .. y1+1
    own = (key_sets.where((F.col("sid2") == F.col("sid1")) & F.col("year1").isNotNull())
           .withColumn("similar_movie_year", F.explode(F.sequence(F.col("year1") - 1, F.col("year1") + 1))))
    near = _score(cand.join(own, ["sid2", "similar_movie_year"]))
    bound = (_ranked(near, ["sid1", "year1"], keep, score_order)
             .groupBy("sid1", "year1")
             .agg(F.count(F.lit(1)).alias("_n"), F.min("recommendation_score").alias("_l"))
             .where(F.col("_n") >= keep).drop("_n"))

    # phase 2: per (key, partner set) the reachable year distance D, then the years
    # of that set within D (null D: every year, and a missing one).  The years come
    # from the (set, year) table, so candidates meet the keys on (set, year): a hot
    # genre set is spread over its years, and no unreachable candidate is paired
    set_years = cand.groupBy("sid2", "similar_movie_year").agg(F.max("similar_movie_rating").alias("_amax"))
    ks = (key_sets.join(bound, ["sid1", "year1"], "left").join(set_years, "sid2")
          .withColumn("_dy", F.abs(F.col("year1") - F.col("similar_movie_year"))))
    slack = (F.lit(YEAR_MAX_TERM) - F.col("_l") + F.lit(HALF_STEP + EPS)
             + F.lit(J_WEIGHT) * F.col("jaccard") + F.lit(AVG_WEIGHT) * F.col("_amax"))
    d = F.floor(slack / F.lit(YEAR_STEP))
    open_ = F.col("_l").isNull() | F.col("year1").isNull() | (d >= YEAR_CAP)
    ks = (ks.where(open_ | ((d >= 0) & (F.col("_dy") <= d)))
          .withColumnRenamed("sid2", "_s").withColumnRenamed("similar_movie_year", "_y").drop("_l", "_amax", "_dy"))
    return _score(cand.join(ks, (F.col("sid2") == F.col("_s")) & F.col("similar_movie_year").eqNullSafe(F.col("_y")))
                  .drop("_s", "_y"))


def _kept(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    An eager ``checkpoint()`` of a frame that is not persisted computes it twice, to count and to write.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/recommendations-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_set_ids(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give every distinct genre set an integer id (the sets are written, so the
    ids are stable); returns (stats with ``set_id``, sets)."""
    sets = (stats.select("genre_set").where(F.col("genre_set").isNotNull()).distinct()
            .withColumn("set_id", F.monotonically_increasing_id()))
    sets = _kept(sets, "sets")
    return stats.join(sets, "genre_set", "left"), sets


def gold_movie_recommendations(movies: DataFrame, ratings: DataFrame, min_ratings: int = MIN_RATINGS,
                               min_similarity: float = MIN_SIMILARITY, top_k: int = TOP_K,
                               query_filter: Column | None = None, bound_pruning: bool = True) -> DataFrame:
    """See the module docstring.

    ``movie_stats`` feeds several branches that each prune different columns, so
    Spark cannot reuse one exchange for them; it is computed once and kept as Parquet
    (one row per movie, in ``spark.checkpoint.dir``), and so
    are the genre sets with their ids and the pruned candidate table.  Building the
    plan therefore runs the jobs up to these writes; only the rest is lazy.
    Scoring and ranking carry only numeric columns (integer set ids); titles are
    attached to the final rows.  ``query_filter`` (on ``movie_id``/``movie_title``)
    restricts which movies get recommendations; candidates are always all movies,
    so each kept movie's rows equal the unfiltered result's.
    """
    stats = (movie_stats(movies, ratings, min_ratings)
             .withColumn("genre_set", genre_set(F.col("genres")))
             .withColumn("row_id", F.monotonically_increasing_id()))
    stats = _kept(stats, "stats")
    # rows one query movie id can occupy in any candidate list (1 for a keyed
    # dimension); keeping top_k + dmax per list leaves top_k after dropping itself
    dmax = stats.groupBy("movie_id").count().agg(F.max("count")).first()[0] or 1
    keep = top_k + dmax
    stats, sets = _with_set_ids(stats)
    id1 = sets.select(F.col("genre_set").alias("set1"), F.col("set_id").alias("sid1"))
    id2 = sets.select(F.col("genre_set").alias("set2"), F.col("set_id").alias("sid2"))
    pairs = (set_pairs(stats, "genre_set", min_similarity).join(id1, "set1").join(id2, "set2")
             .select("sid1", "sid2", "common_genres", "jaccard", "genre_similarity"))

    # candidates: the first `keep` of each (set, year, avg) group
    cand = _ranked(stats.where(F.col("set_id").isNotNull()), ["set_id", "release_year", "avg_rating"],
                   keep, [F.desc("rating_count"), F.asc("movie_id"), F.asc("row_id")])
    cand = cand.select(
        F.col("set_id").alias("sid2"),
        F.col("movie_id").alias("similar_movie_id"),
        F.col("row_id").alias("similar_row_id"),
        F.col("release_year").alias("similar_movie_year"),
        F.col("avg_rating").alias("similar_movie_rating"),
        F.col("rating_count").alias("similar_movie_ratings_count"))

    cand = _kept(_prune_by_rating_margin(cand, keep), "candidates")

    score_order = [F.desc("recommendation_score"), F.desc("similar_movie_ratings_count"),
                   F.asc("similar_movie_id"), F.asc("similar_row_id")]

    m1 = stats.select(F.col("movie_id"), F.col("title_clean").alias("movie_title"),
                      F.col("set_id").alias("sid1"), F.col("release_year").alias("year1"))
    if query_filter is not None:
        m1 = m1.where(query_filter)
    m1 = m1.where(F.col("sid1").isNotNull())

    # one candidate list per (set, year) query key; the (key, partner set) table is
    # bounded by the genre-set vocabulary
    keys = m1.select("sid1", "year1").distinct()
    key_sets = keys.join(pairs, "sid1")
    scored = _scored_candidates(key_sets, cand, keep, score_order, bound_pruning)
    per_key = _ranked(scored, ["sid1", "year1"], keep, score_order)

    joined = m1.join(per_key, (m1.sid1 == per_key.sid1) & m1.year1.eqNullSafe(per_key.year1)) \
               .where(F.col("movie_id") != F.col("similar_movie_id"))
    # the movie's own title only matters when its id has several rows
    w = Window.partitionBy("movie_id").orderBy(*score_order, F.asc("movie_title"))
    ranked = joined.withColumn("recommendation_rank", F.row_number().over(w)) \
                   .where(F.col("recommendation_rank") <= top_k)
    titles = stats.select(F.col("row_id").alias("similar_row_id"),
                          F.col("title_clean").alias("similar_movie_title"))
    return ranked.join(titles, "similar_row_id").select(
        "movie_id", "movie_title", "similar_movie_id", "similar_movie_title",
        "similar_movie_year", "similar_movie_rating", "similar_movie_ratings_count",
        "common_genres", "genre_similarity", "year_diff", "recommendation_score",
        "recommendation_rank").orderBy("movie_id", "recommendation_rank")


def genre_jaccard_pairs(movies: DataFrame, ratings: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """Set pairs among rated movies, sets rendered as ``A|B`` text."""
    stats = movie_stats(movies, ratings, min_ratings).withColumn("genre_set", genre_set(F.col("genres")))
    p = set_pairs(stats, "genre_set")
    return p.select(F.array_join("set1", "|").alias("set1"), F.array_join("set2", "|").alias("set2"),
                    "common_genres", "union_genres", "genre_similarity")
