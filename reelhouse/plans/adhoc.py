"""Ad hoc SQL over the gold tables (S19) and the four example reports (Q01-Q04).

``run_sql`` keeps the result a DataFrame; ``rows_as_json`` renders rows on the
executors (``to_json(struct(*))``); ``result_envelope`` describes the whole result
and leaves its rows a DataFrame, ``write_envelope`` writes them in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import exact_mean


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames to SQL under their names (session-scoped temp views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


def rows_as_json(df: DataFrame) -> DataFrame:
    """One JSON object text per row, rendered on the executors."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("row_json"))


def result_envelope(df: DataFrame) -> dict:
    """``{data, metadata: {row_count, column_names}}`` of the whole result.

    ``data`` is a DataFrame of one JSON object per row (no row is brought to the
    driver); ``row_count`` counts all of them.
    """
    return {"data": rows_as_json(df), "metadata": {"row_count": df.count(), "column_names": list(df.columns)}}


def write_envelope(df: DataFrame, path: str) -> dict:
    """Write the rows as JSON lines under ``path`` and return the metadata; the rows are counted as they are written."""
    seen = Observation()
    rows_as_json(df).observe(seen, F.count(F.lit(1)).alias("n")).write.text(path)
    return {"data": path, "metadata": {"row_count": seen.get["n"], "column_names": list(df.columns)}}


def top_genres(genres: DataFrame, n: int = 10) -> DataFrame:
    """Q01: genres by average rating (ties by name)."""
    return (genres.select("genre", "total_movies", "avg_rating", "rank_by_quality")
            .orderBy(F.desc_nulls_last("avg_rating"), F.asc("genre")).limit(n))


def recommendations_for_title(recs: DataFrame, title: str, n: int = 5) -> DataFrame:
    """Q02: best recommendations for every movie with this title (a top-n report)."""
    return (recs.where(F.col("movie_title") == F.lit(title))
            .select("movie_id", "movie_title", "similar_movie_id", "similar_movie_title", "recommendation_score")
            .orderBy(F.desc("recommendation_score"), F.asc("movie_id"), F.asc("similar_movie_id"))
            .limit(n))


def yearly_rollup(trends: DataFrame) -> DataFrame:
    """Q03: monthly rows rolled up per year, in order of the year."""
    return trends.groupBy("year").agg(
        F.sum("total_ratings").alias("total_ratings"),
        exact_mean(F.col("avg_rating")).alias("avg_rating")).orderBy("year")


def users_by_favorite_genre(users: DataFrame) -> DataFrame:
    """Q04: users per favourite genre, most users first (ties by genre)."""
    return (users.groupBy("favorite_genre").agg(F.count(F.lit(1)).alias("users"))
            .orderBy(F.desc("users"), F.asc_nulls_last("favorite_genre")))
