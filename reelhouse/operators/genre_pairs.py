"""Genre-overlap pairs (J04) without a cross join.

Two movies are compared only through their *distinct genre sets*: the number of
shared genres and the Jaccard index depend on nothing else.  So pairs are formed
between distinct genre sets (an equi-join on an exploded genre), whose number is
bounded by the genre vocabulary, never by the number of movies or ratings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import round_to, split_pipe


def genre_set(genres: Column) -> Column:
    """Canonical distinct genre set of a ``A|B|C`` text (null for null text)."""
    return F.array_sort(F.array_distinct(split_pipe(genres)))


def set_pairs(sets: DataFrame, set_col: str = "genre_set", min_similarity: float | None = None) -> DataFrame:
    """All ordered pairs of distinct sets that share at least one element.

    Output: ``set1, set2, common_genres, union_genres, jaccard`` (unrounded) and
    ``genre_similarity`` (rounded to 3 places).  A set is paired with itself.
    """
    distinct_sets = sets.select(F.col(set_col).alias("s")).where(F.col("s").isNotNull()).distinct()
    ex = distinct_sets.select("s", F.size("s").alias("n"), F.explode("s").alias("genre"))
    a = ex.select(F.col("s").alias("set1"), F.col("n").alias("n1"), "genre")
    b = ex.select(F.col("s").alias("set2"), F.col("n").alias("n2"), "genre")
    pairs = a.join(b, "genre").groupBy("set1", "n1", "set2", "n2").agg(
        F.count(F.lit(1)).alias("common_genres"))
    union = F.col("n1") + F.col("n2") - F.col("common_genres")
    jac = F.col("common_genres").cast("double") / union.cast("double")
    out = pairs.select(
        "set1", "set2", F.col("common_genres").cast("bigint").alias("common_genres"),
        union.cast("bigint").alias("union_genres"), jac.alias("jaccard"),
        round_to(jac, 3).alias("genre_similarity"))
    if min_similarity is not None:
        out = out.where(F.col("genre_similarity") >= F.lit(min_similarity))
    return out
