"""Bind the driver's star-schema tables to the four raw inputs (movies, ratings, tags, links).

The raw tables of a real deployment are loaded files; here they are derived from
``part``, ``orders`` and ``lineitem`` so the work grows with the scale factor.
Every expression is a built-in column expression, so the binding stays inside
whole-stage codegen and its filters/projections reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# ---- fixed values of the binding (must equal the oracle's binding) -------------
# genre 1 chosen by p_type; anything else is Horror
TYPE_GENRE = [("ECONOMY", "Action"), ("SMALL", "Comedy"), ("MEDIUM", "Drama"),
              ("PROMO", "Thriller"), ("LARGE", "Romance")]
TYPE_GENRE_OTHER = "Horror"
# genre 2 by p_size % 3, genre 3 by p_partkey % 5 (missing residues give no genre)
SIZE_GENRE = {0: "Sci-Fi", 1: "Drama"}
KEY_GENRE = {0: "Animation", 1: "Comedy"}
NO_GENRES = "(no genres listed)"
NO_GENRES_MOD, NO_YEAR_MOD, NO_TMDB_MOD = 23, 17, 29
YEAR_BASE = 1969
# tag text by l_orderkey % 14; index 10 is blank text, 11 is null, 13+ the default
TAG_TEXTS = [" LOVE it ", "great plot", "Best comedy", "bad acting", "Worst fight",
             "scary", "plot twist", "romantic", "Funny", "action", "   ", None,
             "terrible horror"]
TAG_DEFAULT = "based on a book"
BAD_TAG_TIME_MOD = 31
BAD_TAG_TIME = "n/a"
# -------------------------------------------------------------------------------


def _case(keyed: Column, pairs, default=None) -> Column:
    out = None
    for k, v in pairs:
        out = (F.when(keyed == F.lit(k), F.lit(v)) if out is None
               else out.when(keyed == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default)) if default is not None else out


def movies_raw(part: DataFrame) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    title = F.when(key % NO_YEAR_MOD == 0, F.col("p_name")).otherwise(
        F.concat(F.col("p_name"), F.lit(" ("), (F.lit(YEAR_BASE) + size).cast("string"), F.lit(")")))
    g1 = _case(F.col("p_type"), TYPE_GENRE, TYPE_GENRE_OTHER)
    g2 = _case(size % 3, SIZE_GENRE.items())
    g3 = _case(key % 5, KEY_GENRE.items())
    genres = F.when(key % NO_GENRES_MOD == 0, F.lit(NO_GENRES)).otherwise(F.concat_ws("|", g1, g2, g3))
    return part.select(key.alias("movieId"), title.alias("title"), genres.alias("genres"))


def _rated_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return li.join(od, "l_orderkey")


def _epoch(ts: Column) -> Column:
    # unix_timestamp of a timestamp_ntz reads the wall time as UTC: zone independent
    return F.unix_timestamp(ts)


def ratings_raw(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    j = _rated_lines(lineitem, orders)
    return j.select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.floor(F.col("l_quantity") / 5) / 2).alias("rating"),
        (_epoch(F.col("l_shipdate")) + (F.col("l_orderkey") % 24) * 3600).alias("timestamp"),
    )


def tags_raw(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    j = _rated_lines(lineitem, orders)
    slot = F.col("l_orderkey") % 14
    tag = None
    for i, text in enumerate(TAG_TEXTS):
        cond = slot == i
        tag = F.when(cond, F.lit(text)) if tag is None else tag.when(cond, F.lit(text))
    tag = tag.otherwise(F.lit(TAG_DEFAULT))
    ts = F.when(F.col("l_orderkey") % BAD_TAG_TIME_MOD == 0, F.lit(BAD_TAG_TIME)).otherwise(
        _epoch(F.col("l_shipdate")).cast("string"))
    return j.select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        tag.cast("string").alias("tag"),
        ts.alias("timestamp"),
    )


def links_raw(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        key.alias("movieId"),
        (key * 37 + 113).alias("imdbId"),
        F.when(key % NO_TMDB_MOD == 0, F.lit(None).cast("bigint")).otherwise(key + 800).alias("tmdbId"),
    )


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw input as a lazy DataFrame; only the files it needs are opened."""
    def read(*tables):
        return [read_table(spark, sf_dir, t) for t in tables]

    if name == "movies":
        return movies_raw(*read("part"))
    if name == "ratings":
        return ratings_raw(*read("lineitem", "orders"))
    if name == "tags":
        return tags_raw(*read("lineitem", "orders"))
    if name == "links":
        return links_raw(*read("part"))
    raise KeyError(name)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw inputs as lazy DataFrames over the driver's parquet files."""
    return {name: raw_table(spark, sf_dir, name) for name in ("movies", "ratings", "tags", "links")}
