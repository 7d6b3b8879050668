"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator/model.

Every query reads the driver's tables through the bindings, so its work grows
with the scale factor.  Outputs pass through ``portable`` for comparison.
Builders receive the silver frames ``s`` (lazy) plus ``spark`` and ``sf_dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import normalize_columns
from ..operators import layout
from ..operators import loads as L
from ..operators import sketches
from ..operators.histograms import modes, value_counts
from ..operators.model_state import MovieRatingState
from ..session import checkpoint_dir
from ..sources.batches import ORDER_CURSOR, ORDER_KEY, late_rows_missing, orders_batches, overlapping
from ..sources.bindings import raw_table
from ..sources.tables import SourceRegistry, read_table
from . import adhoc, gold_genres, gold_movies, gold_recommendations, gold_temporal, gold_users
from .portable import portable
from .silver import SILVER

# ---- fixed parameters of the registered reports ---------------------------------
REPORT_TITLE = "red plate"          # a title present at every scale factor
JSON_SQL = "SELECT genre, total_movies, avg_rating FROM gold_genre_analytics"
UPDATE_COLUMNS = ["o_orderstatus", "o_totalprice"]
INCREMENT_FROM = "1997-01-01 00:00:00"
# -------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


class SilverFrames:
    """The silver tables of a folder by name, each built when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        source, build = SILVER[name]
        return build(raw_table(self.spark, self.sf_dir, source))


def _mrt(s):
    return s["silver_movies"], s["silver_ratings"], s["silver_tags"]


# --- temporal ----------------------------------------------------------------------
def _monthly(s, **_):
    return gold_temporal.monthly_metrics(s["silver_ratings"], s["silver_movies"])


def _trends(s, **_):
    return gold_temporal.gold_temporal_trends(s["silver_ratings"], s["silver_movies"])


# --- movies ------------------------------------------------------------------------
def _movie_analytics(s, **_):
    return gold_movies.gold_movie_analytics(*_mrt(s))


# --- users -------------------------------------------------------------------------
def _user_behavior(s, **_):
    m, r, t = _mrt(s)
    return gold_users.gold_user_behavior(r, t, m)


def _favorite_slots(s, **_):
    return modes(s["silver_ratings"], ["user_id"],
                 {"hour_of_day": "favorite_hour", "day_of_week": "favorite_day_of_week"},
                 small=("hour_of_day", "day_of_week"))


# --- stored partial results ----------------------------------------------------------
def _own_path(spark, what):
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _movie_ratings_by_increment(s, spark, **_):
    """The state of the ratings before ``INCREMENT_FROM``, then the later ones merged into it."""
    ratings = s["silver_ratings"]
    later = F.coalesce(F.col("rating_datetime") >= F.lit(INCREMENT_FROM).cast("timestamp"), F.lit(False))
    state = MovieRatingState(_own_path(spark, "movie-state"), buckets=16)
    for load_id, rows in ((1, ratings.where(~later)), (2, ratings.where(later))):
        state.merge(spark, rows, load_id)
    return state.metrics(spark)


def _genre_quantile_sketch(s, spark, **_):
    """Sketches by movie, stored, then merged to genres and held against the exact counts."""
    ratings, genres = s["silver_ratings"], gold_genres.genre_exploded(s["silver_movies"]).select("movie_id", "genre")
    path = _own_path(spark, "rating-sketches")
    sketches.value_sketches(ratings, ["movie_id"], "rating").write.parquet(path)
    by_genre = sketches.merged_sketches(spark.read.parquet(path).join(genres, "movie_id"), ["genre"])
    counts = value_counts(ratings, ["movie_id"], "rating").join(genres, "movie_id").groupBy("genre", "rating").agg(F.sum("cnt").alias("cnt"))
    found = sketches.rank_errors(by_genre, counts, ["genre"], "rating", {"p25": 0.25, "median": 0.5, "p75": 0.75})
    # twice the bound of 99 in 100 is passed about once in a million quantiles
    bound = 2 * sketches.rank_error(400)
    return found.select("genre", F.col("n").alias("total_ratings"),
                        *[(F.col(f"{q}_error") <= bound).alias(f"{q}_within") for q in ("p25", "median", "p75")])


# --- genres ------------------------------------------------------------------------
def _genre_analytics(s, fanout="reference", **_):
    return gold_genres.gold_genre_analytics(*_mrt(s), fanout=fanout)


# --- recommendations ---------------------------------------------------------------
def _recommendations(s, **_):
    return gold_recommendations.gold_movie_recommendations(s["silver_movies"], s["silver_ratings"])


def _title_report(s, **_):
    # only movies with the title need recommendations (same rows as filtering the table)
    recs = gold_recommendations.gold_movie_recommendations(
        s["silver_movies"], s["silver_ratings"], query_filter=F.col("movie_title") == F.lit(REPORT_TITLE))
    return adhoc.recommendations_for_title(recs, REPORT_TITLE)


def _rows_as_json(s, spark, **_):
    adhoc.register_views({"gold_genre_analytics": _genre_analytics(s)})
    return adhoc.rows_as_json(adhoc.run_sql(spark, JSON_SQL))


# --- loads over order batches --------------------------------------------------------
def _orders(kind: str):
    def build(s, spark, sf_dir, **_):
        old, new = orders_batches(spark, sf_dir)
        if kind == "append":
            return old.unionByName(new)
        if kind == "upsert":
            return L.upsert_frame(old, new, ORDER_KEY, [ORDER_CURSOR])
        if kind == "update_columns":
            return L.merge_update_columns(old, new, ORDER_KEY, UPDATE_COLUMNS, [ORDER_CURSOR])
        if kind == "delete_insert":
            return L.delete_insert_frame(old, new, ORDER_KEY)
        if kind == "incremental":
            return L.incremental_frame(old, read_table(spark, sf_dir, "orders"), ORDER_CURSOR)
        if kind == "incremental_unkeyed":
            return L.incremental_frame(late_rows_missing(old), overlapping(spark, sf_dir, new), ORDER_CURSOR)
        if kind == "incremental_keyed":
            return L.incremental_frame(old, new, ORDER_CURSOR, ORDER_KEY)
        if kind == "schema_sync":
            return L.append_with_policy(old.drop("o_orderpriority"), new, "append_new_columns")
        if kind == "schema_ignore":
            return L.append_with_policy(old.drop("o_orderpriority"), new, "ignore")
        if kind == "schema_sync_all":
            return L.append_with_policy(old, new.drop("o_custkey"), "sync_all_columns")
        raise KeyError(kind)
    return build


def _stored_orders(change: str):
    """Order batches through a written keyed table: old rows stored, the new batch merged in, the table read back."""
    def build(s, spark, sf_dir, **_):
        old, new = orders_batches(spark, sf_dir)
        table = L.KeyedTarget(_own_path(spark, f"orders-{change}"), tuple(ORDER_KEY), 8)
        if change == "append_new_columns":
            table.write(spark, old.drop("o_orderpriority"), "overwrite", [ORDER_CURSOR])
            table.upsert(spark, new, [ORDER_CURSOR], policy="append_new_columns")
        else:
            table.write(spark, old, "overwrite", [ORDER_CURSOR])
            table.upsert(spark, new, [ORDER_CURSOR], change=change, update_columns=UPDATE_COLUMNS if change == "update_columns" else ())
        return table.read(spark)
    return build


def _compacted_orders(s, spark, sf_dir, **_):
    """Both order batches appended by priority, then the partitions with small files rewritten by key."""
    table = L.Target(_own_path(spark, "orders-compacted"), is_path=True)
    for batch in orders_batches(spark, sf_dir):
        L.append(batch, table, partition_by=["o_orderpriority"])
    layout.compact(spark, table, ["o_orderpriority"], ORDER_KEY)
    return table.read(spark)


def _glob_scan(s, spark, sf_dir, **_):
    reg = SourceRegistry().register("bronze", "lineitem", f"{sf_dir.rstrip('/')}/lineitem*.parquet")
    return reg.read(spark, "bronze", "lineitem")


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    # silver (M01-M04)
    "silver_links": lambda s, **_: s["silver_links"],
    "silver_movies": lambda s, **_: s["silver_movies"],
    "silver_ratings": lambda s, **_: s["silver_ratings"],
    "silver_tags": lambda s, **_: s["silver_tags"],
    # M08 and its parts
    "monthly_metrics": _monthly,
    "gold_temporal_trends": _trends,
    "monthly_growth": lambda s, **_: _trends(s).select(
        "month", "total_ratings", "active_users", "ratings_growth_pct", "users_growth_pct"),
    "monthly_moving_avg": lambda s, **_: _trends(s).select("month", "ratings_ma3", "users_ma3", "avg_rating_ma3"),
    # M06 and its parts
    "movie_rating_metrics": lambda s, **_: gold_movies.movie_rating_metrics(s["silver_ratings"]),
    "movie_rating_percentiles": lambda s, **_: gold_movies.movie_rating_metrics(s["silver_ratings"]).select(
        "movie_id", "rating_p25", "rating_median", "rating_p75"),
    "movie_tag_metrics": lambda s, **_: gold_movies.movie_tag_metrics(s["silver_tags"]),
    "gold_movie_analytics": _movie_analytics,
    # M09 and its parts
    "user_rating_metrics": lambda s, **_: gold_users.user_rating_metrics(s["silver_ratings"], s["silver_movies"]),
    "user_genre_preferences": lambda s, **_: gold_users.user_genre_preferences(
        s["silver_ratings"], s["silver_movies"]),
    "user_tag_metrics": lambda s, **_: gold_users.user_tag_metrics(s["silver_tags"]),
    "user_favorite_slots": _favorite_slots,
    "gold_user_behavior": _user_behavior,
    # M05 and its parts
    "genre_explode": lambda s, **_: gold_genres.genre_exploded(s["silver_movies"]),
    "genre_counts": lambda s, **_: gold_genres.genre_counts(s["silver_movies"]),
    "gold_genre_analytics": _genre_analytics,
    "gold_genre_analytics_dedup": lambda s, **_: _genre_analytics(s, fanout="dedup"),
    "genre_rankings": lambda s, **_: _genre_analytics(s).select(
        "genre", "rank_by_movies", "rank_by_ratings", "rank_by_quality", "rank_by_engagement",
        "quality_tier", "popularity_tier", "genre_score"),
    # M07 and its parts
    "movie_stats": lambda s, **_: gold_recommendations.movie_stats(s["silver_movies"], s["silver_ratings"]),
    "genre_jaccard_pairs": lambda s, **_: gold_recommendations.genre_jaccard_pairs(
        s["silver_movies"], s["silver_ratings"]),
    "gold_movie_recommendations": _recommendations,
    # ad hoc reports (Q01-Q04) and S19
    "top_genres": lambda s, **_: adhoc.top_genres(_genre_analytics(s)),
    "recommendations_for_title": _title_report,
    "yearly_rollup": lambda s, **_: adhoc.yearly_rollup(_trends(s)),
    "users_by_favorite_genre": lambda s, **_: adhoc.users_by_favorite_genre(_user_behavior(s)),
    "rows_as_json": _rows_as_json,
    # loads (S09-S13, S15), naming (S16), glob scan and registry
    "append_orders": _orders("append"),
    "upsert_orders": _orders("upsert"),
    "upsert_update_columns": _orders("update_columns"),
    "delete_insert_orders": _orders("delete_insert"),
    "incremental_orders": _orders("incremental"),
    "incremental_orders_unkeyed": _orders("incremental_unkeyed"),
    "incremental_orders_keyed": _orders("incremental_keyed"),
    "schema_sync": _orders("schema_sync"),
    "schema_ignore": _orders("schema_ignore"),
    "schema_sync_all": _orders("schema_sync_all"),
    # the same through written tables (S12, S13, S15), partial results merged
    "stored_upsert_orders": _stored_orders("merge"),
    "stored_update_columns": _stored_orders("update_columns"),
    "stored_delete_insert": _stored_orders("delete_insert"),
    "stored_new_columns": _stored_orders("append_new_columns"),
    "stored_compacted_orders": _compacted_orders,
    "movie_rating_metrics_incremental": _movie_ratings_by_increment,
    "monthly_metrics_bitmap": lambda s, **_: gold_temporal.monthly_metrics(s["silver_ratings"], s["silver_movies"], distinct="bitmap"),
    "user_tag_metrics_bitmap": lambda s, **_: gold_users.user_tag_metrics_by_bitmap(s["silver_tags"]),
    "genre_quantile_sketch": _genre_quantile_sketch,
    "normalize_columns": lambda s, spark, sf_dir, **_: normalize_columns(raw_table(spark, sf_dir, "ratings")),
    "source_glob_scan": _glob_scan,
}


def _query(builder: Callable[..., DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(builder(SilverFrames(spark, sf_dir), spark=spark, sf_dir=sf_dir))
    return run


def queries() -> dict[str, Query]:
    return {name: _query(b) for name, b in BUILDERS.items()}
