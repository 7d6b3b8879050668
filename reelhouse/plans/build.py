"""Materialise the layers: raw -> silver tables -> gold tables.

Run order is plain function order (silver before gold).  Each table is written
with ``processed_at`` added at write time; gold reads the *written* silver tables,
so the gold jobs start from compact columnar files instead of re-deriving silver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.loads import Target, ensure_namespace, write_frame
from ..sources.readers import with_load_time
from ..sources.tables import target_namespace
from .gold_genres import gold_genre_analytics
from .gold_movies import gold_movie_analytics
from .gold_recommendations import gold_movie_recommendations
from .gold_temporal import gold_temporal_trends
from .gold_users import gold_user_behavior
from .silver import build_silver


def _target(root: str | None, namespace: str, name: str) -> Target:
    if root:
        return Target(f"{root.rstrip('/')}/{namespace}/{name}", is_path=True)
    return Target(f"{namespace}.{name}")


def materialize(df: DataFrame, target: Target, bucket_by=None) -> None:
    write_frame(with_load_time(df), target, "overwrite", bucket_by=bucket_by)


def build_all(spark: SparkSession, raw: dict[str, DataFrame], root: str | None = None,
              silver_ns: str | None = "silver", gold_ns: str | None = "gold",
              distinct: str = "exact", buckets: int | None = None) -> dict[str, Target]:
    """Write the four silver and five gold tables; return where they went.

    ``root`` set: parquet folders ``root/<namespace>/<table>``; unset: catalog tables.
    ``distinct="approx"`` counts distinct users/movies/tags per month and per genre with
    HyperLogLog++ (few groups, very many values: where exact counting is costly).
    ``buckets=n`` (catalog tables only) writes silver movies, ratings and tags bucketed
    by ``movie_id``, so the per-movie aggregations and movie joins of gold read
    co-located files instead of shuffling ratings.
    """
    s_ns, g_ns = target_namespace(silver_ns, "silver"), target_namespace(gold_ns, "gold")
    if root and buckets:
        raise ValueError("bucketed silver tables need catalog targets (no root)")
    if not root:
        ensure_namespace(spark, s_ns)
        ensure_namespace(spark, g_ns)
    bucketed = {"silver_movies", "silver_ratings", "silver_tags"} if buckets else set()
    out: dict[str, Target] = {}
    for name, df in build_silver(raw).items():
        out[name] = _target(root, s_ns, name)
        materialize(df, out[name], (buckets, ["movie_id"]) if name in bucketed else None)
    s = {k: out[k].read(spark).drop("processed_at") for k in list(out)}
    m, r, t = s["silver_movies"], s["silver_ratings"], s["silver_tags"]
    gold = {
        "gold_genre_analytics": gold_genre_analytics(m, r, t, distinct=distinct),
        "gold_movie_analytics": gold_movie_analytics(m, r, t),
        "gold_movie_recommendations": gold_movie_recommendations(m, r),
        "gold_temporal_trends": gold_temporal_trends(r, m, distinct=distinct),
        "gold_user_behavior": gold_user_behavior(r, t, m),
    }
    for name, df in gold.items():
        out[name] = _target(root, g_ns, name)
        materialize(df, out[name])
    return out
