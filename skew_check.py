"""Hot-key check: one user and one movie get a third of all ratings, one genre set a third of all movies.

Usage: python skew_check.py [sf_dir] [event_log_dir]
Runs the gold models on ratings where a third of the rows (chosen by a hash of
the row) are re-assigned to user 0 and movie 1, and an upsert whose batch puts a
third of its rows on one key, with Spark's event log written to
``event_log_dir`` (a new temporary folder by default; local runs only) and AQE
partition coalescing off, so each task reads exactly one hash partition.  Prints,
per model, the largest share of a stage's shuffle records read by one task: a
hot key shuffled whole into one partition would show >= 0.33.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def _events(folder: str):
    for f in glob.glob(folder + "/*/*") + glob.glob(folder + "/*"):
        if os.path.isdir(f):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def report(folder: str) -> dict[str, tuple[float, int]]:
    stage_job, tasks = {}, collections.defaultdict(list)
    for e in _events(folder):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description")
            for sid in e["Stage IDs"]:
                stage_job[sid] = desc
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            tasks[e["Stage ID"]].append((m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0))
    worst: dict[str, tuple[float, int]] = {}
    for sid, recs in tasks.items():
        total, name = sum(recs), stage_job.get(sid)
        if not name or total < 1000 or len(recs) < 2:
            continue
        share = max(recs) / total
        if share > worst.get(name, (0.0, 0))[0]:
            worst[name] = (share, total)
    return worst


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="reelhouse-skew-")
    from pyspark.sql import functions as F

    from reelhouse.operators import loads as L
    from reelhouse.plans import gold_genres, gold_movies, gold_recommendations, gold_temporal, gold_users
    from reelhouse.sources.batches import ORDER_CURSOR, ORDER_KEY, orders_batches
    from reelhouse.plans.registry import SilverFrames
    from reelhouse.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    s = SilverFrames(spark, sf_dir)
    m, r, t = s["silver_movies"], s["silver_ratings"], s["silver_tags"]
    hot = F.pmod(F.xxhash64("user_id", "movie_id", "rating_timestamp"), F.lit(3)) == 0
    r = (r.withColumn("_hot", hot)
          .withColumn("user_id", F.when(F.col("_hot"), F.lit(0)).otherwise(F.col("user_id")))
          .withColumn("movie_id", F.when(F.col("_hot"), F.lit(1)).otherwise(F.col("movie_id")))
          .drop("_hot"))
    old, new = orders_batches(spark, sf_dir)
    hot_key = F.pmod(F.xxhash64("o_orderkey", "o_orderdate"), F.lit(3)) == 0
    new = new.withColumn("o_orderkey", F.when(hot_key, F.lit(0)).otherwise(F.col("o_orderkey")))
    # a third of all movies share one genre set
    hot_set = m.withColumn("genres", F.when(F.pmod(F.xxhash64("movie_id"), F.lit(3)) == 0, F.lit("Drama|Comedy"))
                           .otherwise(F.col("genres")))
    plain = s["silver_ratings"]
    models = {
        "recommendations (hot genres)": lambda: gold_recommendations.gold_movie_recommendations(hot_set, plain),
        "upsert (hot key in batch)": lambda: L.upsert_frame(old, new, ORDER_KEY, [ORDER_CURSOR]),
        "gold_user_behavior": lambda: gold_users.gold_user_behavior(r, t, m),
        "gold_movie_analytics": lambda: gold_movies.gold_movie_analytics(m, r, t),
        "gold_genre_analytics": lambda: gold_genres.gold_genre_analytics(m, r, t),
        "gold_temporal_trends": lambda: gold_temporal.gold_temporal_trends(r, m),
        "gold_movie_recommendations": lambda: gold_recommendations.gold_movie_recommendations(m, r),
    }
    for name, build in models.items():
        spark.sparkContext.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()
    for name, (share, total) in sorted(report(log_dir).items()):
        print(f"{name:28s} largest task share of a stage's shuffle records: {share:.2f} (of {total})")


if __name__ == "__main__":
    main()
