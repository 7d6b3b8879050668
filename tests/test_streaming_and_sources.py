"""S11s streaming upsert, CSV/JDBC/registry sources and the layer build."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from reelhouse.operators import loads as L
from reelhouse.sources import readers as R
from reelhouse.sources.batches import ORDER_CURSOR, ORDER_KEY, orders_batches
from reelhouse.sources.bindings import raw_tables
from reelhouse.sources.tables import SourceRegistry, UnknownSourceError, target_namespace
from reelhouse.streaming.upsert_stream import start_upsert_stream


def test_stream_upsert_equals_batch_upsert(spark, scratch_dir):
    old, new = orders_batches(spark, SF_SMALL)
    src = os.path.join(scratch_dir, "incoming")
    target = L.KeyedTarget(os.path.join(scratch_dir, "target"), tuple(ORDER_KEY), 4)
    ckpt = os.path.join(scratch_dir, "stream_ckpt")
    old.write.mode("append").parquet(src)
    q = start_upsert_stream(spark, src, old.schema, target, [ORDER_CURSOR], ckpt)
    q.awaitTermination(120)
    assert rows(target.read(spark)) == rows(L.newest_per_key(old, ORDER_KEY, [ORDER_CURSOR]))
    new.write.mode("append").parquet(src)       # a later arrival
    q = start_upsert_stream(spark, src, old.schema, target, [ORDER_CURSOR], ckpt)
    q.awaitTermination(120)
    assert rows(target.read(spark)) == rows(L.upsert_frame(old, new, ORDER_KEY, [ORDER_CURSOR]))


def test_stream_upsert_in_micro_batches(spark, scratch_dir):
    old, new = orders_batches(spark, SF_SMALL)
    src = os.path.join(scratch_dir, "incoming")
    target = L.KeyedTarget(os.path.join(scratch_dir, "micro"), tuple(ORDER_KEY), 4)
    ckpt = os.path.join(scratch_dir, "ckpt")
    # one file per arrival and one file per trigger: two micro-batches, old then new
    old.coalesce(1).write.mode("append").parquet(src)
    new.coalesce(1).write.mode("append").parquet(src)
    start_upsert_stream(spark, src, old.schema, target, [ORDER_CURSOR], ckpt,
                        max_files_per_trigger=1).awaitTermination(120)
    assert rows(target.read(spark)) == rows(L.upsert_frame(old, new, ORDER_KEY, [ORDER_CURSOR]))


def test_csv_roundtrip(spark, scratch_dir):
    raw = raw_tables(spark, SF_SMALL)
    folder = os.path.join(scratch_dir, "csv")
    for name, df in raw.items():
        (df.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
           .option("ignoreTrailingWhiteSpace", "false").csv(os.path.join(folder, f"{name}.csv")))
    back = R.read_raw_csvs(spark, folder)
    for name in raw:
        assert rows(back[name]) == rows(raw[name]), name
    quoted = os.path.join(folder, "quoted.csv")
    with open(quoted, "w") as out:
        out.write('movieId,title,genres\n1,"The ""Big"" One (1999)",Drama\n')
    assert R.read_csv(spark, quoted, R.RAW_CSV_SCHEMAS["movies"]).first().title == 'The "Big" One (1999)'
    inferred = R.read_csv(spark, os.path.join(folder, "links.csv"))
    assert inferred.count() == raw["links"].count()


def test_jdbc_options():
    o = R.jdbc_options("jdbc:postgresql://db/x", "public.t", user="u", partition_column="id",
                       lower_bound=0, upper_bound=100, num_partitions=4)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4" and o["dbtable"] == "public.t"
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x", "t", partition_column="id")


def test_jdbc_schema_bounds_by_table():
    bounds = {"orders": {"partition_column": "id", "lower_bound": 0, "upper_bound": 9, "num_partitions": 4}}
    o = R.schema_table_options("jdbc:x", "public", "orders", bounds, user="u")
    assert o["table"] == "public.orders" and R.jdbc_options(**o)["numPartitions"] == "4"
    assert "partition_column" not in R.schema_table_options("jdbc:x", "public", "items", bounds)
    with pytest.raises(ValueError):
        R.schema_table_options("jdbc:x", "public", "orders", {"orders": {"bogus": 1}})
    with pytest.raises(ValueError):
        R.read_jdbc_schema(None, "jdbc:x", "public", num_partitions=4)


def test_registry(spark):
    reg = SourceRegistry().register("bronze", "part", f"{SF_SMALL}/part.parquet")
    assert reg.read(spark, "bronze", "part").count() > 0
    with pytest.raises(UnknownSourceError, match="bronze.nope"):
        reg.read(spark, "bronze", "nope")
    assert target_namespace("  gold ", "main") == "gold" and target_namespace(None, "main") == "main"


def test_build_all_to_paths(spark, scratch_dir):
    from reelhouse.plans.build import build_all

    out = build_all(spark, raw_tables(spark, SF_SMALL), root=os.path.join(scratch_dir, "lake"))
    assert len(out) == 9
    g = out["gold_temporal_trends"].read(spark)
    assert "processed_at" in g.columns and g.count() > 0
    assert out["gold_movie_recommendations"].read(spark).where(F.col("recommendation_rank") > 10).count() == 0


def test_build_all_to_catalog_tables(spark):
    from reelhouse.plans.build import build_all

    out = build_all(spark, raw_tables(spark, SF_SMALL), silver_ns=" lake_silver ", gold_ns="lake_gold")
    assert out["silver_movies"].location == "lake_silver.silver_movies"
    assert spark.catalog.tableExists("lake_gold.gold_user_behavior")
    assert spark.table("lake_gold.gold_genre_analytics").count() > 0


def test_cli_load_and_build(spark, scratch_dir, monkeypatch):
    import reelhouse.__main__ as cli

    # the CLI builds its session with master=None; reuse the test session instead
    monkeypatch.setattr("reelhouse.session.build_session", lambda *a, **k: spark)
    old, new = orders_batches(spark, SF_SMALL)
    src = os.path.join(scratch_dir, "src")
    old.write.parquet(os.path.join(src, "orders"))
    argv = ["load", "--source", src, "--tables", "orders", "--target-root", os.path.join(scratch_dir, "t"),
            "--mode", "merge", "--keys", "o_orderkey", "--cursor", "o_orderdate",
            "--state", os.path.join(scratch_dir, "state")]
    assert cli.main(argv) == 0
    assert L.KeyedTarget(os.path.join(scratch_dir, "t", "orders"), ("o_orderkey",)).read(spark).count() == old.count()
    with pytest.raises(SystemExit):
        cli.main(["load", "--source", src])          # missing required arguments
    raw = raw_tables(spark, SF_SMALL)
    for name, df in raw.items():
        df.write.parquet(os.path.join(scratch_dir, "raw", name))
    assert cli.main(["build", "--raw-parquet", os.path.join(scratch_dir, "raw"),
                     "--root", os.path.join(scratch_dir, "lake")]) == 0


def test_bucketed_silver_removes_movie_shuffles(spark):
    import contextlib
    import io

    from reelhouse.plans import gold_movies
    from reelhouse.plans.build import build_all

    out = build_all(spark, raw_tables(spark, SF_SMALL), silver_ns="bk_silver", gold_ns="bk_gold", buckets=8)
    plain = build_all(spark, raw_tables(spark, SF_SMALL), silver_ns="pl_silver", gold_ns="pl_gold")
    a = spark.table("bk_gold.gold_movie_analytics").drop("processed_at")
    b = spark.table("pl_gold.gold_movie_analytics").drop("processed_at")
    assert rows(a) == rows(b)
    # a per-movie aggregation over the bucketed table needs no shuffle at all
    r = out["silver_ratings"].read(spark)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        r.groupBy("movie_id").count().explain()
    plan = buf.getvalue()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    assert gold_movies.movie_rating_metrics(r).count() == r.select("movie_id").distinct().count()
    with pytest.raises(ValueError):
        build_all(spark, raw_tables(spark, SF_SMALL), root="/tmp/never", buckets=4)
    assert plain["gold_movie_analytics"].exists(spark)
