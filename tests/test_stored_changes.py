"""What goes through written tables: keyed changes, schema growth, ledgers, model state, sketches, bitmaps."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL, rows
from reelhouse.operators import bitmaps, histograms, sketches
from reelhouse.operators import loads as L
from reelhouse.operators.model_state import MovieRatingState
from reelhouse.plans import gold_movies, gold_temporal, gold_users, registry
from reelhouse.streaming.upsert_stream import start_upsert_stream

SCHEMA = "k long, ts long, v string, w string"


def files(base):
    return {os.path.join(d, f) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")}


def thousand(spark, scratch_dir, buckets=16):
    table = L.KeyedTarget(os.path.join(scratch_dir, "table"), ("k",), buckets)
    table.write(spark, spark.range(1000).selectExpr("id as k", "1L as ts", "'old' as v", "'old' as w"), "overwrite")
    return table


def test_entry_without_the_llm_folders(scratch_dir):
    copy = os.path.join(scratch_dir, "copy")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as E; print(len(E.queries()), set(E.queries()) == set(E.oracle_sql()))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(registry.queries())), "True"]


def test_a_source_that_moves_loses_no_stored_rows(spark, scratch_dir, monkeypatch):
    table = thousand(spark, scratch_dir)
    flag = os.path.join(scratch_dir, "more")

    def source(batches):        # once the flag is there, it has rows of other buckets
        import pandas as pd

        for b in batches:
            ids = b["id"].tolist() + (list(range(100, 130)) if os.path.exists(flag) else [])
            yield pd.DataFrame({"k": ids, "ts": 2, "v": "new", "w": "new"})

    put = L.KeyedTarget._put
    monkeypatch.setattr(L.KeyedTarget, "_put", lambda self, df, dynamic: (open(flag, "w").close(), put(self, df, dynamic))[1])
    assert L.upsert_load(spark, spark.range(3).coalesce(1).mapInPandas(source, SCHEMA), table) == 3
    got = table.read(spark)
    assert got.count() == 1000 and got.where("v = 'new'").count() == 3


@pytest.mark.parametrize("mode", ["update_columns", "delete_insert"])
def test_keyed_load_modes_touch_only_their_buckets(spark, scratch_dir, mode):
    table = thousand(spark, scratch_dir)
    before = files(table.base)
    batch = spark.createDataFrame([(5, 1, "a", "a"), (5, 2, "b", None), (2000, 1, "c", "c")], SCHEMA)
    report = L.load_tables(spark, {"t": batch}, {"t": table}, mode=mode, keys={"t": ["k"]}, cursor="ts",
                           update_columns={"t": ["w"]} if mode == "update_columns" else None).first()
    assert (report.status, report.rows) == ("completed", 3)
    got = rows(table.read(spark).where("k in (5, 2000)"), ["k", "ts", "v", "w"])
    want = [(5, 1, "old", None), (2000, 1, "c", "c")] if mode == "update_columns" else [(5, 1, "a", "a"), (5, 2, "b", None), (2000, 1, "c", "c")]
    assert got == want and table.read(spark).where("k not in (5, 2000) and v = 'old'").count() == 999
    assert len(before & files(table.base)) >= 14
    with pytest.raises(ValueError):
        table.upsert(spark, batch, change="delete_insert", update_columns=["w"])
    with pytest.raises(ValueError):
        table.upsert(spark, batch, change="other")


def test_new_columns_of_keyed_tables(spark, scratch_dir):
    table = thousand(spark, scratch_dir)
    before = files(table.base)
    batch = spark.createDataFrame([(5, 2, "b", "b", 1.5)], SCHEMA + ", x double")
    with pytest.raises(L.SchemaChangeError):
        table.upsert(spark, batch, ["ts"])
    table.upsert(spark, batch, ["ts"], policy="append_new_columns")
    got = table.read(spark)
    assert got.count() == 1000 and rows(got.where("x is not null"), ["k", "x"]) == [(5, 1.5)]
    assert len(before & files(table.base)) == 15
    src, more = os.path.join(scratch_dir, "in"), spark.createDataFrame([(6, 3, "s", "s", 2.5, "y")], SCHEMA + ", x double, y string")
    more.write.parquet(src)
    start_upsert_stream(spark, src, more.schema, table, ["ts"], os.path.join(scratch_dir, "ck"),
                        policy="append_new_columns").awaitTermination(120)
    assert rows(table.read(spark).where("y is not null or x is not null"), ["k", "x", "y"]) == [(5, 1.5, None), (6, 2.5, "y")]


def test_stream_gives_one_table_for_any_order_of_files(spark, scratch_dir):
    parts = [spark.createDataFrame([(k, ts, f"{ts}", "w") for k in range(4)], SCHEMA).coalesce(1) for ts in (10, 5, 7)]
    found = []
    for name, order in (("a", (0, 1, 2)), ("b", (2, 0, 1)), ("c", (1, 2, 0))):
        src, table = os.path.join(scratch_dir, f"src-{name}"), L.KeyedTarget(os.path.join(scratch_dir, f"t-{name}"), ("k",), 4)
        for i in order:
            parts[i].write.mode("append").parquet(src)
        start_upsert_stream(spark, src, SCHEMA, table, ["ts"], os.path.join(scratch_dir, f"ck-{name}"),
                            max_files_per_trigger=1).awaitTermination(120)
        found.append(rows(table.read(spark)))
    assert found[0] == found[1] == found[2] and {r[1] for r in found[0]} == {10}


def test_stream_skips_a_batch_that_was_merged_before_a_crash(spark, scratch_dir, monkeypatch):
    src, ck = os.path.join(scratch_dir, "src"), os.path.join(scratch_dir, "ck")
    table = L.KeyedTarget(os.path.join(scratch_dir, "t"), ("k",), 4)
    ledger = L.Target(os.path.join(scratch_dir, "ledger"), is_path=True)
    spark.createDataFrame([(1, 1, "a", "a")], SCHEMA).coalesce(1).write.parquet(src)
    start_upsert_stream(spark, src, SCHEMA, table, ["ts"], ck, ledger=ledger).awaitTermination(120)
    for f in os.listdir(os.path.join(ck, "commits")):      # merged, but the checkpoint does not know
        os.remove(os.path.join(ck, "commits", f))
    calls = []
    upsert = L.KeyedTarget.upsert
    monkeypatch.setattr(L.KeyedTarget, "upsert", lambda self, *a, **b: (calls.append(1), upsert(self, *a, **b))[1])
    start_upsert_stream(spark, src, SCHEMA, table, ["ts"], ck, ledger=ledger).awaitTermination(120)
    assert not calls and table.read(spark).count() == 1 and ledger.read(spark).count() == 1


def test_ledger_takes_up_failed_tables_only(spark, scratch_dir):
    ledger = L.Target(os.path.join(scratch_dir, "ledger"), is_path=True)
    good = L.Target(os.path.join(scratch_dir, "good"), is_path=True)
    bad = L.Target(os.path.join(scratch_dir, "bad"), is_path=True)
    one = spark.range(3)
    broken = one.select(F.raise_error(F.lit("no source")).cast("long").alias("id"))
    run = lambda second: {r.table: r.status for r in L.load_tables(
        spark, {"good": one, "bad": second}, {"good": good, "bad": bad}, "append", ledger=ledger, load_id="day-1").collect()}
    assert run(broken) == {"good": "completed", "bad": "failed"}
    assert run(one) == {"good": "skipped", "bad": "completed"}
    assert run(one) == {"good": "skipped", "bad": "skipped"}
    assert good.read(spark).count() == 3 and bad.read(spark).count() == 3
    assert sorted((r.table, r.status) for r in ledger.read(spark).collect()) == [("bad", "completed"), ("bad", "failed"), ("good", "completed")]
    with pytest.raises(ValueError):
        L.load_tables(spark, {"good": one}, {"good": good}, ledger=ledger)


def test_bitmaps_count_as_distinct_counts_do(spark):
    ids = [None, 0, 0, -1, 1, -32767, -32768, 32768, 32769, 2**40, -(2**40), 5, 5]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(ids)] + [(2, None)], "g int, id long")
    want = {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("id").alias("n")).where("n > 0").collect()}
    parts = [bitmaps.id_bitmaps(df.where(c), ["g"], "id") for c in ("id > 0", "id <= 0 or id is null")]
    for made in (bitmaps.id_bitmaps(df, ["g"], "id"), bitmaps.merged_bitmaps(parts[0].unionByName(parts[1]), ["g"])):
        assert {r.g: r.n for r in bitmaps.distinct_ids(made, ["g"], "n").collect()} == want
    assert bitmaps.distinct_ids(bitmaps.id_bitmaps(df.limit(0), ["g"], "id"), ["g"], "n").count() == 0


def test_bitmaps_of_scattered_ids_take_no_more_than_the_ids(spark):
    df = spark.range(4000).selectExpr("id % 100 as g", "id * 40009 as id")
    held = bitmaps.id_bitmaps(df, ["g"], "id").collect()
    assert len(held) <= 4000 and sum(len(r.ids) if isinstance(r.ids, (bytes, bytearray)) else 8 for r in held) <= 8 * 4000


def test_a_large_bucket_is_written_by_several_tasks(spark, scratch_dir):
    table = L.KeyedTarget(os.path.join(scratch_dir, "t"), ("k",), 1)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(key)
    df = spark.range(0, 60_000, 1, 8).selectExpr("id as k", "sha2(cast(id as string), 256) as v")
    try:
        spark.conf.set(key, 128 << 10)
        table._put(table._bucketed(df), dynamic=False)
    finally:
        spark.conf.set(key, kept)
    assert len(files(table.base)) > 1 and rows(table.read(spark)) == rows(df)


def test_bitmap_models_have_no_expand(spark):
    s = registry.SilverFrames(spark, SF_SMALL)
    for df in (gold_temporal.monthly_metrics(s["silver_ratings"], s["silver_movies"], distinct="bitmap"),
               gold_users.user_tag_metrics_by_bitmap(s["silver_tags"])):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_movie_state_by_increments_equals_a_full_build(spark, scratch_dir):
    ratings = registry.SilverFrames(spark, SF_SMALL)["silver_ratings"]
    state = MovieRatingState(os.path.join(scratch_dir, "state"), buckets=8)
    some = ratings.where("movie_id % 50 = 7")
    state.merge(spark, ratings.where("movie_id % 50 <> 7 or hour_of_day < 12"), 1)
    before = files(state.cells.target.base)
    state.merge(spark, some.where("hour_of_day >= 12"), 2)
    kept = before & files(state.cells.target.base)
    full = gold_movies.movie_rating_metrics(ratings)
    assert rows(state.metrics(spark)) == rows(full.select(*state.metrics(spark).columns))
    now = files(state.cells.target.base)
    state.merge(spark, some.where("hour_of_day >= 12"), 2)      # a replay merges nothing
    assert files(state.cells.target.base) == now and rows(state.metrics(spark)) == rows(full.select(*state.metrics(spark).columns))
    assert kept and kept != before


def test_sketch_quantiles_stay_within_their_rank_error(spark):
    df = spark.range(60_000).selectExpr("id % 3 as g", "id % 12 as part", "pow(rand(5), 3) as x").unionByName(
        spark.createDataFrame([(0, 0, None), (7, 0, None)], "g long, part long, x double"))
    stored = sketches.value_sketches(df, ["g", "part"], "x")
    counts = histograms.value_counts(df, ["g"], "x")
    found = sketches.rank_errors(sketches.merged_sketches(stored, ["g"]), counts, ["g"], "x", {"p25": 0.25, "p50": 0.5, "p99": 0.99}).collect()
    assert {r.g for r in found} == {0, 1, 2} and all(r.n == 20_000 for r in found)
    assert all(r[f"{q}_error"] <= 2 * sketches.rank_error(400) for r in found for q in ("p25", "p50", "p99"))


def test_small_modes_equal_modes(spark):
    df = spark.range(400).selectExpr("id % 7 as k", "cast(pmod(hash(id), 24) as bigint) as hour").unionByName(
        spark.createDataFrame([(9, 0), (9, 63), (10, 63)], "k long, hour long"))
    for small in ((), ("hour",)):
        got = rows(histograms.modes(df, ["k"], {"hour": "mode"}, small=small))
        assert got == rows(histograms.modes(df, ["k"], {"hour": "mode"}))
    with pytest.raises(Exception, match="0 to 63"):
        histograms.small_mode_from_counts(histograms.value_counts(spark.createDataFrame([(1, 64)], "k int, hour int"), ["k"], "hour"),
                                          ["k"], "hour", "m").collect()
