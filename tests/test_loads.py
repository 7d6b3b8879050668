"""Loads: properties of the merge plans and the side-effecting loaders."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from reelhouse.operators import loads as L
from reelhouse.sources.batches import ORDER_CURSOR, ORDER_KEY, orders_batches
from reelhouse.sources.tables import read_table


@pytest.fixture(scope="module")
def batches(spark):
    return orders_batches(spark, SF_SMALL)


def test_upsert_is_idempotent(spark, batches):
    old, new = batches
    once = L.upsert_frame(old, new, ORDER_KEY, [ORDER_CURSOR])
    twice = L.upsert_frame(once, new, ORDER_KEY, [ORDER_CURSOR])
    assert rows(once) == rows(twice)
    assert once.count() == once.select("o_orderkey").distinct().count()


def test_upsert_equals_replay_in_pieces(spark, batches):
    old, new = batches
    whole = L.upsert_frame(old, new, ORDER_KEY, [ORDER_CURSOR])
    a = new.where(F.col("o_orderkey") % 2 == 0)
    b = new.where(F.col("o_orderkey") % 2 == 1)
    pieces = L.upsert_frame(L.upsert_frame(old, a, ORDER_KEY, [ORDER_CURSOR]), b, ORDER_KEY, [ORDER_CURSOR])
    assert rows(whole) == rows(pieces)


def test_newest_wins_and_hot_key(spark):
    df = spark.createDataFrame([(1, i, f"v{i}") for i in range(500)] + [(2, 0, "only")], "k int, ts int, v string")
    got = {r.k: r.v for r in L.newest_per_key(df, ["k"], ["ts"]).collect()}
    assert got == {1: "v499", 2: "only"}


def test_update_columns_keeps_null_updates(spark):
    t = spark.createDataFrame([(1, "a", 10.0, "x"), (2, "b", 20.0, "y")], "k int, s string, p double, o string")
    s = spark.createDataFrame([(1, None, 11.0, "IGNORED"), (3, "c", 30.0, "z")], "k int, s string, p double, o string")
    got = rows(L.merge_update_columns(t, s, ["k"], ["s", "p"]), ["k", "s", "p", "o"])
    assert got == [(1, None, 11.0, "x"), (2, "b", 20.0, "y"), (3, "c", 30.0, "z")]


def test_delete_insert_keeps_source_duplicates(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(1, "n1"), (1, "n2")], "k int, v string")
    assert rows(L.delete_insert_frame(t, s, ["k"]), ["k", "v"]) == [(1, "n1"), (1, "n2"), (2, "b")]


def test_incremental_batches_then_merge_equal_full_load(spark):
    orders = read_table(spark, SF_SMALL, "orders")
    cut1, cut2 = "1996-01-01", "1998-01-01"
    ts = lambda x: F.lit(x).cast("timestamp_ntz")
    t = orders.where(F.col("o_orderdate") < ts(cut1))
    t = L.incremental_frame(t, orders.where(F.col("o_orderdate") < ts(cut2)), ORDER_CURSOR)
    t = L.incremental_frame(t, orders, ORDER_CURSOR)
    assert rows(t) == rows(orders)
    # the inclusive form with keys also converges to the full table
    k = L.incremental_frame(orders.where(F.col("o_orderdate") < ts(cut1)), orders, ORDER_CURSOR, ORDER_KEY)
    assert rows(k) == rows(orders)


def test_schema_policies(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    i = spark.createDataFrame([(2, 5)], "k int, extra int")
    with pytest.raises(L.SchemaChangeError):
        L.append_with_policy(t, i, "fail")
    assert L.append_with_policy(t, i, "ignore").columns == ["k", "v"]
    a = L.append_with_policy(t, i, "append_new_columns")
    assert a.columns == ["k", "v", "extra"] and rows(a, ["k", "v", "extra"]) == [(1, "a", None), (2, None, 5)]
    s = L.append_with_policy(t, i, "sync_all_columns")
    assert s.columns == ["k", "extra"]
    with pytest.raises(ValueError):
        L.append_with_policy(t, i, "nope")


def test_load_incremental_with_state(spark, scratch_dir):
    orders = read_table(spark, SF_SMALL, "orders")
    target = L.Target(os.path.join(scratch_dir, "orders"), is_path=True)
    state = L.Target(os.path.join(scratch_dir, "state"), is_path=True)
    first = orders.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    n1 = L.load_incremental(spark, first, target, state, "orders", ORDER_CURSOR)
    n2 = L.load_incremental(spark, orders, target, state, "orders", ORDER_CURSOR)
    n3 = L.load_incremental(spark, orders, target, state, "orders", ORDER_CURSOR)
    assert n1 + n2 == orders.count() and n3 == 0
    assert rows(target.read(spark)) == rows(orders)
    # keyed form: re-reads the mark inclusively and upserts (no duplicates)
    t2 = L.KeyedTarget(os.path.join(scratch_dir, "orders_keyed"), tuple(ORDER_KEY), 8)
    s2 = L.Target(os.path.join(scratch_dir, "state_keyed"), is_path=True)
    L.load_incremental(spark, first, t2, s2, "orders", ORDER_CURSOR, keys=ORDER_KEY)
    L.load_incremental(spark, orders, t2, s2, "orders", ORDER_CURSOR, keys=ORDER_KEY)
    assert rows(t2.read(spark)) == rows(orders)


def _files(folder):
    return {os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_upsert_load_rewrites_own_input(spark, scratch_dir, batches):
    old, new = batches
    target = L.KeyedTarget(os.path.join(scratch_dir, "t"), tuple(ORDER_KEY), 8)
    assert L.upsert_load(spark, old, target) == old.count()
    assert L.upsert_load(spark, new, target, [ORDER_CURSOR]) == new.count()
    assert rows(target.read(spark)) == rows(L.upsert_frame(old, new, ORDER_KEY, [ORDER_CURSOR]))


def test_loads_leave_untouched_files_alone(spark, scratch_dir, batches):
    old, new = batches
    base = os.path.join(scratch_dir, "keyed")
    target = L.KeyedTarget(base, tuple(ORDER_KEY), 16)
    L.upsert_load(spark, old, target)
    before = _files(base)
    one = new.where(F.col("o_orderkey") == new.first().o_orderkey)
    L.upsert_load(spark, one, target, [ORDER_CURSOR])
    after = _files(base)
    assert len({f.split(os.sep)[0] for f in before}) == 16
    assert len({f.split(os.sep)[0] for f in before ^ after}) == 1      # one key, one bucket
    # an append adds files and changes none
    path = os.path.join(scratch_dir, "plain")
    L.replace(old, L.Target(path, is_path=True))
    before = _files(path)
    L.append(new, L.Target(path, is_path=True))
    assert before < _files(path)


T2 = "id int, ts int, v string"


def _incremental(spark, scratch_dir, *batches, keys=None, name="x"):
    target = (L.KeyedTarget(os.path.join(scratch_dir, name), tuple(keys), 4) if keys
              else L.Target(os.path.join(scratch_dir, name), is_path=True))
    state = L.Target(os.path.join(scratch_dir, name + "_state"), is_path=True)
    counts = [L.load_incremental(spark, spark.createDataFrame(b, T2), target, state, "t", "ts", keys=keys) for b in batches]
    return counts, rows(target.read(spark), ["id", "ts", "v"]), state


def test_incremental_into_an_empty_target(spark):
    empty, src = spark.createDataFrame([], T2), spark.createDataFrame([(1, 1, "a"), (2, None, "b")], T2)
    want = [(1, 1, "a"), (2, None, "b")]
    assert rows(L.incremental_frame(empty, src, "ts"), ["id", "ts", "v"]) == want
    assert rows(L.incremental_frame(empty, src, "ts", ["id"]), ["id", "ts", "v"]) == want


def test_incremental_null_cursors_and_null_marks(spark, scratch_dir):
    first, later = [(1, None, "a"), (2, None, "b")], [(1, None, "a"), (2, None, "b"), (3, 5, "c"), (4, None, "d")]
    counts, got, state = _incremental(spark, scratch_dir, first, later, later)
    assert counts == [2, 2, 0] and got == sorted(later, key=lambda r: r[0])
    assert [r.last_value for r in state.read(spark).collect()] == ["5"]      # no null mark was committed
    _, got, _ = _incremental(spark, scratch_dir, first, later, later, keys=["id"], name="k")
    assert got == sorted(later, key=lambda r: r[0])


def test_incremental_late_rows_at_the_mark(spark, scratch_dir):
    first = [(1, 1, "a"), (2, 5, "b")]
    later = [(1, 1, "a"), (2, 5, "b"), (3, 5, "late"), (3, 5, "late"), (4, 6, "d")]
    counts, got, _ = _incremental(spark, scratch_dir, first, later, later)
    assert counts == [2, 3, 0] and got == later


def test_incremental_rerun_after_a_crash_before_the_mark(spark, scratch_dir):
    first, later = [(1, 1, "a")], [(1, 1, "a"), (2, 2, "b"), (2, 2, "b")]
    _, _, state = _incremental(spark, scratch_dir, first)
    target = L.Target(os.path.join(scratch_dir, "x"), is_path=True)
    L.append(spark.createDataFrame(later[1:], T2), target)      # the data was written, the mark was not
    src = spark.createDataFrame(later, T2)
    assert L.load_incremental(spark, src, target, state, "t", "ts") == 0
    assert rows(target.read(spark), ["id", "ts", "v"]) == later


def test_keyed_incremental_keeps_the_newer_row(spark, scratch_dir):
    _, got, _ = _incremental(spark, scratch_dir, [(1, 5, "new"), (2, 1, "x")], [(1, None, "older"), (2, 7, "y")], keys=["id"])
    assert got == [(1, 5, "new"), (2, 7, "y")]


def test_null_keys_and_unknown_columns_raise(spark):
    t = spark.createDataFrame([(1, 1, "a")], T2)
    with pytest.raises(Exception, match="null key column id"):
        L.upsert_frame(t, spark.createDataFrame([(None, 1, "b")], T2), ["id"]).collect()
    with pytest.raises(L.SchemaChangeError):
        L.upsert_frame(t, t.withColumn("extra", F.lit(1)), ["id"])


def test_lossy_retypes_raise(spark, scratch_dir):
    t, i = spark.createDataFrame([(1, 2)], "k int, v int"), spark.createDataFrame([(1, 1.9)], "k int, v double")
    for policy in ("ignore", "append_new_columns"):
        with pytest.raises(L.SchemaChangeError):
            L.append_with_policy(t, i, policy)
    assert rows(L.append_with_policy(t, i, "sync_all_columns"), ["k", "v"]) == [(1, 1.9), (1, 2.0)]
    target = L.Target(os.path.join(scratch_dir, "drift"), is_path=True)
    L.append(t, target)
    with pytest.raises(L.SchemaChangeError):
        L.append(spark.createDataFrame([(1, "x")], "k int, v string"), target)
    assert target.read(spark).count() == 1


def test_schema_policies_in_loads(spark, scratch_dir):
    t, i = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(2, 5)], "k int, extra int")
    want = {"ignore": [(1, "a"), (2, None)], "append_new_columns": [(1, "a", None), (2, None, 5)]}
    for policy, cols in (("ignore", ["k", "v"]), ("append_new_columns", ["k", "v", "extra"])):
        for keyed in (False, True):
            path = os.path.join(scratch_dir, f"{policy}{keyed}")
            target = L.KeyedTarget(path, ("k",), 1) if keyed else L.Target(path, is_path=True, merge_schema=True)
            args = {"mode": "merge", "keys": {"t": ["k"]}} if keyed else {"mode": "append"}
            if keyed and policy == "append_new_columns":
                continue      # a bucket that no batch touches keeps the old columns: needs a full refresh
            assert L.load_tables(spark, {"t": t}, {"t": target}, **args).first().rows == 1
            assert L.load_tables(spark, {"t": i}, {"t": target}, **args).first().status == "failed"
            done = L.load_tables(spark, {"t": i}, {"t": target}, policy=policy, **args).first()
            assert (done.status, done.rows) == ("completed", 1), done.message
            assert rows(target.read(spark), cols) == want[policy]
    with pytest.raises(L.SchemaChangeError):
        L.append(i, L.Target(os.path.join(scratch_dir, "ignoreFalse"), is_path=True), policy="sync_all_columns")


def test_partitioned_write_and_append(spark, scratch_dir, batches):
    old, _ = batches
    target = L.Target(os.path.join(scratch_dir, "p"), is_path=True)
    L.write_frame(old.withColumn("y", F.year("o_orderdate")), target, "overwrite", partition_by=["y"],
                  rebalance=True, max_records_per_file=1000)
    back = target.read(spark)
    assert "y" in back.columns and back.count() == old.count()
    L.append(old.withColumn("y", F.year("o_orderdate")), target, partition_by=["y"])
    assert target.read(spark).count() == 2 * old.count()


def test_namespace_and_catalog_table(spark):
    L.ensure_namespace(spark, "silver_t")
    L.ensure_namespace(spark, "silver_t")
    t = L.Target("silver_t.tiny")
    L.replace(spark.range(3), t)
    assert t.exists(spark) and t.read(spark).count() == 3
    from reelhouse.sources.tables import SourceRegistry
    reg = SourceRegistry().register("bronze", "tiny", "table:silver_t.tiny")
    assert reg.read(spark, "bronze", "tiny").count() == 3


def test_load_report_isolates_failures(spark):
    def bad():
        raise RuntimeError("boom")
    rep = {r.table: r for r in L.run_loads(spark, {"a": lambda: 5, "b": bad, "c": lambda: 0}).collect()}
    assert rep["a"].status == "completed" and rep["a"].rows == 5
    assert rep["b"].status == "failed" and "boom" in rep["b"].message
    assert rep["c"].status == "completed"


def test_load_tables_modes_and_validation(spark, scratch_dir, batches):
    old, new = batches
    tgt = {"orders": L.KeyedTarget(os.path.join(scratch_dir, "lt"), tuple(ORDER_KEY), 4)}
    plain = {"orders": L.Target(os.path.join(scratch_dir, "lt_plain"), is_path=True)}
    with pytest.raises(ValueError):
        L.load_tables(spark, {"orders": old}, tgt, mode="merge")
    with pytest.raises(ValueError):
        L.load_tables(spark, {"orders": old}, tgt, mode="incremental", cursor=ORDER_CURSOR)
    with pytest.raises(ValueError):
        L.load_tables(spark, {"orders": old}, {}, mode="append")
    rep = L.load_tables(spark, {"orders": old}, tgt, mode="replace").first()
    assert rep.status == "completed" and rep.rows == old.count()
    rep = L.load_tables(spark, {"orders": new}, tgt, mode="merge", keys={"orders": ORDER_KEY}, cursor=ORDER_CURSOR).first()
    assert rep.rows == new.count()
    assert rows(tgt["orders"].read(spark)) == rows(L.upsert_frame(old, new, ORDER_KEY, [ORDER_CURSOR]))
    for _ in range(2):      # appends every row again
        assert L.load_tables(spark, {"orders": old}, plain, mode="append").first().rows == old.count()
    assert plain["orders"].read(spark).count() == 2 * old.count()
    rep = L.load_tables(spark, {"orders": new}, plain, mode="merge", keys={"orders": ORDER_KEY}).first()
    assert rep.status == "failed" and "KeyedTarget" in rep.message


def test_keyed_first_load_keeps_newest_per_key(spark, scratch_dir, batches):
    _, new = batches     # `new` holds two versions of every tenth key
    target = L.KeyedTarget(os.path.join(scratch_dir, "first_keyed"), tuple(ORDER_KEY), 4)
    state = L.Target(os.path.join(scratch_dir, "first_keyed_state"), is_path=True)
    L.load_incremental(spark, new, target, state, "orders", ORDER_CURSOR, keys=ORDER_KEY)
    got = target.read(spark)
    assert got.count() == got.select("o_orderkey").distinct().count()
    assert rows(got) == rows(L.newest_per_key(new, ORDER_KEY, [ORDER_CURSOR]))
    # repeating the same load (as after a failure before the mark commit) changes nothing
    L.load_incremental(spark, new, target, state, "orders", ORDER_CURSOR, keys=ORDER_KEY)
    assert rows(target.read(spark)) == rows(L.newest_per_key(new, ORDER_KEY, [ORDER_CURSOR]))


def test_checkpoint_dir_uses_the_configured_folder(spark):
    from reelhouse.session import checkpoint_dir

    configured = spark.sparkContext.getCheckpointDir()
    got = checkpoint_dir(spark)
    assert got and (configured is None or got == configured)
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()   # stable, no new folder


def test_checkpoint_dir_is_required_on_a_cluster():
    from types import SimpleNamespace

    from reelhouse.session import checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)
