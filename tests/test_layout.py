"""Clustered files, compaction of small ones, and ranges of skewed keys."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reelhouse.operators import layout
from reelhouse.operators.loads import Target, append
from reelhouse.sources.readers import equi_depth_predicates


def files(base):
    return {os.path.join(d, f) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")}


def bounds(spark, target, column):
    got = target.read(spark).groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
    return sorted((r.lo, r.hi) for r in got)


def test_clustered_files_have_disjoint_ranges_and_split_a_hot_value(spark, scratch_dir):
    even, hot = (Target(os.path.join(scratch_dir, n), is_path=True) for n in ("even", "hot"))
    df = spark.range(20_000).selectExpr("(id * 7919) % 20000 as k", "id as v")
    layout.write_clustered(df, even, ["k"], 8)
    spans = bounds(spark, even, "k")
    assert len(spans) == 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    layout.write_clustered(df.withColumn("k", F.expr("if(v % 3 = 0, 5000, k)")), hot, ["k"], 8)
    spans = bounds(spark, hot, "k")
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and sum(a <= 5000 <= b for a, b in spans) >= 3
    assert layout.stored_files(spark, hot).agg(F.max("rows")).first()[0] < 5000


def test_compaction_rewrites_only_partitions_with_small_files(spark, scratch_dir):
    target = Target(os.path.join(scratch_dir, "t"), is_path=True)
    part = F.expr("case when id % 4 = 3 then null else concat('p ', id % 4) end")
    for i in range(4):      # p 0 has one file, the others four
        df = spark.range(i * 1000, i * 1000 + 1000).withColumn("p", part).withColumn("x", F.lit("é"))
        append(df.where("p is null or p <> 'p 0'").coalesce(1) if i else df.coalesce(1), target, partition_by=["p"])
    before, want = files(target.location), rows(target.read(spark))
    assert layout.compact(spark, target, ["p"], ["id"]) == 3
    after = files(target.location)
    assert rows(target.read(spark)) == want and len(before) == 13 and len(after) == 4
    assert {os.path.dirname(f) for f in before & after} == {os.path.join(target.location, "p=p 0")}
    assert layout.compact(spark, target, ["p"], ["id"]) == 0 and files(target.location) == after


def test_compaction_bounds_the_rows_of_a_file(spark, scratch_dir):
    target = Target(os.path.join(scratch_dir, "r"), is_path=True)
    for i in range(4):
        append(spark.range(i, 8000, 4).withColumn("p", F.lit("a")).coalesce(1), target, partition_by=["p"])
    want = rows(target.read(spark))
    assert layout.compact(spark, target, ["p"], ["id"], file_rows=2000) == 0      # full by rows, though small by bytes
    assert layout.compact(spark, target, ["p"], ["id"], file_rows=4100) == 1
    spans = bounds(spark, target, "id")
    assert len(spans) == 2 and spans[0][1] < spans[1][0] and rows(target.read(spark)) == want
    assert layout.stored_files(spark, target).agg(F.max("rows")).first()[0] < 4800
    assert layout.compact(spark, target, ["p"], ["id"], file_rows=4100) == 0


def test_compaction_of_empty_tables_and_bad_arguments(spark, scratch_dir):
    target = Target(os.path.join(scratch_dir, "e"), is_path=True)
    spark.range(3).withColumn("p", F.lit(1)).limit(0).write.partitionBy("p").parquet(target.location)
    with pytest.raises(ValueError):
        layout.compact(spark, target, [], ["id"])
    with pytest.raises(ValueError):
        layout.compact(spark, target, ["rows"], ["id"])
    with pytest.raises(ValueError):
        layout.write_clustered(spark.range(1), Target("t"), ["id"], 1)


def met(df, predicates):
    """Rows by the number of predicates they meet, and the rows of each predicate."""
    flags = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    total = sum(flags[1:], flags[0])
    times = {r[0]: r[1] for r in df.select(total.alias("n")).groupBy("n").count().collect()}
    return times, list(df.agg(*[F.sum(f) for f in flags]).first())


def test_equi_depth_ranges_of_a_skewed_key(spark):
    df = spark.range(30_000).selectExpr(
        "case when id % 3 = 0 then 77 when id % 1000 = 1 then null else cast(pow(2, id % 40) as bigint) + id end as k",
        "if(id % 500 = 0, null, id * 13 % 30000) as t")
    for then_by in (None, "t"):
        predicates = equi_depth_predicates(df, "k", 12, then_by)
        times, sizes = met(df, predicates)
        assert times == {1: 30_000}
        assert max(sizes) < (4000 if then_by else 10_500)
        times, _ = met(spark.createDataFrame([(-5, 1), (2**62, None), (77, 10**6), (None, None)], "k long, t long"), predicates)
        assert times == {1: 4}


def test_equi_depth_ranges_of_dates_and_empty_keys(spark):
    days = spark.range(1000).selectExpr("date_add(date'2020-01-01', cast(id as int)) as d")
    predicates = equi_depth_predicates(days, "d", 4)
    times, sizes = met(days, predicates)
    assert times == {1: 1000} and max(sizes) < 300 and len(predicates) == 5
    assert equi_depth_predicates(days.limit(0), "d", 4) == ["d IS NOT NULL", "d IS NULL"]
    assert equi_depth_predicates(days, "d", 1) == ["d IS NOT NULL", "d IS NULL"]
    with pytest.raises(ValueError):
        equi_depth_predicates(days, "d", 0)
