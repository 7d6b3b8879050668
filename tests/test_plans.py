"""Plan-shape guards for every registered query (read from explain('formatted'))."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from reelhouse.plans import registry

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_plan_shape(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    # every lineitem scan is column-pruned (the glob-scan query returns the whole table)
    if name != "source_glob_scan":
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
            if "l_returnflag" in schema or "l_orderkey" in schema:
                assert schema.count(":") <= 5, f"{name}: {schema}"


def test_plan_report_counts_exchanges_by_kind():
    from plan_report import summarise

    tree = "\n".join([
        "* SortMergeJoin Inner (9)", ":- * Sort (4)", ":  +- Exchange (3)", ":     +- * HashAggregate (2)",
        "+- * BroadcastHashJoin Inner (8)", "   :- ReusedExchange (5)", "   +- BroadcastExchange (7)",
        "      +- SortAggregate (6)", "         +- Scan parquet  (1)"])
    got = summarise(tree, "PushedFilters: [IsNotNull(a)]\nPushedFilters: []")
    assert (got["shuffles"], got["reused"], got["broadcasts"], got["smj"], got["bhj"]) == (1, 1, 1, 1, 1)
    assert (got["partial_agg"], got["sort_agg"], got["scans"], got["pushed"]) == (1, 1, 1, 1)


def test_plan_report_on_a_real_plan(spark):
    from plan_report import summarise

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(1000).selectExpr("id % 7 as k", "id")
        df = a.groupBy("k").count().join(a.groupBy("k").sum("id"), "k")
        df.collect()
        tree = _plan(df).partition("\n\n\n")[0].split("+- == Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = summarise(tree, "")
    assert got["shuffles"] + got["reused"] == 2 and got["broadcasts"] == 0 and got["smj"] == 1
