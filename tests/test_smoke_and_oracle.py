"""t1 smoke and t2 oracle (every registered query against its DuckDB SQL, sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from reelhouse.plans import registry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    first = df.schema
    assert df.count() > 0
    assert E.entry(spark).schema == first


def test_every_query_has_oracle():
    missing = set(registry.queries()) - set(E.oracle_sql())
    assert missing == set(), missing
    assert set(registry.queries()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def _same(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, float):
                if not (x == y or (math.isnan(x) and math.isnan(y))):
                    return False
            elif x != y:
                return False
    return True


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _same(_canon(df.columns, srows), _canon(ocols, res.fetchall()))


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_column_types_match_oracle(spark, duck, name):
    spark_types = {f.name: f.dataType.simpleString() for f in E.queries()[name](spark, SF_SMALL).schema.fields}
    rel = duck.sql(E.oracle_sql()[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in spark_types.items()} == duck_types


ORDERED = {
    "gold_genre_analytics": lambda r: (-r.total_ratings, r.genre),
    "gold_temporal_trends": lambda r: -r.month,
    "gold_movie_recommendations": lambda r: (r.movie_id, r.recommendation_rank),
    "yearly_rollup": lambda r: r.year,
    "users_by_favorite_genre": lambda r: (-r.users, r.favorite_genre),
    "top_genres": lambda r: (-r.avg_rating, r.genre),
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_final_order(spark, name):
    got = E.queries()[name](spark, SF_SMALL).collect()
    assert len(got) > 1 and got == sorted(got, key=ORDERED[name])
