"""CSV (S01) and JDBC (S02-S04, S20) connectors.

JDBC reads are split into ``num_partitions`` range queries on a numeric column so
a large table is read in parallel; no JDBC driver jar ships with this repo, so
the JDBC helpers are only exercised through option building in the tests.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Typed schemas of the four raw CSV files (header row, camelCase keys).
RAW_CSV_SCHEMAS = {
    "movies": "movieId bigint, title string, genres string",
    "ratings": "userId bigint, movieId bigint, rating double, timestamp bigint",
    "tags": "userId bigint, movieId bigint, tag string, timestamp string",
    "links": "movieId bigint, imdbId bigint, tmdbId bigint",
}


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with a header.  A declared schema avoids the extra inference pass;
    ``inferSchema`` is only the fallback.  A doubled quote inside a quoted field is one
    quote (RFC 4180)."""
    reader = spark.read.option("header", "true").option("mode", "FAILFAST").option("escape", '"')
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def read_raw_csvs(spark: SparkSession, folder: str, names=("movies", "ratings", "tags", "links")) -> dict[str, DataFrame]:
    """The four raw files ``{folder}/{name}.csv``."""
    return {n: read_csv(spark, f"{folder.rstrip('/')}/{n}.csv", RAW_CSV_SCHEMAS.get(n)) for n in names}


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetch_size: int = 10000,
                 extra: dict | None = None) -> dict[str, str]:
    """Options of a partitioned JDBC scan or write (credentials come from the caller)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def read_jdbc_table(spark: SparkSession, **kw) -> DataFrame:
    """One table, read in parallel range partitions."""
    return spark.read.format("jdbc").options(**jdbc_options(**kw)).load()


def _literal(value) -> str:
    """A value of a range bound as SQL."""
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def _cuts(keys: DataFrame, column: str, parts: int) -> tuple[list, set]:
    """Distinct quantiles of a column that cut it into ``parts``, and those that fill a part or more on their own."""
    at = [i / parts for i in range(1, parts)]
    if not at:
        return [], set()
    found = keys.agg(F.percentile_approx(F.col(f"`{column}`"), at, 100 * parts)).first()[0] or []
    return sorted(set(found)), {v for v in found if found.count(v) > 1}


def _ranges(name: str, cuts: list, hot: set) -> list[tuple[str, object]]:
    """Disjoint conditions over all values and null, in order; a hot value has one of its own, which names it."""
    out, above = [], None
    for v in cuts:
        low = [above] if above else []
        out.append((" AND ".join([*low, f"{name} < {_literal(v)}"]), None))
        if v in hot:
            out.append((f"{name} = {_literal(v)}", v))
        above = f"{name} > {_literal(v)}" if v in hot else f"{name} >= {_literal(v)}"
    out.append((above or f"{name} IS NOT NULL", None))
    return [*out, (f"{name} IS NULL", None)]


def equi_depth_predicates(keys: DataFrame, column: str, parts: int, then_by: str | None = None) -> list[str]:
    """``predicates`` of a JDBC scan whose ranges hold about ``1 / parts`` of the rows each.

    ``keys`` has the key column of the table (and ``then_by``), numbers, dates or timestamps: an earlier copy of it, or a scan of these columns alone.
    The ranges come from quantiles (``percentile_approx``, an aggregate; ``parts - 1`` values reach the driver), so
    gaps and skew in the key do not matter.  A value that fills more than one part gets a predicate of its own, cut
    further by quantiles of ``then_by`` where that is given.  Every row, nulls included, meets exactly one predicate,
    also rows that ``keys`` does not have.  An empty or all-null key gives two predicates, for values and for null.
    Bounds that are no numbers are written as quoted text, which databases read as the column's type.
    """
    if parts < 1:
        raise ValueError("parts must be 1 or more")
    cuts, hot = _cuts(keys, column, parts)
    out = []
    for condition, value in _ranges(column, cuts, hot):
        if value is None or then_by is None:
            out.append(condition)
            continue
        rows = keys.where(F.col(f"`{column}`") == F.lit(value))
        share = keys.agg(F.count_if(F.col(f"`{column}`") == F.lit(value)) / F.count(F.lit(1))).first()[0]
        own, own_hot = _cuts(rows, then_by, max(1, round(share * parts)))
        out += [f"{condition} AND {c}" for c, _ in _ranges(then_by, own, own_hot)]
    return out


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, predicates: list[str], **kw) -> DataFrame:
    """One table, one task for each predicate (untested: no driver here)."""
    opts = jdbc_options(url, table, **kw)
    properties = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def list_jdbc_tables(spark: SparkSession, url: str, schema: str, **kw) -> DataFrame:
    """Table names of a schema from ``information_schema.tables``."""
    name = schema.replace("'", "''")
    q = (f"(select table_name from information_schema.tables "
         f"where table_schema = '{name}' and table_type = 'BASE TABLE') t")
    return read_jdbc_table(spark, url=url, table=q, **kw)


#: Options of a range-partitioned scan; they belong to one table, not to a schema.
RANGE_OPTIONS = ("partition_column", "lower_bound", "upper_bound", "num_partitions")


def schema_table_options(url: str, schema: str, name: str, bounds: dict[str, dict] | None = None, **kw) -> dict:
    """The arguments of one table's scan in a schema read: the shared ones and the table's own range."""
    own = dict((bounds or {}).get(name, {}))
    if unknown := set(own) - set(RANGE_OPTIONS):
        raise ValueError(f"{name}: unknown range options {sorted(unknown)}")
    return {"url": url, "table": f"{schema}.{name}", **kw, **own}


def read_jdbc_schema(spark: SparkSession, url: str, schema: str, bounds: dict[str, dict] | None = None,
                     reader: Callable[[str], DataFrame] | None = None, **kw) -> dict[str, DataFrame]:
    """Every table of a schema; the name list is catalog metadata (small).

    ``bounds[table]`` holds that table's ``partition_column``, ``lower_bound``,
    ``upper_bound`` and ``num_partitions``; a table without is read by one task.
    """
    if misplaced := set(kw) & set(RANGE_OPTIONS):
        raise ValueError(f"range options go into bounds, by table: {sorted(misplaced)}")
    names = [r.table_name for r in list_jdbc_tables(spark, url, schema, **kw).collect()]
    if missing := set(bounds or {}) - set(names):
        raise ValueError(f"bounds for tables that {schema} does not have: {sorted(missing)}")
    read = reader or (lambda n: read_jdbc_table(spark, **schema_table_options(url, schema, n, bounds, **kw)))
    return {n: read(n) for n in names}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kw) -> None:
    """Write to a database table (``num_partitions`` caps concurrent connections)."""
    opts = jdbc_options(url, table, **kw)
    if "numPartitions" in opts:
        df = df.coalesce(int(opts["numPartitions"]))
    df.write.format("jdbc").options(**{k: v for k, v in opts.items()
                                        if k not in ("partitionColumn", "lowerBound", "upperBound")}).mode(mode).save()


def export_gzip_parquet(df: DataFrame, path: str) -> None:
    """A full table copy as GZIP Parquet files."""
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)


def with_load_time(df: DataFrame, column: str = "processed_at") -> DataFrame:
    """Append-time lineage column."""
    return df.withColumn(column, F.current_timestamp())
