"""Loads into the lake: replace, append, high-water-mark incremental, keyed upsert,
update-columns merge, delete+insert, schema-change policies and a load report.

The *merge* functions are pure ``DataFrame -> DataFrame`` plans (no action), so they
can be checked, explained and reused inside a streaming ``foreachBatch``.  The
*load* functions perform the write and never rewrite a whole table for a batch: an
append adds files, and an upsert into a ``KeyedTarget`` replaces the key buckets that
the batch touches and no others.  Rows are counted while they are written.
"""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import checkpoint_dir

# ---------------------------------------------------------------------------------
# targets and writes
# ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Target:
    """A catalog table (``cat.ns.tbl``) or a path in a file format.

    Appends may add columns (``append_new_columns``); a path is then read with its
    files' schemas merged, which ``merge_schema`` asks for.
    """

    location: str
    is_path: bool = False
    fmt: str = "parquet"
    merge_schema: bool = False

    def read(self, spark: SparkSession) -> DataFrame:
        if self.is_path:
            reader = spark.read.format(self.fmt)
            if self.merge_schema:
                reader = reader.option("mergeSchema", "true")
            return reader.load(self.location)
        return spark.table(self.location)

    def exists(self, spark: SparkSession) -> bool:
        if not self.is_path:
            return spark.catalog.tableExists(self.location)
        return _path_exists(spark, self.location, self.fmt)

    def write(self, spark: SparkSession, df: DataFrame, mode: str, **opts) -> None:
        write_frame(df, self, mode, **opts)


def _path_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.format(fmt).load(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Whatever happens to its source afterwards (rows that arrive, files that go), all steps of a
    load see the same rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BUCKET = "_key_bucket"
#: How a batch changes a keyed table.
KEYED_CHANGES = ("merge", "update_columns", "delete_insert")


@dataclass(frozen=True)
class KeyedTarget:
    """A path table keyed by ``keys``, stored in ``buckets`` folders by the hash of the key.

    An upsert stages its batch, so the source is read once, and then reads and replaces only
    the folders that the staged batch touches (Spark's dynamic partition overwrite).  A job that fails
    before its commit changes nothing, and a retry repeats the same merge.  The commit itself
    moves one folder after the other: a driver that is lost in it can leave some buckets old and a
    bucket that it was moving away.  To recover, restore these buckets' folders from a copy or
    rebuild the table, then run the same load again; an upsert that ran through is not affected.
    Choose ``buckets`` so that one folder is some 100 MB.

    Columns may be added (``append_new_columns``): buckets that a batch does not touch keep their
    files, and their rows read as null, as files are read with their schemas merged.
    """

    base: str
    keys: tuple[str, ...]
    buckets: int = 64
    fmt: str = "parquet"

    def _bucketed(self, df: DataFrame) -> DataFrame:
        key = F.xxhash64(*[F.col(f"`{k}`") for k in self.keys])
        return df.withColumn(BUCKET, F.pmod(key, F.lit(self.buckets)).cast("int"))

    def exists(self, spark: SparkSession) -> bool:
        return _path_exists(spark, self.base, self.fmt)

    def _stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.fmt).option("mergeSchema", "true").load(self.base)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop(BUCKET)

    def _put(self, df: DataFrame, dynamic: bool) -> None:
        # rebalance: a bucket over the advisory size is written by several tasks, so none sorts a whole large bucket
        (df.hint("rebalance", BUCKET).write.mode("overwrite").format(self.fmt).partitionBy(BUCKET)
         .option("partitionOverwriteMode", "dynamic" if dynamic else "static").save(self.base))

    def write(self, spark: SparkSession, df: DataFrame, mode: str, order_by: Sequence[str] = ()) -> None:
        """``overwrite``: the newest row per key of ``df`` is the table.  Other modes go through ``upsert``."""
        if mode != "overwrite":
            raise ValueError(f"a keyed target takes overwrite or upsert, not {mode!r}")
        self._put(self._bucketed(newest_per_key(df, self.keys, order_by)), dynamic=False)

    def upsert(self, spark: SparkSession, batch: DataFrame, order_by: Sequence[str] = (),
               newest_wins: bool = False, policy: str = "fail", change: str = "merge",
               update_columns: Sequence[str] = ()) -> int:
        """Change the stored rows by ``batch``; returns the rows of the batch.

        * ``merge``: the newest row per key replaces the stored one;
        * ``update_columns``: stored rows take only ``update_columns`` of it, new keys come whole;
        * ``delete_insert``: stored rows with a key of the batch go, all rows of the batch come.
        """
        return self.upsert_staged(spark, staged(batch), order_by, newest_wins, policy, change, update_columns)

    def upsert_staged(self, spark: SparkSession, batch: DataFrame, order_by: Sequence[str] = (),
                      newest_wins: bool = False, policy: str = "fail", change: str = "merge",
                      update_columns: Sequence[str] = ()) -> int:
        """``upsert`` of a batch that is a written table already."""
        if change not in KEYED_CHANGES:
            raise ValueError(f"unknown change {change!r}; use one of {KEYED_CHANGES}")
        if (change == "update_columns") != bool(update_columns):
            raise ValueError("update_columns needs the columns to update, and no other change takes them")
        n = batch.count()
        if not self.exists(spark):
            rows = with_keys(batch, self.keys) if change == "delete_insert" else newest_per_key(batch, self.keys, order_by)
            self._put(self._bucketed(rows), dynamic=False)
            return n
        old = self._stored(spark)
        _, batch = align_schema(old.drop(BUCKET), batch, policy, keep_table=True)
        touched = [r[0] for r in self._bucketed(batch).select(BUCKET).distinct().collect()]  # ``buckets`` numbers at most
        if not touched:
            return n
        part, _ = align_schema(old.where(F.col(BUCKET).isin(touched)).drop(BUCKET), batch, policy, keep_table=True)
        if change == "merge":
            rows = upsert_frame(part, batch, self.keys, order_by, newest_wins)
        elif change == "update_columns":
            rows = merge_update_columns(part, batch, self.keys, update_columns, order_by)
        else:
            rows = delete_insert_frame(part, with_keys(batch, self.keys), self.keys)
        self._put(self._bucketed(rows), dynamic=True)
        return n


def write_frame(df: DataFrame, target: Target, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, compression: str | None = None,
                rebalance: bool = False, max_records_per_file: int | None = None,
                bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Write with a mode, optional partition columns and file options.

    ``rebalance`` asks AQE to cut output partitions to the advisory size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), which sets the file size.
    ``bucket_by=(n, cols)`` writes a bucketed catalog table (hash of ``cols`` into
    ``n`` files per partition, sorted): later aggregations and joins on ``cols``
    between tables bucketed the same way read co-located data without a shuffle.
    """
    if bucket_by and target.is_path:
        raise ValueError("bucketed writes need a catalog table target")
    if rebalance:
        df = df.hint("rebalance", *(partition_by or []))
    w = df.write.mode(mode).format(target.fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    if target.is_path:
        w.save(target.location)
    else:
        w.saveAsTable(target.location)


def replace(df: DataFrame, target: Target, **opts) -> None:
    """S10 full refresh (also the table materialisation of S08)."""
    write_frame(df, target, "overwrite", **opts)


def append(df: DataFrame, target: Target, policy: str = "fail", **opts) -> None:
    """S09 append load: adds files (re-running it appends the rows again, by design).

    The rows are first checked against the table's schema and brought to it by
    ``policy`` (S15), so a drifted batch never leaves a table that cannot be read.
    """
    spark = df.sparkSession
    if target.exists(spark):
        table = target.read(spark)
        added = schema_diff(table.schema, df.schema)["added"]
        _, df = align_schema(table, df, policy, keep_table=True)
        if policy == "append_new_columns" and added and not target.is_path:
            for name in added:
                kind = df.schema[name].dataType.simpleString()
                spark.sql(f"ALTER TABLE {quote_ident(target.location)} ADD COLUMNS (`{name}` {kind})")
        elif policy == "append_new_columns" and added and not target.merge_schema:
            raise SchemaChangeError(f"new columns {added}: read this path with merge_schema to keep them")
    write_frame(df, target, "append", **opts)


def write_v2(df: DataFrame, table: str, mode: str = "replace", partitioned_by: Sequence[str] = (),
             properties: dict[str, str] | None = None, provider: str | None = None) -> None:
    """S08/S14 on a v2 catalog (``writeTo``): create-or-replace with partition transforms
    and table properties, append, or dynamic partition overwrite.

    Untested here: the built-in session catalog is v1 and rejects these operations.
    """
    w = df.writeTo(table)
    if provider:
        w = w.using(provider)
    for k, v in (properties or {}).items():
        w = w.tableProperty(k, v)
    if mode == "replace":
        if partitioned_by:
            w = w.partitionedBy(*[F.col(c) for c in partitioned_by])
        w.createOrReplace()
    elif mode == "append":
        w.append()
    elif mode == "overwrite_partitions":
        w.overwritePartitions()
    else:
        raise ValueError(f"unknown v2 write mode {mode!r}")


def quote_ident(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    """Create the namespace if it does not exist."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quote_ident(namespace)}")


# ---------------------------------------------------------------------------------
# pure merge plans
# ---------------------------------------------------------------------------------


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``; a row with a null key fails the query, as it could neither match nor be matched later."""
    checked = {k: F.when(F.col(f"`{k}`").isNull(), F.raise_error(F.lit(f"null key column {k}")).cast(df.schema[k].dataType))
               .otherwise(F.col(f"`{k}`")) for k in keys}
    return df.withColumns(checked)


def newest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: greatest ``order_by`` (nulls lowest; ties broken by a hash of the row).

    ``max_by`` aggregates partially, so a key with millions of versions is one row
    per task after the map side.  Spark plans it as a sort aggregate (the row is a
    struct), so each task sorts its own rows by key.
    """
    df = with_keys(df, keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    order = F.struct(*[F.col(f"`{c}`") for c in order_by], _row_hash(df).alias("_h"))
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    agg = df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
    return agg.select(*keys, "_row.*").select(*df.columns)


def upsert_frame(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str] = (), newest_wins: bool = False) -> DataFrame:
    """Target rows whose key is absent from the source, plus the newest source row per key.

    ``newest_wins``: a target row that is newer by ``order_by`` than the source's stays
    (on equal order the source's row wins).  Source columns that the target lacks raise.
    """
    if extra := [c for c in source.columns if c not in target.columns]:
        raise SchemaChangeError(f"the target has no columns {extra}; align the schemas first")
    src = newest_per_key(source, keys, order_by).select(*target.columns)
    if newest_wins and order_by:
        both = target.withColumn("_from", F.lit(0)).unionByName(src.withColumn("_from", F.lit(1)))
        return newest_per_key(both, keys, [*order_by, "_from"]).drop("_from")
    kept = target.join(src.select(*keys), list(keys), "left_anti")
    return kept.unionByName(src)


def delete_insert_frame(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """S13 delete+insert: drop every target row whose key is in the source, add all source rows."""
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def merge_update_columns(target: DataFrame, source: DataFrame, keys: Sequence[str],
                         update_columns: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """S13 merge with ``merge_update_columns``.

    Matched keys take only ``update_columns`` from the (newest) source row, even when
    the new value is null; other columns keep the target's values.  Unmatched source
    rows are inserted whole; unmatched target rows are kept.
    """
    src = newest_per_key(source, keys, order_by)
    t = target.select(*[F.col(f"`{c}`").alias(c if c in keys else f"t__{c}") for c in target.columns],
                      F.lit(True).alias("t__hit"))
    s = src.select(*[F.col(f"`{c}`").alias(c if c in keys else f"s__{c}") for c in target.columns],
                   F.lit(True).alias("s__hit"))
    j = t.join(s, list(keys), "full_outer")
    t_hit, s_hit = F.col("t__hit").isNotNull(), F.col("s__hit").isNotNull()
    cols = []
    for c in target.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in update_columns:
            cols.append(F.when(s_hit, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c))
        else:
            cols.append(F.when(t_hit, F.col(f"t__{c}")).otherwise(F.col(f"s__{c}")).alias(c))
    return j.select(*cols)


def rows_after(source: DataFrame, cursor: str, mark: Column | None) -> DataFrame:
    """The rows that a load past the high-water mark must look at.

    Rows at the mark are included (others with the same cursor may arrive later), and
    so are rows with a null cursor, which no mark ever passes; all rows if there is no
    mark yet.  What was loaded before is told apart by ``unloaded_rows`` or by the key.
    """
    if mark is None:
        return source
    c = F.col(cursor)
    return source.where(mark.isNull() | c.isNull() | (c >= mark))


def unloaded_rows(source: DataFrame, target: DataFrame, cursor: str, mark: Column | None) -> DataFrame:
    """Source rows past the mark that the target does not hold yet, as multisets.

    A row that the source has n times and the target m times is loaded n - m times, so
    a late row with the mark's own cursor is found, and repeating a load adds nothing.
    """
    return rows_after(source, cursor, mark).exceptAll(rows_after(target.select(*source.columns), cursor, mark))


def incremental_frame(target: DataFrame, source: DataFrame, cursor: str,
                      keys: Sequence[str] | None = None) -> DataFrame:
    """Target after one incremental batch, the mark taken from the target itself.

    The mark is a scalar subquery (``max(cursor)``), evaluated once by Spark.  With
    ``keys`` the newest row per key wins, by the cursor.
    """
    mark = target.select(F.max(cursor)).scalar()
    if keys:
        return upsert_frame(target, rows_after(source, cursor, mark), keys, [cursor], newest_wins=True)
    return target.unionByName(unloaded_rows(source, target, cursor, mark))


# ---------------------------------------------------------------------------------
# schema change policies (S15) and column naming
# ---------------------------------------------------------------------------------

SCHEMA_POLICIES = ("fail", "ignore", "append_new_columns", "sync_all_columns")


class SchemaChangeError(ValueError):
    pass


def schema_diff(target: T.StructType, incoming: T.StructType) -> dict[str, list[str]]:
    t = {f.name: f.dataType for f in target.fields}
    i = {f.name: f.dataType for f in incoming.fields}
    return {
        "added": [n for n in i if n not in t],
        "removed": [n for n in t if n not in i],
        "retyped": [n for n in i if n in t and t[n] != i[n]],
    }


#: Casts that keep every value: (from, to).
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"), "float": ("double",), "date": ("timestamp", "timestamp_ntz"),
}


def lossless(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is a value of ``new``."""
    return old == new or new.simpleString() in _WIDER.get(old.simpleString(), ())


def align_schema(target: DataFrame, incoming: DataFrame, policy: str,
                 keep_table: bool = False) -> tuple[DataFrame, DataFrame]:
    """Project (existing rows, new rows) to the table schema the policy yields.

    * ``fail``: raise on any difference;
    * ``ignore``: keep the table's columns, new columns dropped, missing ones null;
    * ``append_new_columns``: table columns then the new ones (null on old rows);
    * ``sync_all_columns``: exactly the incoming columns and types.

    A retyped column is only ever cast to a wider type; a lossy retype raises.
    ``keep_table`` says that stored rows stay as they are, so ``sync_all_columns`` raises
    there if it would drop or retype a stored column.
    """
    if policy not in SCHEMA_POLICIES:
        raise ValueError(f"unknown schema policy {policy!r}; use one of {SCHEMA_POLICIES}")
    diff = schema_diff(target.schema, incoming.schema)
    t_types = {f.name: f.dataType for f in target.schema.fields}
    i_types = {f.name: f.dataType for f in incoming.schema.fields}

    def project(df, types, names, out_types):
        for n in names:
            if n in types and not lossless(types[n], out_types[n]):
                raise SchemaChangeError(f"column {n}: {types[n].simpleString()} does not fit into {out_types[n].simpleString()}")
        return df.select(*[
            (F.col(f"`{n}`").cast(out_types[n]) if n in types else F.lit(None).cast(out_types[n])).alias(n)
            for n in names])

    if policy == "fail":
        if any(diff.values()):
            raise SchemaChangeError(f"schema changed: {diff}")
        return target, incoming.select(*target.columns)
    if policy == "sync_all_columns" and keep_table and (diff["removed"] or diff["retyped"]):
        raise SchemaChangeError(f"sync_all_columns needs a full refresh for {diff}")
    if policy == "ignore":
        names, out = target.columns, t_types
    elif policy == "append_new_columns":
        names = target.columns + diff["added"]
        out = {**i_types, **t_types}
    else:
        names, out = incoming.columns, i_types
    return project(target, t_types, names, out), project(incoming, i_types, names, out)


def append_with_policy(target: DataFrame, incoming: DataFrame, policy: str) -> DataFrame:
    old, new = align_schema(target, incoming, policy)
    return old.unionByName(new)


# ---------------------------------------------------------------------------------
# side-effecting loads (S11 S12 S18) and the v2-catalog merge
# ---------------------------------------------------------------------------------

STATE_SCHEMA = "table string, cursor string, last_value string, load_id bigint"


def read_mark(spark: SparkSession, state: Target, table: str, cursor: str, cursor_type) -> Column | None:
    """The last committed mark for (table, cursor) as a scalar subquery, or None."""
    if not state.exists(spark):
        return None
    s = state.read(spark).where((F.col("table") == table) & (F.col("cursor") == cursor))
    if s.isEmpty():
        return None
    return s.select(F.max_by("last_value", "load_id").cast(cursor_type)).scalar()


def load_incremental(spark: SparkSession, source: DataFrame, target: "Target | KeyedTarget", state: Target,
                     table: str, cursor: str, keys: Sequence[str] | None = None, policy: str = "fail") -> int:
    """Load rows past the mark, then commit the new mark (only after the write).

    With a ``KeyedTarget`` the batch is upserted, the newest row per key winning by the
    cursor (a null cursor is the oldest).  Without keys the rows that the target does
    not hold yet are appended.  Both repeat to the same table: a run that died between
    the data write and the mark commit is simply run again.  A batch without any cursor
    value leaves the mark as it is.  Returns the number of rows written (appended, or in the
    batch that was merged).
    """
    if bool(keys) != isinstance(target, KeyedTarget):
        raise ValueError("keys and a KeyedTarget go together")
    mark = read_mark(spark, state, table, cursor, source.schema[cursor].dataType)
    seen = Observation()
    counted = [F.count(F.lit(1)).alias("n"), F.max(cursor).alias("mark")]
    if keys:
        if tuple(keys) != target.keys:
            raise ValueError(f"the target is keyed by {target.keys}, not {tuple(keys)}")
        batch = staged(rows_after(source, cursor, mark))
        found = batch.agg(*counted).first()
        if found.n:
            target.upsert_staged(spark, batch, [cursor], newest_wins=True, policy=policy)
    else:
        exists = target.exists(spark)
        batch = rows_after(source, cursor, mark)
        if exists:
            stored = target.read(spark)
            _, batch = align_schema(stored, batch, policy, keep_table=True)
            batch = batch.exceptAll(rows_after(align_schema(batch, stored, "ignore")[1], cursor, mark))
        append(batch.observe(seen, *counted), target, policy=policy)
        found = Row(**seen.get)
    if found.n and found.mark is not None:
        prev = state.read(spark).agg(F.max("load_id")).first()[0] if state.exists(spark) else None
        last = F.lit(found.mark).cast(source.schema[cursor].dataType).cast("string")
        row = spark.range(1).select(F.lit(table).alias("table"), F.lit(cursor).alias("cursor"), last.alias("last_value"),
                                    F.lit((prev or 0) + 1).cast("bigint").alias("load_id"))
        write_frame(row, state, "append")
    return found.n


def upsert_load(spark: SparkSession, source: DataFrame, target: KeyedTarget, order_by: Sequence[str] = (),
                policy: str = "fail") -> int:
    """S12 on files: replace the key buckets that ``source`` touches; returns its row count."""
    return target.upsert(spark, source, order_by, policy=policy)


def merge_into_table(source: DataFrame, table: str, keys: Sequence[str],
                     update_columns: Sequence[str] | None = None) -> None:
    """S12/S13 on a v2 catalog table with row-level operations (``MERGE INTO``).

    Untested here: no row-level catalog is installed in this environment.
    """
    cond = F.expr(" AND ".join(f"{quote_ident(table)}.`{k}` = src.`{k}`" for k in keys))
    m = source.alias("src").mergeInto(table, cond)
    matched = m.whenMatched()
    if update_columns:
        m = matched.update({c: F.col(f"src.`{c}`") for c in update_columns})
    else:
        m = matched.updateAll()
    m.whenNotMatched().insertAll().merge()


@dataclass
class LoadResult:
    table: str
    status: str
    rows: int | None
    message: str | None


REPORT_SCHEMA = "table string, status string, rows bigint, message string"


LEDGER_SCHEMA = f"load_id string, {REPORT_SCHEMA}, finished_at timestamp"


def completed_tables(spark: SparkSession, ledger: Target, load_id: str) -> set[str]:
    """The tables of one load that its ledger has as completed."""
    if not ledger.exists(spark):
        return set()
    rows = ledger.read(spark).where((F.col("load_id") == load_id) & (F.col("status") == "completed"))
    return {r.table for r in rows.select("table").distinct().collect()}  # the tables of one load


def run_loads(spark: SparkSession, jobs: dict[str, Callable[[], int | None]], ledger: Target | None = None,
              load_id: str | None = None) -> DataFrame:
    """Run each table's load; a failed table is reported and does not stop the rest.

    The ledger gets a row as soon as a table's load ends.  A table that an earlier run of ``load_id``
    completed is reported as ``skipped``.
    """
    done = completed_tables(spark, ledger, load_id) if ledger else set()
    results = []
    for table, job in jobs.items():
        if table in done:
            results.append(LoadResult(table, "skipped", None, None))
            continue
        try:
            results.append(LoadResult(table, "completed", job(), None))
        except Exception as exc:  # noqa: BLE001 - reported per table
            msg = "".join(traceback.format_exception_only(type(exc), exc)).strip()
            results.append(LoadResult(table, "failed", None, msg))
        if ledger:
            r = results[-1]
            row = spark.createDataFrame([(load_id, r.table, r.status, r.rows, r.message, None)], LEDGER_SCHEMA)
            write_frame(row.withColumn("finished_at", F.current_timestamp()), ledger, "append")
    return spark.createDataFrame([(r.table, r.status, r.rows, r.message) for r in results], REPORT_SCHEMA)


# ---------------------------------------------------------------------------------
# the loader's entry point (replace | append | incremental | merge), per table
# ---------------------------------------------------------------------------------

LOAD_MODES = ("replace", "append", "incremental", "merge", "update_columns", "delete_insert")


def load_tables(spark: SparkSession, sources: dict[str, DataFrame],
                targets: dict[str, "Target | KeyedTarget"], mode: str = "append",
                keys: dict[str, Sequence[str]] | None = None, cursor: str | None = None,
                state: Target | None = None, policy: str = "fail",
                update_columns: dict[str, Sequence[str]] | None = None, ledger: Target | None = None,
                load_id: str | None = None) -> DataFrame:
    """Load several tables one by one and return the S18 report (with the rows of each load).

    * ``replace``: full refresh; ``append``: add every row (re-running appends again);
    * ``incremental``: rows past the committed mark of ``cursor`` (needs ``state``);
    * ``merge``: keyed upsert into a ``KeyedTarget`` (needs ``keys[table]``; with ``cursor``
      the newest source row per key wins, and with ``state`` only rows past the mark are read).

    * ``update_columns`` and ``delete_insert``: S13 into a ``KeyedTarget`` (the first needs
      ``update_columns[table]``; with ``cursor`` it takes the newest source row per key).

    ``policy`` is the schema-change policy (S15) of every mode but ``replace``.  With a ``ledger`` each
    table's result is appended to it under ``load_id``, and a rerun of that load takes up only the
    tables that have not completed (S18).  Invalid combinations raise instead of being ignored.
    """
    if (ledger is None) != (load_id is None):
        raise ValueError("a ledger and a load_id go together")
    if mode not in LOAD_MODES:
        raise ValueError(f"unknown load mode {mode!r}; use one of {LOAD_MODES}")
    if policy not in SCHEMA_POLICIES:
        raise ValueError(f"unknown schema policy {policy!r}; use one of {SCHEMA_POLICIES}")
    if mode == "incremental" and (not cursor or state is None):
        raise ValueError("incremental loads need a cursor column and a state table")
    if mode in KEYED_CHANGES:
        missing = [t for t in sources if not (keys or {}).get(t)]
        if missing:
            raise ValueError(f"{mode} needs primary key columns for: {missing}")
    missing_targets = [t for t in sources if t not in targets]
    if missing_targets:
        raise ValueError(f"no target for: {missing_targets}")

    def counted(src: DataFrame, write: Callable[[DataFrame], None]) -> int:
        seen = Observation()
        write(src.observe(seen, F.count(F.lit(1)).alias("n")))
        return seen.get["n"]

    def job(table: str) -> Callable[[], int | None]:
        src, tgt = sources[table], targets[table]

        def run() -> int | None:
            if mode == "replace":
                return counted(src, lambda df: tgt.write(spark, df, "overwrite"))
            if mode == "append":
                return counted(src, lambda df: append(df, tgt, policy=policy))
            if mode == "incremental":
                return load_incremental(spark, src, tgt, state, table, cursor, policy=policy)
            k = list(keys[table])
            if not isinstance(tgt, KeyedTarget) or tgt.keys != tuple(k):
                raise ValueError(f"{mode} needs a KeyedTarget with the keys {k}")
            if mode != "merge":
                return tgt.upsert(spark, src, [cursor] if cursor else [], policy=policy, change=mode,
                                  update_columns=(update_columns or {}).get(table, ()))
            if cursor and state is not None:
                return load_incremental(spark, src, tgt, state, table, cursor, keys=k, policy=policy)
            return upsert_load(spark, src, tgt, [cursor] if cursor else [], policy=policy)
        return run

    return run_loads(spark, {t: job(t) for t in sources}, ledger, load_id)
