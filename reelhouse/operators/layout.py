"""Layout of stored tables (S14): clustered files of a chosen size, and compaction of small ones, by Spark's own writes.

A clustered write cuts the rows into ranges of the cluster columns and sorts each, so a file holds one range and
its minimum and maximum let readers skip it.  Rows of one value are cut further by a hash of the whole row: a hot
value fills several files, which then meet in that value alone.

``compact`` rewrites only partitions with two or more small files.  Their rows are staged in the checkpoint
folder and then replace the partitions (dynamic partition overwrite).  A job that fails before its commit changes
nothing.  As with every dynamic overwrite, a driver lost in the commit can leave a partition away; its rows are
still in the staged folder.  Appends must not run at the same time, as rows that arrive between the two steps
would be replaced.

Nulls sort first and are a partition of their own; an empty table has no files to compact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .loads import Target, staged

#: Output files aim at this size, or at so many rows where these compress well: one task sorts the rows of a file,
#: and what they take in its memory follows their number.
FILE_BYTES, FILE_ROWS = 256 << 20, 2 << 20


def stored_files(spark: SparkSession, target: Target, columns: Sequence[str] = ()) -> DataFrame:
    """(columns, file_path, file_size, rows) of a path table; with partition columns only footers are read."""
    files = target.read(spark).select(*[F.col(f"`{c}`") for c in columns], F.col("_metadata.file_path").alias("file_path"),
                                      F.col("_metadata.file_size").alias("file_size"))
    return files.groupBy(*[f"`{c}`" for c in columns], "file_path", "file_size").agg(F.count(F.lit(1)).alias("rows"))


def clustered(df: DataFrame, cluster_by: Sequence[str], n_files: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """The rows in ``n_files`` ranges of the partition and cluster columns, each sorted."""
    order = [F.col(f"`{c}`") for c in (*partition_by, *cluster_by)]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.repartitionByRange(n_files, *order, spread).sortWithinPartitions(*order)


def write_clustered(df: DataFrame, target: Target, cluster_by: Sequence[str], n_files: int,
                    partition_by: Sequence[str] = (), mode: str = "overwrite", dynamic: bool = False) -> None:
    """Write at most ``n_files`` files and one more for each partition after the first."""
    if not target.is_path:
        raise ValueError("clustered writes take path tables")
    w = clustered(df, cluster_by, n_files, partition_by).write.mode(mode).format(target.fmt)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    w.save(target.location)


def small_partitions(spark: SparkSession, target: Target, partition_by: Sequence[str], file_bytes: int = FILE_BYTES,
                     small: float = 0.5, file_rows: int = FILE_ROWS) -> DataFrame:
    """(partition columns, files, bytes, rows) of the partitions with two or more files under ``small`` of size and rows."""
    files = stored_files(spark, target, partition_by)
    found = files.groupBy(*[f"`{c}`" for c in partition_by]).agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"), F.sum("rows").alias("rows"),
        F.count_if((F.col("file_size") < small * file_bytes) & (F.col("rows") < small * file_rows)).alias("_small"))
    return found.where("_small >= 2").drop("_small")


def compact(spark: SparkSession, target: Target, partition_by: Sequence[str], cluster_by: Sequence[str],
            file_bytes: int = FILE_BYTES, small: float = 0.5, file_rows: int = FILE_ROWS) -> int:
    """Rewrite the partitions that hold small files, clustered; returns how many were rewritten."""
    if not partition_by:
        raise ValueError("compaction replaces partitions; write an unpartitioned table anew with write_clustered")
    if clash := {"files", "bytes", "file_path", "file_size", "rows"} & set(partition_by):
        raise ValueError(f"partition columns {sorted(clash)} have the names of file properties")
    found = staged(small_partitions(spark, target, partition_by, file_bytes, small, file_rows))
    size = found.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).first()
    if not size.n:
        return 0
    stored, these = target.read(spark), found.select(*[F.col(f"`{c}`").alias(f"_of_{c}") for c in partition_by])
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_of_{c}`")) for c in partition_by])
    rows = staged(stored.join(these, same, "left_semi"))
    n_files = max(math.ceil(size.bytes / file_bytes), math.ceil(size.rows / file_rows))
    write_clustered(rows, target, cluster_by, n_files, partition_by, dynamic=True)
    return size.n
