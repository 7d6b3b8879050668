"""Inputs and shared-folder outputs of the operators."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.session import checkpoint_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROW = "_row"


def carried(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and all columns of ``docs`` inside one struct, where no working column meets their names.

    ``select(f"{ROW}.*")`` gives them back.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), *[F.col(f"`{c}`") for c in columns])


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors share (a local one only on a local master)."""
    return (spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)).rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str, compression: str = "snappy") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared folder and read it back."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def drops_shuffles(f: Callable) -> Callable:
    """Shuffle files of what ``f(docs, ...)`` executes go when each execution ends, not when the driver collects its garbage."""
    @functools.wraps(f)
    def run(docs: DataFrame, *args, **kwargs):
        conf = docs.sparkSession.conf
        kept = conf.get(_DROP, None)
        conf.set(_DROP, "true")
        try:
            return f(docs, *args, **kwargs)
        finally:
            if kept is None:
                conf.unset(_DROP)
            else:
                conf.set(_DROP, kept)
    return run


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so tasks can import it anywhere."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="reelhouse-code-")) / "reelhouse_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
