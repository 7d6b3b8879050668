"""Parquet table scans (S05) and the named source registry."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``; projection and filters push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_parquet_glob(spark: SparkSession, glob: str) -> DataFrame:
    """``read_parquet('<glob>')``; Spark expands the glob and splits files."""
    return spark.read.parquet(glob)


class UnknownSourceError(ValueError):
    """Raised for a (source, table) pair that is not registered."""


@dataclass
class SourceRegistry:
    """``(source, table) -> parquet path/glob or catalog table``.

    Entries whose location has the form ``table:cat.ns.tbl`` are read with
    ``spark.table``; everything else is a parquet path or glob.
    """

    entries: dict[tuple[str, str], str] = field(default_factory=dict)

    def register(self, source: str, table: str, location: str) -> "SourceRegistry":
        self.entries[(source, table)] = location
        return self

    def location(self, source: str, table: str) -> str:
        try:
            return self.entries[(source, table)]
        except KeyError:
            raise UnknownSourceError(
                f"source not registered: '{source}.{table}'") from None

    def read(self, spark: SparkSession, source: str, table: str) -> DataFrame:
        loc = self.location(source, table)
        if loc.startswith("table:"):
            return spark.table(loc[len("table:"):])
        return scan_parquet_glob(spark, loc)


def target_namespace(custom: str | None, default: str) -> str:
    """A custom namespace name, trimmed, else the default one."""
    return default if custom is None else custom.strip()
