"""A training corpus from raw documents: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelhouse.llm import curriculum_mix, decontaminate, hilbert_shards, partenum_join, tables, toxicity


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the model is fitted on the labelled rows of ``sf_dir``."""
    return toxicity.drop_toxic(docs, tables.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more the smallest doc_id stays."""
    return partenum_join.keep_one(docs, n=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.drop_documents(docs, tables.table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeat or drop out, in the order of training."""
    return curriculum_mix.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with the shard and slot that the Hilbert order gives them."""
    return hilbert_shards.assign(docs, shards=8, keep=True)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The classifier's scores and the Hilbert cells' approximate quantiles are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = tables.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
