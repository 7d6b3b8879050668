"""One registered query per training-data operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelhouse.llm import (
    backtrack_bpe,
    block_names,
    curriculum_mix,
    decontaminate,
    hilbert_shards,
    license_digest,
    partenum_join,
    phrase_dedup,
    secret_markov,
    spelling_variants,
    token_store,
    toxicity,
    vantage_clusters,
)
from reelhouse.llm.tables import documents, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_store.report(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, literal_specials=False)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), n=13)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_names.exact_groups(documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.report(documents(spark, sf_dir))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum_join.near_duplicates(documents(spark, sf_dir), n=4, percent=85)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.assign(documents(spark, sf_dir), shards=8)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum_mix.scheduled(documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.find_licenses(documents(spark, sf_dir))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_markov.report(documents(spark, sf_dir))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return backtrack_bpe.report(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.report(documents(spark, sf_dir), min_chars=5, min_count=3, damage=97, factor=2)


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage_clusters.report(table(spark, sf_dir, "embeddings"), k=40, rounds=5, salt="2")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_toxicity, op2_token_store, op3_decontamination, op4_exact_dedup, op5_suffix_dedup,
             op6_ngram_join, op7_sharding, op8_mixing, op9_license_scan, op10_secret_scan, op11_bpe, op12_spelling, op13_clusters)
    return {f.__name__: f for f in found}
