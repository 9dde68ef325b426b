"""Registered queries of the training-data operators, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rentyield.llm import (balancing, bpe, itq, language_id, minhash, packing, periodic_runs, pii, quality_rules, resampling, revisits,
                           suffix_dedup, toxicity)
from rentyield.llm.tables import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolved_pages(table(spark, sf_dir, "pages"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents")).drop("lang")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents")).drop("spans")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


def op13_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balancing.mixed(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_itq": op2_itq,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_revisits": op4_revisits,
    "op5_minhash": op5_minhash,
    "op6_bpe": op6_bpe,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_pii": op10_pii,
    "op11_resampling": op11_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_balancing": op13_balancing,
}

SQL: dict[str, str] = {
    "op4_revisits": revisits.SQL,
}
