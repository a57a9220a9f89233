"""One query per operator over its whole table, with production parameters, and its SQL if any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terratally.llm import (
    decontamination,
    extraction,
    jaccard,
    katz,
    licenses,
    merkle,
    negatives,
    packing,
    pii,
    quality,
    sharding,
    substrings,
    warc,
)
from terratally.llm.common import new_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(_table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.decontaminate(documents, benchmark)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "kept"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(_table(spark, sf_dir, "documents")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(_table(spark, sf_dir, "documents")).drop("kept")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.round_trip(_table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(_table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.manifest(_table(spark, sf_dir, "documents"), merkle.tampered_text()))


def op13_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_pii": op5_pii,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_katz_backoff": op8_katz_backoff,
    "op9_warc": op9_warc,
    "op10_html_extraction": op10_html_extraction,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_jump_sharding": op13_jump_sharding,
}

SQL: dict[str, str] = {
    "op3_quality_rules": quality.QUALITY_SQL,
    "op11_hard_negatives": negatives.MINING_SQL,
    "op12_merkle_manifest": merkle.MANIFEST_SQL,
    "op13_jump_sharding": sharding.SHARDING_SQL,
}
