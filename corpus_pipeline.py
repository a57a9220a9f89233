"""The corpus pipeline: each stage works on what its predecessor has kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from terratally.llm import decontamination, jaccard, packing, pii, quality
from terratally.llm.common import Stages, discard, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept(docs).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return jaccard.one_of_each(docs).select(*COLUMNS)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without questions of the benchmark, in its own or other words for the values."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean(docs, benchmark).select(*COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and ``n_chars`` brought up to date."""
    return pii.redact(docs).selectExpr(
        "doc_id", "text", "lang", "source", "cast(length(text) as bigint) AS n_chars"
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in the training sequences."""
    return packing.pack(docs)


_OWNER = Stages()


def _owned(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage``, whose tables go when the next stage starts on its written result."""

    @wraps(stage)
    def run_owned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return _OWNER.run(stage, spark, docs, sf_dir)

    return run_owned


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", _owned(keep_good)),
    ("ngram_jaccard_join", _owned(keep_one_of_each)),
    ("benchmark_decontamination", _owned(keep_unleaked)),
    ("pii", _owned(hide_personal_data)),
    ("best_fit_packing", _owned(pack)),
]

#: Neither near-duplicate components nor packing can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    previous = None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if previous is not None:
            discard(previous)
        previous = docs
    return STAGES[-1][1](spark, docs, sf_dir)
