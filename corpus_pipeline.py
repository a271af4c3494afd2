"""Training-corpus pipeline: quality, exact copies, near copies, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last keep
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playmetrics.llm import content_sort, odd_sketch, ordinal_quality, packing, weak_pii
from playmetrics.llm.common import prepare, read, tokenizer_path
from playmetrics.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier selects; it learns from labels of this input."""
    return ordinal_quality.drop_low_quality(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest identifier stays."""
    return content_sort.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the smallest identifier stays."""
    return odd_sketch.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked in the texts; n_chars follows."""
    return weak_pii.mask(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with the sequence and offset each one gets."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packed),
]

# SQL expresses neither the fitted models nor the tokenizer; tests/llm compares
# the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each result is written as Parquet and reread."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
