"""From raw documents to packed training sequences: five stages over the operators of ``stratalake.llm``.

Each stage takes the documents that its predecessor kept, written as Parquet and read again, and all but
the last return the columns of documents. The classifier removes documents that it rejects; one
document of each group of near copies stays; passages that repeat are cut out of the texts; documents
with test items go; what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import compression, decontaminate, jaccard_join, packing, suffix_dedup
from stratalake.llm.queries import table, tokenizer_path
from stratalake.llm.scratch import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return compression.good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs, size=5, percent=80)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, however few bytes they have; anchors are runs of 13 words."""
    return suffix_dedup.cleaned(docs, 51, 13, words=True)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.sequences(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_copies),
    ("suffix_array_dedup", passages),
    ("benchmark_decontamination", benchmark_items),
    ("best_fit_packing", packed),
]

#: Neither the classifier nor the tokenizer can be said in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
