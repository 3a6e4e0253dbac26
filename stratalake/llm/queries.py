"""One query per operator over the whole given tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import compression, decontaminate, html_text, jaccard_join, language_id, language_model, packing, periodic_runs, prefix_trie, quality_rules, sharding, sql, suffix_dedup, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"
#: Of an Arrow batch that goes to a Python worker: 10,000 rows, Spark's own limit, may be any number of bytes.
BATCH_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package, wherever the session was started, and bounds the bytes of their batches."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, text: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if text is not None:
            SQL[name] = text
        return fn

    return register


@query("op1_decontamination", sql.DECONTAMINATION)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op2_html_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(table(spark, sf_dir, "pages"))


@query("op3_language_model")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_jaccard_join", sql.JACCARD_JOIN)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


@query("op6_suffix_dedup", sql.SUFFIX_DEDUP)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_url_filter")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.report(table(spark, sf_dir, "pages"))


@query("op8_compression_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.report(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequences(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


@query("op11_periodic_runs", sql.PERIODIC_RUNS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op12_prefix_trie", sql.PREFIX_TRIE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


@query("op13_language_id")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
