"""Views over the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_summary(runs: DataFrame) -> DataFrame:
    """Runs, outcomes, record totals and last start per pipeline, source and dataset."""
    return runs.groupBy("pipeline_name", "source_system", "dataset").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == "success").alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.sum("records_extracted").alias("total_records_extracted"),
        F.sum("records_processed").alias("total_records_processed"),
        F.sum("records_rejected").alias("total_records_rejected"),
        F.max("started_at").alias("last_run_at"),
    )


FAILED_RUN_COLUMNS = (
    "run_id", "pipeline_name", "source_system", "dataset", "batch_id",
    "started_at", "finished_at", "error_type", "error_message",
)


def failed_runs(runs: DataFrame) -> DataFrame:
    return runs.filter("status = 'failed'").select(*FAILED_RUN_COLUMNS).orderBy(F.desc("started_at"))


def recent_runs(runs: DataFrame, limit: int = 50, newest_first: str = "run_id") -> DataFrame:
    """The last ``limit`` runs; equal starts fall to the later ``newest_first``."""
    return runs.orderBy(F.desc("started_at"), F.desc(newest_first)).limit(limit)


def latest_watermarks(log: DataFrame) -> DataFrame:
    """Newest watermark per source and dataset from an append-only log.

    A reset is a record without a watermark and hides what came before it. The newest record is
    found with ``max_by``, so the log is combined per key before it is shuffled.
    """
    newest = F.max_by(F.struct("watermark", "updated_at", "run_id"), F.struct("updated_at", "run_id"))
    return (
        log.groupBy("source_system", "dataset")
        .agg(newest.alias("w"))
        .filter("w.watermark is not null")
        .select("source_system", "dataset", "w.watermark", "w.updated_at", "w.run_id")
    )


def processed_total(runs: DataFrame, default: int = 0) -> DataFrame:
    """Records processed by successful runs (``default`` without any) and the number of runs."""
    done = F.sum(F.when(F.col("status") == "success", F.col("records_processed")))
    return runs.agg(F.coalesce(done, F.lit(default)).alias("records_processed"), F.count(F.lit(1)).alias("total_runs"))


def current_runs(log: DataFrame) -> DataFrame:
    """One row per run from its start and finish records: the finish once there is one."""
    w = Window.partitionBy("run_id").orderBy(F.desc_nulls_last("finished_at"))
    return log.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def register_views(runs: DataFrame, watermarks: DataFrame) -> None:
    run_summary(runs).createOrReplaceTempView("vw_pipeline_run_summary")
    failed_runs(runs).createOrReplaceTempView("vw_pipeline_failed_runs")
    watermarks.createOrReplaceTempView("vw_dataset_ingestion_watermarks")
