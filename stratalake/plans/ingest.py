"""Sources into landed batches, with the same guarantees whatever the source.

A run is recorded, its rows or files are landed whole or not at all, and only then do the watermark
and the file ledger advance. A run that fails leaves both, and the landing zone, as they were.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.incremental import incremental_window, next_watermark, updated_since, window_upper
from stratalake.plans.state import State, utc_now
from stratalake.sources import files as source_files
from stratalake.sources import landing, pages
from stratalake.sources.lake import Lake
from stratalake.sources.specs import DatasetSpec

PIPELINE = "ingestion"


class InvalidResponse(Exception):
    """A landed response body does not keep the paging contract."""


@dataclass(frozen=True)
class IngestResult:
    run_id: str
    batch_id: str
    status: str
    records: int
    watermark_to: str | None
    published: bool


Extract = Callable[[str, "str | None", dict[str, Any]], "tuple[int, str | None, DataFrame | None, list[dict]]"]


def _run(spark: SparkSession, lake: Lake, state: State, spec: DatasetSpec, full_refresh: bool, extract: Extract) -> IngestResult:
    """``extract(batch_id, since, manifest extras)`` lands and returns (records, new watermark,
    landed files, rejected files)."""
    source, dataset = spec.source_system, spec.dataset
    since = None if full_refresh else state.get_watermark(source, dataset)
    batch_id = landing.new_batch_id(utc_now())
    run = state.start_run(PIPELINE, source, dataset, batch_id, since)
    extra = {
        "run_id": run["run_id"], "pipeline_name": PIPELINE, "mode": "full_refresh" if full_refresh else "incremental",
        "extracted_at": utc_now().isoformat(), "watermark_from": since,
    }
    try:
        records, watermark, files, rejected = extract(batch_id, since, extra)
        try:
            state.commit_extraction(source, dataset, run["run_id"], batch_id, watermark, files)
        except BaseException:
            landing.withdraw(spark, lake.landing, spec, batch_id)
            raise
        status = "partial" if rejected else "success"
        watermark_to = watermark or since
        state.finish_run(run, status, records_extracted=records, records_processed=records, watermark_to=watermark_to,
                         details={"rejected_files": rejected} if rejected else None)
    except BaseException as exc:
        state.finish_run(run, "failed", error=exc, watermark_to=since)
        raise
    return IngestResult(run["run_id"], batch_id, status, records, watermark_to, records > 0 or files is not None)


def ingest_table(
    spark: SparkSession, lake: Lake, state: State, spec: DatasetSpec, read: Callable[[str | None, datetime], DataFrame] | DataFrame,
    lag_seconds: float = 0.0, full_refresh: bool = False, max_rows_per_file: int = 100_000, now: datetime | None = None,
) -> IngestResult:
    """Rows of ``(watermark, now - lag]``; the watermark moves to the upper edge even without rows.

    ``read`` is a DataFrame, or a function of (since, upper) for sources that filter themselves.
    """
    upper = window_upper(now or utc_now(), lag_seconds)

    def extract(batch_id: str, since: str | None, extra: dict[str, Any]):
        source = read if isinstance(read, DataFrame) else read(since, upper)
        rows = incremental_window(source, spec.watermark_col, since, upper)
        extra = {**extra, "watermark_to": upper.isoformat(), "rejected_files": []}
        landed = landing.land_rows(rows, lake.landing, spec, batch_id, max_rows_per_file, extra)
        return landed, upper.isoformat(), None, []

    return _run(spark, lake, state, spec, full_refresh, extract)


def ingest_pages(
    spark: SparkSession, lake: Lake, state: State, spec: DatasetSpec, envelopes: DataFrame, fields: list[str] | None = None,
    body: str = "body", full_refresh: bool = False, max_rows_per_file: int = 100_000,
) -> IngestResult:
    """Whole rows of response bodies updated at or after the watermark; it moves to the newest seen.

    Bodies that break the contract, or that are not all pages of the set, fail the run.
    """

    def extract(batch_id: str, since: str | None, extra: dict[str, Any]):
        rows, refused = pages.explode_pages(envelopes, spec.watermark_col, fields, body)
        bad = refused.select("reason").first() or pages.incomplete_pages(pages.judge_pages(envelopes, spec.watermark_col, body)).first()
        if bad.reason is not None:
            raise InvalidResponse(bad.reason)
        stamp = F.col(spec.watermark_col).try_cast("timestamp")
        stamped = rows.withColumn("_stamp", stamp)
        fresh = stamped if since is None else updated_since(stamped, since, "_stamp")
        newest = next_watermark(fresh, "_stamp").select(F.date_format("watermark", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")).first()[0]
        extra = {**extra, "watermark_to": newest or since, "rejected_files": []}
        landed = landing.land_rows(fresh.drop("_stamp"), lake.landing, spec, batch_id, max_rows_per_file, extra)
        return landed, newest, None, []

    return _run(spark, lake, state, spec, full_refresh, extract)


def ingest_files(
    spark: SparkSession, lake: Lake, state: State, spec: DatasetSpec, root: str, full_refresh: bool = False
) -> IngestResult:
    """New or changed well-formed files, copied unchanged; the others are reported on every run."""

    def extract(batch_id: str, since: str | None, extra: dict[str, Any]):
        found = source_files.inspect_files(spark, f"{root.rstrip('/')}/{spec.directory}", spec.pattern)
        fresh = source_files.new_files(found, state.processed_files(spec.source_system, spec.dataset), full_refresh)
        # One small row per file; kept so that the contents are read once.
        judged = source_files.file_verdicts(fresh.persist(), spec.kind, spec.required_columns).persist()
        try:
            rejected = [r.asDict() for r in judged.filter("reason is not null").select("file_name", "reason").orderBy("file_name").collect()]
            extra = {**extra, "watermark_to": since, "rejected_files": rejected}
            count = landing.land_files(judged, lake.landing, spec, batch_id, extra)
            records = judged.agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0]
            kept = None
            if count:
                listed = landing.listed_files(spark, [landing.batch_path(lake.landing, spec, batch_id)])
                kept = listed.selectExpr("name as file_name", "sha256", "rows as record_count")
        finally:
            judged.unpersist()
            fresh.unpersist()
        return records, None, kept, rejected

    return _run(spark, lake, state, spec, full_refresh, extract)
