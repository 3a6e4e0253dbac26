"""What a restartable pipeline remembers, as append-only tables beside the data.

``audit/landed_files`` lists the files of each run, written by executors; they count once
``audit/extractions`` has a record of the run, which also carries its watermark. ``audit/pipeline_runs``
holds a record for the begin and one for the end of every run. The present state is a query over these logs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import audit
from stratalake.sources import lake as tables
from stratalake.sources.lake import Lake

ERROR_TEXT_LIMIT = 2000
# The audit tables' columns, which reports rely on.
RUN_SCHEMA = (
    "run_id string, pipeline_name string, source_system string, dataset string, batch_id string, "
    "started_at timestamp, finished_at timestamp, status string, records_extracted bigint, "
    "records_processed bigint, records_rejected bigint, watermark_from string, watermark_to string, "
    "error_type string, error_message string, details string"
)
EXTRACTION_SCHEMA = (
    "kind string, source_system string, dataset string, watermark string, batch_id string, run_id string, updated_at timestamp"
)
FILE_SCHEMA = (
    "source_system string, dataset string, file_name string, sha256 string, record_count bigint, batch_id string, run_id string"
)


def failure(error: BaseException | None) -> dict[str, str | None]:
    """What a run's record says of an error; the text is cut, as messages may quote data."""
    if error is None:
        return {"error_type": None, "error_message": None}
    return {"error_type": type(error).__name__, "error_message": f"{error}"[:ERROR_TEXT_LIMIT]}


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class State:
    def __init__(self, spark: SparkSession, lake: Lake) -> None:
        self.spark = spark
        self._runs = lake.table_path("audit", "pipeline_runs")
        self._extractions = lake.table_path("audit", "extractions")
        self._files = lake.table_path("audit", "landed_files")

    # ---------------------------------------------------------------- increments

    def extractions(self) -> DataFrame:
        log = tables.read_table(self.spark, self._extractions)
        return self.spark.createDataFrame([], EXTRACTION_SCHEMA) if log is None else log

    def watermarks(self) -> DataFrame:
        return audit.latest_watermarks(self.extractions().filter("kind = 'watermark'"))

    def get_watermark(self, source: str, dataset: str) -> str | None:
        row = self.watermarks().filter((F.col("source_system") == source) & (F.col("dataset") == dataset)).first()
        return row.watermark if row else None

    def _watermark(self, source: str, dataset: str, watermark: str | None, batch_id: str | None, run_id: str) -> DataFrame:
        kind = "files" if watermark is None and run_id != "reset" else "watermark"
        row = (kind, source, dataset, watermark, batch_id, run_id, utc_now())
        return self.spark.createDataFrame([row], EXTRACTION_SCHEMA)

    def reset_watermark(self, source: str, dataset: str) -> None:
        tables.append(self._watermark(source, dataset, None, None, "reset"), self._extractions)

    def processed_files(self, source: str, dataset: str) -> DataFrame:
        log = tables.read_table(self.spark, self._files)
        log = self.spark.createDataFrame([], FILE_SCHEMA) if log is None else log
        mine = (F.col("source_system") == source) & (F.col("dataset") == dataset)
        counted = self.extractions().filter(mine).select("run_id").distinct()
        return log.filter(mine).join(counted, "run_id", "left_semi").select("file_name", "sha256", "record_count", "batch_id")

    def is_file_processed(self, source: str, dataset: str, file_name: str, sha256: str) -> bool:
        known = self.processed_files(source, dataset)
        return not known.filter((F.col("file_name") == file_name) & (F.col("sha256") == sha256)).isEmpty()

    def commit_extraction(
        self, source: str, dataset: str, run_id: str, batch_id: str,
        watermark: str | None = None, files: DataFrame | None = None,
    ) -> None:
        """List the landed files, then advance the watermark (kept when None) by one record that makes both count."""
        if files is not None:
            listed = files.select(
                F.lit(source).alias("source_system"), F.lit(dataset).alias("dataset"), "file_name", "sha256", "record_count",
                F.lit(batch_id).alias("batch_id"), F.lit(run_id).alias("run_id"),
            )
            tables.append(listed, self._files)
        if files is not None or watermark is not None:
            tables.append(self._watermark(source, dataset, watermark, batch_id, run_id).coalesce(1), self._extractions)

    # -------------------------------------------------------------------- audit

    def start_run(
        self, pipeline: str, source: str, dataset: str, batch_id: str,
        watermark_from: str | None = None, run_id: str | None = None,
    ) -> dict[str, Any]:
        return self.start_runs(pipeline, source, dataset, [batch_id], watermark_from, run_id)[0]

    def start_runs(
        self, pipeline: str, source: str, dataset: str, batch_ids: Sequence[str],
        watermark_from: str | None = None, run_id: str | None = None,
    ) -> list[dict[str, Any]]:
        """Record runs of several batches as running, in one append."""
        blank = dict.fromkeys(name for name, _ in (c.split() for c in RUN_SCHEMA.split(", ")))
        begun = {
            **blank, "pipeline_name": pipeline, "source_system": source, "dataset": dataset, "started_at": utc_now(), "status": "running",
            "records_extracted": 0, "records_processed": 0, "records_rejected": 0, "watermark_from": watermark_from,
        }
        runs = [{**begun, "run_id": run_id or str(uuid.uuid4()), "batch_id": b} for b in batch_ids]
        self._append_runs(runs)
        return runs

    def finish_run(self, run: dict[str, Any], status: str, *, error: BaseException | None = None,
                   details: Any = None, **counts: Any) -> None:
        self.finish_runs([self.finished(run, status, error, details, **counts)])

    @staticmethod
    def finished(run: dict[str, Any], status: str, error: BaseException | None = None, details: Any = None, **counts: Any) -> dict[str, Any]:
        """The end record of a run."""
        told = json.dumps(details) if details else None
        return run | failure(error) | counts | {"status": status, "finished_at": utc_now(), "details": told}

    def finish_runs(self, records: Sequence[dict[str, Any]]) -> None:
        """Append end records of several runs at once."""
        if records:
            self._append_runs(list(records))

    def _append_runs(self, runs: list[dict[str, Any]]) -> None:
        tables.append(self.spark.createDataFrame(runs, RUN_SCHEMA).coalesce(1), self._runs)

    def runs(self) -> DataFrame:
        """Runs as they stand; one that waited behind another's failure and was never tried is none."""
        log = tables.read_table(self.spark, self._runs)
        log = self.spark.createDataFrame([], RUN_SCHEMA) if log is None else log
        return audit.current_runs(log).filter("status <> 'skipped'")

    def list_runs(self, limit: int = 50) -> DataFrame:
        return audit.recent_runs(self.runs(), limit)

    def register_views(self) -> None:
        audit.register_views(self.runs(), self.watermarks())
