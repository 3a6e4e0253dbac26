"""Where tables live, and how they are read and written as parquet.

``bronze``, ``quarantine`` and ``audit`` tables are plain parquet. ``silver`` tables are
partitioned by key bucket and version, ``gold`` tables by version; a version counts once it is
recorded (silver) or complete (gold), so a half-written one is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from stratalake.sources import fs

LAYERS = ("bronze", "silver", "gold", "quarantine", "audit")


@dataclass(frozen=True)
class Lake:
    """``root`` may be on any file system Spark can write, such as ``s3a://bucket/prefix``.

    ``buckets`` is the number of key buckets a new silver table gets: choose it so that one bucket
    of the largest table is a few gigabytes.
    """

    root: str
    buckets: int = 16

    @property
    def landing(self) -> str:
        return f"{self.root.rstrip('/')}/landing"

    def table_path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"Unknown layer: {layer!r}")
        if not table or "/" in table:
            raise ValueError(f"Invalid table name: {table!r}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"


#: Partition columns, which are text: a batch called 0042 must not become the number 42.
PARTITION_COLUMNS = ("batch_id", "key_bucket", "version")


def read_folders(spark: SparkSession, folders: Sequence[str], base: str | None = None) -> DataFrame:
    """Parquet folders with every column any of their files has, and partition columns as text.

    A schema that is given decides the types of partition columns, so no setting of the session is touched.
    """
    options = {"basePath": base} if base else {}
    found = spark.read.options(mergeSchema=True, **options).parquet(*folders).schema
    text = StructType([StructField(f.name, StringType() if f.name in PARTITION_COLUMNS else f.dataType, True) for f in found.fields])
    return spark.read.options(**options).schema(text).parquet(*folders)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A plain parquet table with every column any of its files has; None if there is no data."""
    if not fs.exists(spark, path):
        return None
    try:
        return read_folders(spark, [path])
    except AnalysisException as exc:
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def batches_present(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id`` of every partition of a table, from its folders: no data file is opened."""
    ids = [(unquote(name.removeprefix("batch_id=")),) for name in fs.glob_names(spark, f"{path}/batch_id=*")]
    return spark.createDataFrame(ids, "batch_id string")


def read_partitions(spark: SparkSession, path: str, batch_ids: Sequence[str]) -> DataFrame:
    """The given batches of a table. Only their folders are listed and only their schemas merged."""
    return read_folders(spark, [f"{path}/batch_id={quote(b, safe=' ')}" for b in batch_ids], path)


def write_batches(df: DataFrame, path: str) -> None:
    """Replace the ``batch_id`` partitions present in ``df``: writing a batch again is harmless."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def new_version() -> str:
    """Sorts by time down to the microsecond; one writer per table is assumed."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%fZ}-{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, path: str, version: str) -> None:
    df.write.mode("errorifexists").parquet(f"{path}/version={version}")


def read_latest_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version whose write completed (Spark leaves ``_SUCCESS`` when it did)."""
    names = [
        v for v in fs.glob_names(spark, f"{path}/version=*") if fs.exists(spark, f"{path}/{v}/_SUCCESS")
    ]
    return spark.read.parquet(f"{path}/{names[-1]}") if names else None


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
