"""Available-now micro-batches over what has been published since the last run.

A stream decides *which* batches are new; loading them is the same work as in a batch run and is
keyed by batch id, so a micro-batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.dedup import LINEAGE_TIES
from stratalake.plans.bronze import load_bronze
from stratalake.plans.silver import load_silver, upsert_rows
from stratalake.plans.state import State
from stratalake.sources import lake as tables
from stratalake.sources.lake import Lake
from stratalake.sources.landing import MANIFEST, MANIFEST_SCHEMA
from stratalake.sources.specs import DatasetSpec, TypedSpec


def bronze_stream(
    spark: SparkSession, lake: Lake, spec: DatasetSpec, checkpoint: str, state: State | None = None
) -> StreamingQuery:
    """Load newly landed batches into bronze. The stream follows the manifests, which appear when a
    batch is complete, so a batch is never seen in part however its files are spread."""
    manifests = (
        spark.readStream.schema(MANIFEST_SCHEMA)
        .option("multiLine", True)
        .json(f"{lake.landing}/{spec.source_system}/{spec.dataset}/batch_id=*/{MANIFEST}")
    )

    def load(micro: DataFrame, _: int) -> None:
        ids = [r.batch_id for r in micro.select("batch_id").collect()]
        if ids:
            load_bronze(spark, lake, spec, state, only=ids)

    return (
        manifests.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def bronze_streams(
    spark: SparkSession, lake: Lake, specs: Sequence[DatasetSpec], checkpoint: str, state: State | None = None
) -> list[StreamingQuery]:
    """One stream for each dataset that is taken in more often than daily."""
    return [bronze_stream(spark, lake, s, f"{checkpoint}/{s.source_system}.{s.dataset}", state) for s in specs]


def silver_stream(
    spark: SparkSession, lake: Lake, dataset: str, checkpoint: str, state: State | None = None, with_source_rules: bool = False
) -> StreamingQuery:
    """Bring bronze batches into silver as their files appear: typed, judged, quarantined, upserted."""
    path = lake.table_path("bronze", dataset)
    arrivals = spark.readStream.schema(tables.read_table(spark, path).schema).parquet(path)

    def load(micro: DataFrame, _: int) -> None:
        if not micro.isEmpty():
            load_silver(spark, lake, dataset, state, with_source_rules=with_source_rules)

    return (
        arrivals.select("batch_id").writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    spark: SparkSession, lake: Lake, stream: DataFrame, spec: TypedSpec, checkpoint: str, ties: Sequence[str] = LINEAGE_TIES
) -> StreamingQuery:
    """Keep the newest row per key of a stream of typed rows in a silver table. Each micro-batch
    rewrites the key buckets it touches; one that is replayed upserts the same rows again."""

    def apply(micro: DataFrame, epoch: int) -> None:
        upsert_rows(spark, lake, spec, micro, f"epoch-{epoch}", ties)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
