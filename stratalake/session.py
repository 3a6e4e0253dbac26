"""Spark session settings every job of this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Paths that are read by name are listed by so many tasks, not by one task each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def get_session(app_name: str = "stratalake", master: str | None = None, **conf: str) -> SparkSession:
    """Reuse the running session (a cluster's or a driver's) or build one with our settings."""
    builder = SparkSession.builder.appName(app_name)
    if master and SparkSession.getActiveSession() is None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Our settings on a session someone else built; all of them can be changed while it runs."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A folder that all executors share: ``spark.checkpoint.dir``, or else the session's warehouse.

    Never a folder that every machine has of its own: where the executors are other processes, a warehouse that only the
    default names (a local folder under the driver's own) is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse lies on each machine's own disk")
    return warehouse
