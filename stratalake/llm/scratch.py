"""Intermediate tables in the folder that the cluster names in ``spark.checkpoint.dir``.

Where the session names none (tests), the warehouse folder of the session is used, unless it would be a folder that each
machine of a cluster has of its own: that is an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stratalake.session import scratch_dir


def folder(spark: SparkSession, what: str) -> str:
    """A new folder of its own for one intermediate table."""
    return f"{scratch_dir(spark).rstrip('/')}/llm-scratch/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet and read again: later reads don't depend on the executors that made it."""
    path = folder(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def removed(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more; what ``stored`` didn't return is left alone."""
    for table in tables:
        path = getattr(table, "stored_at", None)
        if path is not None:
            context = table.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
