"""Incremental reads of database tables through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def jdbc_url(host: str, port: int, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def window_query(
    schema: str, table: str, watermark: str, since: datetime | None, upper: datetime
) -> str:
    """``SELECT *`` of the rows in ``(since, upper]``: new columns come along. The fixed upper edge
    keeps partitions that read at different moments to the same set of rows."""
    column = _quoted(watermark)
    where = f"{column} <= TIMESTAMPTZ '{upper.isoformat()}'"
    if since is not None:
        where += f" AND {column} > TIMESTAMPTZ '{since.isoformat()}'"
    return f"SELECT * FROM {_quoted(schema)}.{_quoted(table)} WHERE {where}"


def jdbc_options(
    url: str, query: str, fetch_size: int = 10_000, split: tuple[str, object, object, int] | None = None
) -> dict[str, str]:
    """Reader options; ``split`` is (column, lowest, highest, partitions) for a parallel read."""
    options = {"url": url, "dbtable": f"({query}) AS src", "fetchsize": str(fetch_size),
               "sessionInitStatement": "SET default_transaction_read_only = on"}
    if split:
        column, lowest, highest, partitions = split
        options |= {"partitionColumn": column, "lowerBound": str(lowest), "upperBound": str(highest),
                    "numPartitions": str(partitions)}
    return options


def read_window(spark: SparkSession, options: dict[str, str], credentials: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).options(**credentials).load()


def edge_order(df: DataFrame, watermark: str, keys: Sequence[str]) -> DataFrame:
    """The order rows are shown in; nothing downstream depends on it."""
    return df.orderBy(watermark, *keys)
