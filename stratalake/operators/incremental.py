"""Batch cursors: windows over a watermark column and batches that are still to do."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Moment = datetime | str | Column


def as_moment(value: Moment) -> Column:
    """A timestamp column; a time without an offset is read as UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value)


def window_upper(now: datetime, lag_seconds: float = 0.0) -> datetime:
    """Upper edge of the next window: late commits within the lag wait for the run after."""
    return now - timedelta(seconds=lag_seconds)


def incremental_window(
    df: DataFrame, watermark: str, since: Moment | None = None, upper: Moment | None = None
) -> DataFrame:
    """Rows in ``(since, upper]``. Both bounds are plain comparisons, so they reach the scan."""
    bounds = []
    if since is not None:
        bounds.append(F.col(watermark) > as_moment(since))
    if upper is not None:
        bounds.append(F.col(watermark) <= as_moment(upper))
    return reduce(DataFrame.filter, bounds, df)


def updated_since(df: DataFrame, since: Moment, column: str = "updated_at") -> DataFrame:
    """Inclusive lower bound: the boundary row is read again and must be upserted."""
    return df.filter(F.col(column) >= as_moment(since))


def of_currency(df: DataFrame, currency: str, column: str = "quote_currency") -> DataFrame:
    return df.filter(F.col(column) == F.upper(F.lit(currency)))


def next_watermark(df: DataFrame, watermark: str, previous: Moment | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Newest value seen, or the previous watermark when there are no rows."""
    kept = F.lit(None).cast("timestamp") if previous is None else as_moment(previous)
    return df.groupBy(*by).agg(F.coalesce(F.max(watermark), kept).alias("watermark"))


def batch_ids(*tables: DataFrame) -> DataFrame:
    """Every batch id present in any of the tables."""
    return reduce(DataFrame.unionByName, [t.select("batch_id") for t in tables]).distinct()


def pending_batches(available: DataFrame, *loaded: DataFrame) -> DataFrame:
    """Batch ids that are available and in none of the loaded tables.

    Both sides are reduced to distinct ids before the join, so a batch holding a third of all
    rows weighs no more than any other.
    """
    ids = batch_ids(available)
    return ids.join(batch_ids(*loaded), "batch_id", "left_anti") if loaded else ids
