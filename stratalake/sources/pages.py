"""REST responses that were landed as text: envelopes to rows, and the paging contract itself."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = "struct<data:array<map<string,string>>,page:bigint,page_size:bigint,total:bigint,has_more:boolean>"


def judge_pages(envelopes: DataFrame, watermark_field: str, body: str = "body") -> DataFrame:
    """Adds ``page`` (the parsed envelope) and ``reason`` (NULL for a valid one)."""
    parsed = envelopes.withColumn("_page", F.from_json(body, ENVELOPE))
    data = F.col("_page.data")
    lacks_field = F.exists(data, lambda row: ~F.coalesce(F.map_contains_key(row, watermark_field), F.lit(False)))
    stamp = lambda row: row[watermark_field].try_cast("timestamp")
    reason = (
        F.when(F.col(body).isNull() | F.try_parse_json(body).isNull(), "Response is not valid JSON")
        .when(data.isNull() | F.exists(data, lambda row: row.isNull()), "Response must be an object with a 'data' list")
        .when(lacks_field, f"Row is missing watermark field '{watermark_field}'")
        .when(F.exists(data, lambda row: stamp(row).isNull()), f"Row has an unreadable watermark field '{watermark_field}'")
    )
    return parsed.withColumn("reason", reason)


def incomplete_pages(judged: DataFrame) -> DataFrame:
    """One row with ``reason``: why the valid envelopes are not a whole set of pages; NULL if they are.

    Pages count from 1 without gaps or repeats, the last one has no more behind it, and the rows are as
    many as the stated total. Where envelopes don't number their pages or state a total, that is not asked.
    """
    seen = judged.filter("reason is null").agg(
        F.count(F.lit(1)).alias("envelopes"),
        F.count("_page.page").alias("numbered"),
        F.count_distinct("_page.page").alias("different"),
        F.min("_page.page").alias("first"),
        F.max("_page.page").alias("last"),
        F.max_by(F.coalesce("_page.has_more", F.lit(False)), F.coalesce("_page.page", F.lit(0))).alias("more"),
        F.sum(F.size("_page.data")).alias("rows"),
        F.min("_page.total").alias("least"),
        F.max("_page.total").alias("total"),
    )
    gaps = (F.col("numbered") > 0) & ((F.col("first") != 1) | (F.col("different") != F.col("last")) | (F.col("different") != F.col("envelopes")))
    return seen.select(
        F.when(gaps, F.format_string("Pages are not 1 to %d once each", "last"))
        .when(F.col("more"), "The last page says that there are more")
        .when(F.col("least") != F.col("total"), "Pages state different totals")
        .when(F.col("rows") != F.col("total"), F.format_string("Pages hold %d rows of a total of %d", "rows", "total"))
        .alias("reason")
    )


def explode_pages(
    envelopes: DataFrame, watermark_field: str, fields: Sequence[str] | None = None, body: str = "body"
) -> tuple[DataFrame, DataFrame]:
    """(rows with their fields as text, refused envelopes with a reason).

    Without ``fields``, a row keeps every field that any row has; their names are collected.
    """
    judged = judge_pages(envelopes, watermark_field, body)
    rows = judged.filter("reason is null").select(F.explode("_page.data").alias("row"))
    if fields is None:
        found = rows.select(F.explode(F.map_keys("row")).alias("name")).distinct().orderBy("name").collect()
        fields = [r["name"] for r in found] or [watermark_field]
    return (
        rows.select(*[F.col("row")[f].alias(f) for f in fields]),
        judged.filter("reason is not null").select(body, "reason"),
    )


def page_slice(df: DataFrame, page: int, page_size: int, order: Sequence[str | Column]) -> DataFrame:
    """Rows of one page of the sorted set, with ``total`` and ``has_more`` beside each."""
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    total = df.agg(F.count(F.lit(1))).scalar()
    sliced = df.orderBy(*order).offset((page - 1) * page_size).limit(page_size)
    return sliced.withColumn("total", total).withColumn("has_more", F.col("total") > page * page_size)


class PageIndex:
    """A sorted set on disk, from which any page is read without sorting again.

    Building it costs one range shuffle and a sort inside each of ``parts`` ranges. Ties of ``order`` fall to a hash of the
    row, so a value that a third of all rows share is split over ranges too; equal rows stay together. Rows carry their range and
    their place in it. The driver keeps one count per range, so its memory is bounded by ``parts``, not by the rows.
    A page reads the ranges that it lies in, and of these the row groups that hold its places.
    """

    def __init__(self, rows: DataFrame, counts: list[int]):
        self.rows, self.counts = rows, counts
        self.starts = [0, *accumulate(counts)]
        self.total = self.starts.pop()

    @classmethod
    def build(cls, df: DataFrame, order: Sequence[str], path: str, parts: int = 200) -> PageIndex:
        if any(c.startswith("_range") for c in df.columns):
            raise ValueError("columns that begin with _range are the index's own")
        keys = [*order, "_range_tie"]
        placed = F.monotonically_increasing_id()  # the partition's number over 33 bits of the place in it
        (
            df.withColumn("_range_tie", F.xxhash64(*df.columns))
            .repartitionByRange(parts, *keys)
            .sortWithinPartitions(*keys)
            .withColumn("_range_id", placed)
            .select(*df.columns, F.shiftright("_range_id", 33).cast("int").alias("_range"), F.col("_range_id").bitwiseAND((1 << 33) - 1).alias("_range_row"))
            .write.partitionBy("_range").parquet(path)
        )
        fields = [*df.schema.fields, T.StructField("_range_row", T.LongType()), T.StructField("_range", T.IntegerType())]
        rows = df.sparkSession.read.schema(T.StructType(fields)).parquet(path)
        counts = [0] * parts
        for r in rows.groupBy("_range").count().collect():
            counts[r["_range"]] = r["count"]
        return cls(rows, counts)

    def page(self, page: int, page_size: int) -> DataFrame:
        """Rows of one page, with ``total`` and ``has_more`` beside each; empty beyond the last."""
        if page < 1 or page_size < 1:
            raise ValueError("page and page_size start at 1")
        first, stop = (page - 1) * page_size, page * page_size
        held = F.lit(False)
        for number, (start, count) in enumerate(zip(self.starts, self.counts)):
            low, high = max(first, start), min(stop, start + count)
            if low < high:
                held = held | ((F.col("_range") == number) & F.col("_range_row").between(low - start, high - start - 1))
        return self.rows.filter(held).drop("_range", "_range_row").withColumn("total", F.lit(self.total).cast("bigint")).withColumn("has_more", F.lit(self.total > stop))

    def paged(self, page_size: int) -> DataFrame:
        """All rows with ``page`` and ``place`` (from 0 in the whole set), without another sort."""
        if page_size < 1:
            raise ValueError("page and page_size start at 1")
        place = F.array(*[F.lit(s).cast("bigint") for s in self.starts])[F.col("_range")] + F.col("_range_row")
        numbered = self.rows.withColumn("place", place)
        return numbered.withColumn("page", F.call_function("div", F.col("place"), F.lit(page_size)) + 1).drop("_range", "_range_row")
