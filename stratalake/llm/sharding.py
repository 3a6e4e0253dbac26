"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Every input partition counts its rows. Row p of the matrix, how many rows partition p sends to each
shard, is drawn without replacement from the places still free in the shards, so every assignment of
rows to places is equally likely and the shards' sizes are exact. Each partition then permutes its rows
locally and deals them out by its matrix row; each shard permutes again. A shard's permutation is itself
split into ranges of random keys, each ranked by itself, and shifted by the rows of the ranges before.

The law is ``rows``: shard sizes differ by at most one. Equal texts are spread like all other rows.
The matrix has partitions x shards small integers: 128 MB splits of 100 TB make 800,000 x 16; it is drawn on
the driver from one count per partition and joined back by partition. Only keys, sizes and CRCs are
stored in the shared folder before the draw, so a recomputed task can't change what was drawn.

Defined results: a null text has size 1 and CRC 0; null ids and repeated rows are rows like others; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratalake.llm.scratch import stored

RANGE_ROWS = 50_000


def hypergeometric(rng: random.Random, draws: int, good: int, total: int) -> int:
    """How many of ``draws`` places taken at random from ``total`` fall among ``good`` of them.

    Exact, by inversion from the mode outwards: the expected number of steps is a few deviations.
    """
    low, high = max(0, draws + good - total), min(draws, good)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    log = math.lgamma
    at_mode = math.exp(
        log(good + 1) - log(mode + 1) - log(good - mode + 1) + log(total - good + 1) - log(draws - mode + 1)
        - log(total - good - draws + mode + 1) - log(total + 1) + log(draws + 1) + log(total - draws + 1))
    left = rng.random() - at_mode
    up, down, p_up, p_down = mode, mode, at_mode, at_mode
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (total - good - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (total - good - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows of each partition for each shard; column sums differ by at most one."""
    rng, total = random.Random(seed), sum(counts)
    free = [total // shards + (j < total % shards) for j in range(shards)]
    out = []
    for n in counts:
        row, places = [], sum(free)
        for j in range(shards):
            taken = hypergeometric(rng, n, free[j], places)
            row.append(taken)
            n, places, free[j] = n - taken, places - free[j], free[j] - taken
        out.append(row)
    return out


def shuffled(rows: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """The rows with ``shard`` and ``slot`` (gapless from 0 in each shard); rows are stored on the way."""
    spark, names = rows.sparkSession, [f"row.`{c}`" for c in rows.columns]
    kept = stored(rows.select(F.struct("*").alias("row"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "rows")
    counted = sorted((r.part, r.n) for r in kept.groupBy("part").agg(F.count("*").alias("n")).collect())
    matrix = communication_matrix([n for _, n in counted], shards, seed)
    sent = spark.createDataFrame(
        [(part, *[sum(row[: j + 1]) for j in range(shards)]) for (part, _), row in zip(counted, matrix)],
        T.StructType([T.StructField("part", T.IntegerType()), *(T.StructField(f"to{j}", T.LongType()) for j in range(shards))]))
    local = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64("at", F.lit(seed)), "at"))
    shard = sum((F.when(F.col("local") > F.col(f"to{j}"), 1).otherwise(0) for j in range(shards)), F.lit(0))
    # the second permutation orders by a second random key, whose top bits name a range
    ranges = max(1, math.ceil(sum(n for _, n in counted) / shards / RANGE_ROWS))
    dealt = kept.withColumn("local", local).join(sent, "part").select(
        "row", "at", shard.alias("shard"), F.xxhash64(F.lit(seed + 1), "at").alias("key")).withColumn("range", F.pmod("key", F.lit(ranges)))
    sizes = dealt.groupBy("shard", "range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n")
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("shard", "range").orderBy("key", "at")))
    return ranked.join(sizes.select("shard", "range", before.alias("before")), ["shard", "range"]).select(
        *names, F.col("shard").cast("int").alias("shard"), (F.col("before") + F.col("rank") - 1).cast("bigint").alias("slot"))


def bytes_of(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def report(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = docs.select("doc_id", (F.octet_length(bytes_of(F.col("text"))) + 1).cast("bigint").alias("size"), F.crc32(bytes_of(F.col("text"))).alias("text_crc32"))
    return shuffled(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
