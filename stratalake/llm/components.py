"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a minimum per node, combined before the shuffle, and a join back; no node's neighbours are
ever gathered. Steps are stored in the shared folder, so lost executors repeat at most one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.scratch import removed, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.selectExpr("b as a", "a as b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a and b != m").selectExpr("b as a", "m as b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").selectExpr("b as a", "m as b")
    return moved.unionAll(least.selectExpr("a", "m as b")).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (bigint columns a, b) that isn't its component's least node."""
    now, before = stored(edges.where("a != b").select("a", "b").distinct(), "edges"), None
    while True:
        last, now = now, stored(_small_star(_large_star(now)), "stars")
        removed(last)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if state == before:
            return now.selectExpr("a as node", "b as root")
        before = state
