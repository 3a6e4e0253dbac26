"""Finding the documents whose text is among some texts, without moving the other documents.

``text_key`` is a 64-bit hash of a text; null and empty texts have keys like others. A bit filter of fixed
size (at most ``BITS / 64`` rows, whatever the input) is broadcast; documents that pass it meet the exact
keys in a join, so false alarms of the filter cost time and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.scratch import stored

BITS = 1 << 22


def text_key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def flagged(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` (with a column text_key) and ``flag``: false where text_key is surely not in ``keys``."""
    place = F.pmod("text_key", F.lit(BITS))
    words = keys.select(place.alias("p")).groupBy((F.col("p") / 64).cast("bigint").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("_bits"))
    words = F.broadcast(stored(words, "filter"))
    found = docs.join(words, (place / 64).cast("bigint") == F.col("_word"), "left")
    hit = F.expr(f"shiftrightunsigned(_bits, cast(pmod(text_key, {BITS}) % 64 as int)) & 1") == 1
    return found.withColumn("flag", F.coalesce(hit, F.lit(False))).drop("_word", "_bits")
