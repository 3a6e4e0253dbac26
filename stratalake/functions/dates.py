"""Calendar keys as integer arithmetic, which stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(moment: Column) -> Column:
    """yyyyMMdd as an int."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")


def key_year(key: Column) -> Column:
    return F.call_function("div", key, F.lit(10000)).cast("int")


def key_month(key: Column) -> Column:
    return F.call_function("div", key % 10000, F.lit(100)).cast("int")


def iso_text(moment: Column) -> Column:
    """ISO 8601 with the offset; the fraction only where there is one."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.date_trunc("second", moment) == moment, whole).otherwise(exact)
