"""Report measures over the sales fact, sliceable by any columns, and time intelligence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.dates import key_month, key_year
from stratalake.functions.money import ratio_or_zero


def sales_measures(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales in USD and local currency, orders, items, average order value (0 without orders)."""
    return (
        fact.groupBy(*by)
        .agg(
            F.sum("line_total_usd").cast("decimal(18,2)").alias("total_sales_usd"),
            F.sum("line_total_local").cast("decimal(18,2)").alias("total_sales_local"),
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("total_items_sold"),
        )
        .withColumn("average_order_value_usd", ratio_or_zero(F.col("total_sales_usd"), F.col("total_orders")).cast("decimal(18,6)"))
    )


def customer_measures(fact: DataFrame, customer: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Active customers who bought, and all sales divided by their number.

    Sales are summed per customer before the join, so a customer with a third of all lines is one
    row per slice when it meets the dimension.
    """
    per_customer = fact.groupBy(*by, "customer_id").agg(F.sum("line_total_usd").alias("usd"))
    active = customer.select("customer_id", "is_active")
    return (
        per_customer.join(active, "customer_id", "left")
        .groupBy(*by)
        .agg(
            F.sum("usd").cast("decimal(18,2)").alias("total_sales_usd"),
            F.count_if(F.col("is_active")).alias("active_customers"),
        )
        .withColumn(
            "average_revenue_per_customer_usd",
            ratio_or_zero(F.col("total_sales_usd"), F.col("active_customers")).cast("decimal(18,6)"),
        )
    )


def monthly_revenue(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue per year and month: the small table the time measures work on."""
    key = F.col("order_date_key")
    return fact.groupBy(
        *by, key_year(key).alias("year"), key_month(key).alias("month")
    ).agg(F.sum("line_total_usd").cast("decimal(18,2)").alias("revenue_usd"))


def ytd_revenue(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    to_date = Window.partitionBy(*by, "year").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumn("ytd_revenue_usd", F.sum("revenue_usd").over(to_date).cast("decimal(18,2)"))


def prior_year_revenue(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each month beside the same month a year before; NULL where that month had no sales.

    Every month is offered twice, as itself and as next year's comparison, and the two meet in one
    aggregation: the fact is read once, where a self join would read it twice.
    """
    this_year = F.struct(
        F.col("year").alias("year"), F.col("revenue_usd").alias("now"), F.lit(None).cast("decimal(18,2)").alias("before")
    )
    next_year = F.struct(
        (F.col("year") + 1).alias("year"), F.lit(None).cast("decimal(18,2)").alias("now"), F.col("revenue_usd").alias("before")
    )
    return (
        monthly.select(*by, "month", F.explode(F.array(this_year, next_year)).alias("m"))
        .groupBy(*by, F.col("m.year").alias("year"), "month")
        .agg(
            F.max("m.now").alias("revenue_usd"),
            F.max("m.before").alias("prior_year_revenue_usd"),
            F.count("m.now").alias("_present"),
        )
        .filter(F.col("_present") > 0)
        .drop("_present")
    )


def yoy_growth(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Growth over the prior year as a fraction; 0 where there is nothing to compare with."""
    now, before = F.col("revenue_usd"), F.col("prior_year_revenue_usd")
    return prior_year_revenue(monthly, by).withColumn(
        "yoy_growth", ratio_or_zero(now - before, before).cast("decimal(20,10)")
    )


def daily_revenue(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue per ``sales_date`` and slice; lines whose key is no calendar date are on none and left out."""
    day = F.try_to_date(F.col("order_date_key").cast("string"), "yyyyMMdd")
    return (
        fact.withColumn("sales_date", day)
        .filter("sales_date is not null")
        .groupBy(*by, "sales_date")
        .agg(F.sum("line_total_usd").cast("decimal(18,2)").alias("revenue_usd"))
    )


def to_date_by_day(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each day of a slice beside its year to date, the same day a year before, and that year to that day.

    29 February is compared with 28 February. A day without sales a year before has NULL there, a year
    without sales until that day a NULL sum. Every day is offered twice, as a sale of its own year and as
    a question to the year before, so the fact is read once. A window holds one slice's year: at most 366 days and as many
    questions, however many lines there are.
    """
    money = "decimal(18,2)"
    own = Window.partitionBy(*by, "_year").orderBy("_day")
    offered = F.array(
        F.struct(F.col("sales_date").alias("_on"), F.col("revenue_usd").alias("_sold"), F.lit(False).alias("_asks")),
        F.struct(F.add_months("sales_date", -12).alias("_on"), F.lit(None).cast(money).alias("_sold"), F.lit(True).alias("_asks")),
    )
    rows = (
        daily.select(*by, "sales_date", "revenue_usd", F.explode(offered).alias("_o"))
        .select(*by, "sales_date", "revenue_usd", "_o.*")
        .withColumn("_year", F.year("_on"))
        .withColumn("_day", F.dayofyear("_on"))
    )
    summed = rows.select(
        *by, "sales_date", "revenue_usd", "_asks",
        F.sum("_sold").over(own.rangeBetween(Window.unboundedPreceding, 0)).cast(money).alias("_until"),
        F.max("_sold").over(own.rangeBetween(0, 0)).alias("_then"),
    )
    asks = F.col("_asks")
    return summed.groupBy(*by, "sales_date").agg(
        F.max("revenue_usd").alias("revenue_usd"),
        F.max(F.when(~asks, F.col("_until"))).alias("ytd_revenue_usd"),
        F.max(F.when(asks, F.col("_then"))).alias("prior_year_revenue_usd"),
        F.max(F.when(asks, F.col("_until"))).alias("prior_ytd_revenue_usd"),
    )
