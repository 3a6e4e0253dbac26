"""Star schema: calendar, dimensions, sales fact with currency conversion, monthly KPIs.

No join here carries a broadcast hint. For dimensions and rates, Spark broadcasts a side only when its own size check
(table statistics when planning, real shuffle sizes while running) is under
``spark.sql.autoBroadcastJoinThreshold``; beyond that it sort-merges and splits skewed partitions.

Names and types of the output columns are fixed values: those who read the tables rely on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.dates import date_key, key_month, key_year
from stratalake.functions.money import RATE, converted, discount_or_zero, line_amount, narrow_product, to_money

BASE_CURRENCY = "USD"


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def _spine(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.expr("sequence(first_day, last_day, interval 1 day)")).alias("full_date"))


def dim_date(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """One row per day of the closed range."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return _calendar(_spine(bounds))


def dim_date_covering(df: DataFrame, column: str) -> DataFrame:
    """The calendar from the first to the last day found in ``column``."""
    day = F.col(column).cast("date")
    return _calendar(_spine(df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))))


def _dimension(df: DataFrame, columns: list[str | Column], load_ts: Column | None) -> DataFrame:
    """Distinct rows first, the load time after: one time for the whole load."""
    return df.select(*columns).distinct().withColumn("updated_at", F.current_timestamp() if load_ts is None else load_ts)


def dim_customer(customers: DataFrame, load_ts: Column | None = None) -> DataFrame:
    full_name = F.concat_ws(" ", "first_name", "last_name").alias("full_name")
    return _dimension(
        customers,
        ["customer_id", "first_name", "last_name", full_name, "email", "phone", "country_code",
         "city", "segment", "signup_date", "is_active"],
        load_ts,
    )


def dim_product(products: DataFrame, load_ts: Column | None = None) -> DataFrame:
    return _dimension(
        products,
        ["product_id", "sku", "product_name", "category", "unit_price", "unit_cost", "currency", "is_active"],
        load_ts,
    )


def dim_country(countries: DataFrame, load_ts: Column | None = None) -> DataFrame:
    return _dimension(countries, ["country_code", "iso3", "country_name", "region", "currency_code"], load_ts)


def fact_sales(
    orders: DataFrame,
    items: DataFrame,
    rates: DataFrame | None = None,
    missing_rate: str = "one",
    load_ts: Column | None = None,
) -> DataFrame:
    """One row per order line, in local currency and USD.

    Lines whose order is absent are dropped. The rate is the one of the order's day and currency;
    USD is 1. ``missing_rate`` says what a missing rate means: ``"one"`` or ``"null"``.
    """
    if missing_rate not in ("one", "null"):
        raise ValueError(f"missing_rate must be 'one' or 'null', not {missing_rate!r}")
    header = orders.select(
        "order_id",
        "customer_id",
        date_key(F.col("order_date")).alias("order_date_key"),
        F.col("order_date").cast("date").alias("rate_date"),
        F.col("status").alias("order_status"),
        "currency",
        "shipping_country",
    )
    lines = items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct")
    # Orders and their lines grow together, so neither is ever a side to broadcast: compressed file
    # sizes would suggest it for tables that are small on disk only. Skewed orders are split by AQE.
    sold = lines.join(header.hint("merge"), "order_id")

    one = F.lit("1").cast(RATE)
    if rates is None:
        rate = one
    else:
        quoted = rates.select("rate_date", F.col("quote_currency").alias("currency"), "rate_to_usd")
        sold = sold.join(quoted, ["rate_date", "currency"], "left")
        found = F.col("rate_to_usd")
        if missing_rate == "one":
            found = F.coalesce(found, one.cast(rates.schema["rate_to_usd"].dataType))
        rate = F.when(F.col("currency") == BASE_CURRENCY, one).otherwise(found)

    # Each amount is a column of its own before it is used: mentioned several times, it would be worked out each time.
    priced = sold.withColumns({"_rate": rate, "_local": line_amount(F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))})
    local = F.col("_local")
    return priced.withColumn("_usd", narrow_product(local, F.col("_rate"))).select(
        F.concat_ws("_", "order_id", "order_item_id").alias("sales_fact_key"),
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "order_date_key",
        "shipping_country",
        "order_status",
        "currency",
        "quantity",
        F.col("unit_price").alias("unit_price_local"),
        discount_or_zero(F.col("discount_pct")).alias("discount_pct"),
        to_money(local).alias("line_total_local"),
        F.col("_rate").cast(RATE).alias("exchange_rate_to_usd"),
        converted(local, F.col("_rate"), F.col("_usd")).alias("line_total_usd"),
        (F.current_timestamp() if load_ts is None else load_ts).alias("updated_at"),
    )


def unfit_amounts(fact: DataFrame) -> DataFrame:
    """Lines whose amount is too large for its column, per currency; sums leave these out.

    Quantity, price and, for the USD amount, the rate are known, yet there is no amount.
    """
    priced = F.col("quantity").isNotNull() & F.col("unit_price_local").isNotNull()
    no_local = priced & F.col("line_total_local").isNull()
    no_usd = priced & F.col("exchange_rate_to_usd").isNotNull() & F.col("line_total_usd").isNull()
    return (
        fact.groupBy("currency")
        .agg(F.count_if(no_local).alias("local_amounts"), F.count_if(no_usd).alias("usd_amounts"))
        .filter("local_amounts > 0 or usd_amounts > 0")
    )


def sales_by_customer_attributes(
    fact: DataFrame, customer: DataFrame, attributes: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """USD and lines by ``by`` and attributes of the customer.

    Lines are summed per customer before they meet the dimension, so the second shuffle carries sums and a
    customer with a third of all lines is one row per slice.
    """
    summed = fact.groupBy(*by, "customer_id").agg(F.sum("line_total_usd").alias("usd"), F.count(F.lit(1)).alias("lines"))
    return (
        summed.join(customer.select("customer_id", *attributes), "customer_id", "left")
        .groupBy(*by, *attributes)
        .agg(F.sum("usd").cast("decimal(18,2)").alias("usd"), F.sum("lines").alias("lines"))
    )


def lines_without_rate(orders: DataFrame, items: DataFrame, rates: DataFrame) -> DataFrame:
    """How many lines fall back to rate 1, per currency."""
    fact = fact_sales(orders, items, rates, missing_rate="null")
    return (
        fact.filter(F.col("exchange_rate_to_usd").isNull())
        .groupBy("currency")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def kpi_monthly_sales(fact: DataFrame, product: DataFrame | None = None, load_ts: Column | None = None) -> DataFrame:
    """Orders, customers, items and revenue by year, month, country and category.

    An order belongs to one customer, as in :func:`fact_sales`.
    """
    sales = fact.withColumns(
        {"year": key_year(F.col("order_date_key")), "month": key_month(F.col("order_date_key"))}
    )
    if product is None:
        sales = sales.withColumn("category", F.lit("unknown"))
    else:
        sales = sales.join(product.select("product_id", "category"), "product_id", "left")
    # Two distinct counts in one aggregation would send every line three times. Lines are summed per
    # order first, orders are counted per customer, customers per key: each step is combined before its shuffle.
    keys = ["year", "month", "shipping_country", "category"]
    per_order = sales.groupBy(*keys, "customer_id", "order_id").agg(F.sum("quantity").alias("items"), F.sum("line_total_usd").alias("usd"))
    per_pair = per_order.groupBy(*keys, "customer_id").agg(
        F.count("order_id").alias("orders"), F.sum("items").alias("items"), F.sum("usd").alias("usd")
    )
    kpi = per_pair.groupBy(*keys).agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("items").alias("total_items_sold"),
        F.sum("usd").cast("decimal(16,2)").alias("total_revenue_usd"),
    )
    return kpi.withColumn("updated_at", F.current_timestamp() if load_ts is None else load_ts)


def star_join(
    fact: DataFrame,
    customer: DataFrame | None = None,
    product: DataFrame | None = None,
    country: DataFrame | None = None,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """The fact with the attributes of each given dimension beside it (many to one, left)."""
    wide = fact
    for dim, fact_key, dim_key, prefix in (
        (calendar, "order_date_key", "date_key", "date_"),
        (country, "shipping_country", "country_code", "country_"),
        (product, "product_id", "product_id", "product_"),
        (customer, "customer_id", "customer_id", "customer_"),
    ):
        if dim is not None:
            named = dim.select(
                F.col(dim_key).alias("_key"),
                *[F.col(c).alias(f"{prefix}{c}") for c in dim.columns if c not in (dim_key, "updated_at")],
            )
            wide = wide.join(named, wide[fact_key] == named["_key"], "left").drop("_key")
    return wide
