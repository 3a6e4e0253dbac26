"""Detectors for the defects operational data brings along. Each returns the offending rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.money import line_amount, to_money
from stratalake.functions.text import normal_code
from stratalake.operators.reconcile import orphans


def duplicate_excess(df: DataFrame, key: Column) -> DataFrame:
    """One row: rows beyond the first of every key."""
    sizes = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.filter("n > 1").agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"))


def email_case_duplicates(customers: DataFrame) -> DataFrame:
    """Addresses used by several customers once case is ignored."""
    return (
        customers.groupBy(F.lower("email").alias("email"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .filter("email is not null and customers > 1")
    )


def messy_codes(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) != F.upper(column))


def standard_codes(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, normal_code(F.col(column)))


def standard_categories(products: DataFrame, canonical: DataFrame) -> DataFrame:
    """Adds ``standard_category``: the listed spelling, or the given one if none matches.

    Of several listed spellings of one category the first in order counts, so a product stays one row.
    """
    listed = canonical.groupBy(F.lower("category").alias("_lower")).agg(F.min("category").alias("_listed"))
    return (
        products.join(listed, F.lower(products["category"]) == F.col("_lower"), "left")
        .withColumn("standard_category", F.coalesce("_listed", "category"))
        .drop("_lower", "_listed")
    )


def messy_categories(products: DataFrame, canonical: DataFrame) -> DataFrame:
    return standard_categories(products, canonical).filter("category <> standard_category")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows and NULLs."""
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return measured.unpivot("rows", list(columns), "column_name", "nulls").select("column_name", "rows", "nulls")


def negative_amounts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def future_dated(orders: DataFrame) -> DataFrame:
    return orders.filter("order_date > created_at")


def order_line_sums(items: DataFrame) -> DataFrame:
    """Sum of rounded line totals per order, added up before any join."""
    line = to_money(line_amount(F.col("quantity"), F.col("unit_price"), F.col("discount_pct")))
    return items.groupBy("order_id").agg(F.sum(line).cast("decimal(18,2)").alias("lines_total"))


def order_total_mismatches(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with a total of 0 or more that is not the sum of their lines (no lines: sum 0)."""
    stated = orders.filter("total_amount >= 0").select("order_id", "total_amount")
    summed = stated.join(order_line_sums(items), "order_id", "left").withColumn(
        "lines_total", F.coalesce("lines_total", F.lit("0").cast("decimal(18,2)"))
    )
    return summed.filter("total_amount <> lines_total")


def restated_rates(rates: DataFrame) -> DataFrame:
    return rates.filter("cast(updated_at as date) > rate_date")


def orphan_reviews(reviews: DataFrame, customers: DataFrame) -> DataFrame:
    return orphans(reviews, "customer_id", customers, "customer_id")


def invalid_ratings(reviews: DataFrame) -> DataFrame:
    return reviews.filter("rating not between 1 and 5")


def repeated_reviews(reviews: DataFrame) -> DataFrame:
    """Review ids that occur more than once, and how often."""
    return reviews.groupBy("review_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def payment_mismatches(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Completed, non-negative payments that differ from their order's total."""
    paid = payments.filter("payment_status = 'completed' and amount >= 0").select("payment_id", "order_id", "amount")
    return paid.join(orders.select("order_id", "total_amount"), "order_id").filter("amount <> total_amount")


def currency_mismatches(orders: DataFrame, customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Orders not priced in the currency of their customer's country."""
    home = customers.select("customer_id", F.upper("country_code").alias("country_code")).join(
        countries.select("country_code", "currency_code"), "country_code"
    )
    return (
        orders.select("order_id", "customer_id", "currency")
        .join(home, "customer_id")
        .filter("currency <> currency_code")
        .select("order_id", "customer_id", "currency", "currency_code")
    )


def orders_before_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    known = customers.select("customer_id", F.col("created_at").alias("customer_since"))
    return (
        orders.select("order_id", "customer_id", F.col("created_at").alias("ordered_at"))
        .join(known, "customer_id")
        .filter("ordered_at < customer_since")
    )


def missing_rate_days(rates: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Days of the calendar a currency has no rate for, between the given or the overall first and
    last rate day.

    Rates are read once and combined into a row per currency with its set of days; what follows
    works on those few rows, bounded by currencies and calendar days however many rates there are.
    """
    per_currency = rates.groupBy("quote_currency").agg(
        F.min("rate_date").alias("first"), F.max("rate_date").alias("last"), F.collect_set("rate_date").alias("days")
    )
    bounds = per_currency.agg(F.min("first").alias("lo"), F.max("last").alias("hi"))
    first = F.lit(start).cast("date") if start else bounds.select("lo").scalar()
    last = F.lit(end).cast("date") if end else bounds.select("hi").scalar()
    return per_currency.select("quote_currency", "days", first.alias("lo"), last.alias("hi")).select(
        "quote_currency",
        F.explode(F.array_except(F.sequence("lo", "hi", F.expr("interval 1 day")), "days")).alias("rate_date"),
    )


def bad_rates(rates: DataFrame, base: str = "USD") -> DataFrame:
    """Rates that are not positive, or a base-currency rate other than 1."""
    return rates.filter((F.col("rate") <= 0) | ((F.col("quote_currency") == base) & (F.col("rate") != 1)))


def defect_counts(df: DataFrame, dataset: str, defects: dict[str, str]) -> DataFrame:
    """Rows of a dataset and rows per defect (name -> SQL predicate), in one pass."""
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.expr(p)).alias(n) for n, p in defects.items()]
    )
    return measured.unpivot("rows", list(defects), "defect", "n").select(F.lit(dataset).alias("dataset"), "defect", "rows", "n")
