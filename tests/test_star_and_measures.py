from datetime import date, datetime
from decimal import Decimal as D

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalake.functions import money
from stratalake.operators import measures, star


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [(1000, 7, datetime(2025, 1, 15, 9), "paid", "EUR", "DE"), (1001, 8, datetime(2025, 2, 1), "paid", "USD", "US"),
         (1002, 7, datetime(2024, 2, 1), "paid", "JPY", "JP")],
        "order_id bigint, customer_id bigint, order_date timestamp, status string, currency string, shipping_country string")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(50, 1000, 1, 2, D("100.00"), D("10.00")), (51, 1001, 2, 1, D("10.00"), None), (52, 1002, 1, 1, D("500.00"), D("0")),
         (53, 9999, 1, 1, D("1.00"), D("0"))],
        "order_item_id bigint, order_id bigint, product_id bigint, quantity int, unit_price decimal(12,2), discount_pct decimal(5,2)")


@pytest.fixture(scope="module")
def rates(spark):
    return spark.createDataFrame([(date(2025, 1, 15), "EUR", D("1.10")), (date(2025, 2, 1), "USD", D("3"))],
                                 "rate_date date, quote_currency string, rate_to_usd decimal(12,6)")


def test_fact(orders, items, rates):
    fact = star.fact_sales(orders, items, rates)
    assert rows_of(fact, "sales_fact_key", "order_date_key", "line_total_local", "exchange_rate_to_usd", "line_total_usd") == [
        ("1000_50", 20250115, D("180.00"), D("1.100000"), D("198.00")),
        ("1001_51", 20250201, D("10.00"), D("1.000000"), D("10.00")),
        ("1002_52", 20240201, D("500.00"), D("1.000000"), D("500.00")),
    ]


def test_missing_rates(spark, orders, items, rates):
    assert {r.exchange_rate_to_usd for r in star.fact_sales(orders, items).collect()} == {D("1.000000")}
    nulls = star.fact_sales(orders, items, rates, missing_rate="null").filter("line_total_usd is null")
    assert rows_of(nulls, "currency") == [("JPY",)]
    assert rows_of(star.lines_without_rate(orders, items, rates), "*") == [("JPY", 1)]
    with pytest.raises(ValueError):
        star.fact_sales(orders, items, rates, missing_rate="two")


def test_kpi(spark, orders, items, rates):
    fact = star.fact_sales(orders, items, rates)
    products = spark.createDataFrame([(1, "Toys")], "product_id bigint, category string")
    kpi = star.kpi_monthly_sales(fact, products)
    assert (2025, 1, "DE", "Toys", 1, 1, 2, D("198.00")) in [tuple(r)[:8] for r in kpi.collect()]
    assert {r.category for r in star.kpi_monthly_sales(fact).collect()} == {"unknown"}


def test_dim_date(spark):
    days = star.dim_date(spark, "2025-01-01", "2025-01-05")
    assert days.count() == 5
    first = days.orderBy("date_key").first()
    assert (first.date_key, first.month_name, first.day_name, first.day_of_week, first.is_weekend) == (20250101, "January", "Wednesday", 4, False)
    assert star.dim_date(spark).count() == 4018
    assert rows_of(days.filter("is_weekend"), "date_key") == [(20250104,), (20250105,)]


def test_dimensions_are_distinct_with_one_load_time(spark):
    rows = [("US", "USA", "United States", "North America", "USD")] * 2
    dim = star.dim_country(spark.createDataFrame(rows, "country_code string, iso3 string, country_name string, region string, currency_code string"))
    assert dim.count() == 1 and "updated_at" in dim.columns
    people = spark.createDataFrame([(1, "Ann", None, "e", None, "US", None, "s", None, True)],
        "customer_id bigint, first_name string, last_name string, email string, phone string, country_code string, city string, segment string, signup_date date, is_active boolean")
    assert star.dim_customer(people).first().full_name == "Ann"


def test_time_intelligence(spark):
    monthly = spark.createDataFrame(
        [(2024, 1, D("10")), (2024, 3, D("5")), (2025, 1, D("15")), (2025, 2, D("1")), (2025, 3, D("0"))],
        "year int, month int, revenue_usd decimal(18,2)")
    ytd = {(r.year, r.month): r.ytd_revenue_usd for r in measures.ytd_revenue(monthly).collect()}
    assert ytd[(2024, 3)] == 15 and ytd[(2025, 3)] == 16
    prior = {(r.year, r.month): r.prior_year_revenue_usd for r in measures.prior_year_revenue(monthly).collect()}
    assert prior == {(2024, 1): None, (2024, 3): None, (2025, 1): 10, (2025, 2): None, (2025, 3): 5}
    growth = {(r.year, r.month): r.yoy_growth for r in measures.yoy_growth(monthly).collect()}
    assert growth[(2025, 1)] == D("0.5") and growth[(2025, 2)] == 0 and growth[(2025, 3)] == -1


def test_measures(spark, orders, items, rates):
    fact = star.fact_sales(orders, items, rates)
    total = measures.sales_measures(fact).first()
    assert (total.total_sales_usd, total.total_orders, total.total_items_sold) == (D("708.00"), 3, 4)
    assert total.average_order_value_usd == D("236.000000")
    assert measures.sales_measures(fact.limit(0)).first().average_order_value_usd == 0
    people = spark.createDataFrame([(7, True), (8, False)], "customer_id bigint, is_active boolean")
    active = measures.customer_measures(fact, people).first()
    assert (active.active_customers, active.average_revenue_per_customer_usd) == (1, D("708.000000"))


def test_star_join_keeps_every_line(spark, orders, items, rates):
    fact = star.fact_sales(orders, items, rates)
    countries = spark.createDataFrame([("DE", "Europe")], "country_code string, region string")
    wide = star.star_join(fact, country=countries, calendar=star.dim_date(spark, "2025-01-01", "2025-12-31"))
    assert wide.count() == 3
    assert rows_of(wide.filter("country_region is not null"), "order_id", "date_month") == [(1000, 1)]


def test_year_to_date_by_day(spark):
    sold = [(20230228, "5.00"), (20240227, "1.00"), (20240228, "2.00"), (20240229, "4.00"), (20240229, "0.50"), (20250301, "8.00"), (None, "9.00")]
    fact = spark.createDataFrame([("DE", k, D(v)) for k, v in sold] + [(None, 20240101, D("3.00"))], "country string, order_date_key int, line_total_usd decimal(18,2)")
    found = {(r.country, str(r.sales_date)): tuple(r)[2:] for r in measures.to_date_by_day(measures.daily_revenue(fact, ["country"]), ["country"]).collect()}
    assert found == {
        ("DE", "2023-02-28"): (D("5.00"), D("5.00"), None, None),
        ("DE", "2024-02-27"): (D("1.00"), D("1.00"), None, None),
        ("DE", "2024-02-28"): (D("2.00"), D("3.00"), D("5.00"), D("5.00")),
        ("DE", "2024-02-29"): (D("4.50"), D("7.50"), D("5.00"), D("5.00")),
        # 1 March 2024 had no sales; until then, the year had 7.50
        ("DE", "2025-03-01"): (D("8.00"), D("8.00"), None, D("7.50")),
        (None, "2024-01-01"): (D("3.00"), D("3.00"), None, None)}
    assert measures.to_date_by_day(measures.daily_revenue(fact.limit(0))).count() == 0


def test_amounts_are_worked_out_once(spark, orders, rates):
    """Each mention of the local amount was a product of its own: nine and more per line."""
    lines = spark.sql("""select 1L as order_item_id, cast(1000 as bigint) as order_id, 1L as product_id, q as quantity, p as unit_price, d as discount_pct
        from values (3, 19.99BD, 12.50BD), (2000000000, 9999999999.99BD, 0.01BD), (1, 0.01BD, null), (null, 1.00BD, 1.00BD) t(q, p, d)""")
    lines = lines.withColumns({"unit_price": F.col("unit_price").cast("decimal(12,2)"), "discount_pct": F.col("discount_pct").cast("decimal(5,2)")})
    fact = star.fact_sales(orders, lines, rates)
    assert fact._jdf.queryExecution().optimizedPlan().toString().count("* 0.01") <= 2  # compared with the bound, then narrowed
    amount = money.line_amount(F.col("quantity"), F.col("unit_price_local"), F.col("discount_pct"))
    again = fact.select("line_total_local", "line_total_usd", money.to_money(amount).alias("local"), money.converted(amount, F.col("exchange_rate_to_usd")).alias("usd")).collect()
    assert len(again) == 4 and all((r.line_total_local, r.line_total_usd) == (r.local, r.usd) for r in again)
