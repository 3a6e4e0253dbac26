"""Every registered query: its Spark form and, where SQL can say it, the DuckDB form."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries.commerce import Commerce, with_views
from stratalake.functions import casting, dates, lossless, money, text
from stratalake.operators import audit, dedup, detect, incremental, measures, quality, reconcile, rules, star
from stratalake.sources import pages

Query = Callable[[Commerce], DataFrame]
SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = with_views(views, sql)
        return fn

    return register


# ------------------------------------------------------------------ star schema


def _fact(c: Commerce) -> DataFrame:
    return star.fact_sales(c.orders(), c.items(), c.rates()).drop("updated_at")


@query("kpi_monthly_sales", """
    select order_date_key // 10000 as year, order_date_key % 10000 // 100 as month, shipping_country, category,
      count(distinct order_id) as total_orders, count(distinct customer_id) as unique_customers,
      cast(sum(quantity) as bigint) as total_items_sold, cast(sum(line_total_usd) as decimal(16,2)) as total_revenue_usd
    from fact left join products using (product_id) group by 1, 2, 3, 4""", "fact products")
def kpi_monthly_sales(c: Commerce) -> DataFrame:
    return star.kpi_monthly_sales(_fact(c), c.products()).drop("updated_at")


@query("kpi_without_categories", """
    select order_date_key // 10000 as year, order_date_key % 10000 // 100 as month, shipping_country,
      'unknown' as category, count(distinct order_id) as total_orders,
      count(distinct customer_id) as unique_customers, cast(sum(quantity) as bigint) as total_items_sold,
      cast(sum(line_total_usd) as decimal(16,2)) as total_revenue_usd from fact group by 1, 2, 3""", "fact")
def kpi_without_categories(c: Commerce) -> DataFrame:
    return star.kpi_monthly_sales(_fact(c)).drop("updated_at")


@query("fact_sales", "select * from fact", "fact")
def fact_sales(c: Commerce) -> DataFrame:
    return _fact(c)


#: Every seventh line of an order is of a size that its amount doesn't fit, in USD or at all.
_HUGE = "case when order_item_id % 10 = 7 then quantity * 10000000 when order_item_id % 10 = 6 then quantity * 500000 else quantity end"


@query("unfit_amounts", f"""
    , huge as (select * replace ({_HUGE} as quantity) from items),
    lines as (select currency, cast(quantity as hugeint) * cast(unit_price * 100 as bigint) * cast(100 - discount_pct as int) as local,
        case when currency = 'USD' then 1000000 else cast(coalesce(rate_to_usd, 1) * 1000000 as bigint) end as rate
      from (select i.*, o.currency, o.order_date from huge i join shop_orders o using (order_id))
      left join rates on rate_date = cast(order_date as date) and quote_currency = currency)
    select currency, count(*) filter (local >= 9999999999999950) as local_amounts, count(*) filter (local * rate >= 9999999999999950000000) as usd_amounts
    from lines group by 1 having count(*) filter (local >= 9999999999999950 or local * rate >= 9999999999999950000000) > 0""", "shop_orders items rates")
def unfit_amounts(c: Commerce) -> DataFrame:
    """Lines of a fact with some huge quantities whose amounts don't fit their columns, per currency."""
    items = c.items().withColumn("quantity", F.expr(f"cast({_HUGE} as int)"))
    return star.unfit_amounts(star.fact_sales(c.orders(), items, c.rates()))


@query("fact_sales_no_rates", """
    select order_id || '_' || order_item_id as sales_fact_key, cast(1 as decimal(12,6)) as exchange_rate_to_usd,
      cast(base as decimal(14,2)) as line_total_local, cast(base as decimal(14,2)) as line_total_usd
    from (select *, cast(quantity * unit_price as decimal(16,2)) * (100 - discount_pct) * cast(0.01 as decimal(3,2)) as base
          from items) join shop_orders using (order_id)""", "items shop_orders")
def fact_sales_no_rates(c: Commerce) -> DataFrame:
    fact = star.fact_sales(c.orders(), c.items())
    return fact.select("sales_fact_key", "exchange_rate_to_usd", "line_total_local", "line_total_usd")


@query("lines_without_rate", """
    select currency, count(*) as lines from items join shop_orders using (order_id)
    left join rates on rate_date = cast(order_date as date) and quote_currency = currency
    where currency <> 'USD' and rate_to_usd is null group by currency""", "items shop_orders rates")
def lines_without_rate(c: Commerce) -> DataFrame:
    return star.lines_without_rate(c.orders(), c.items(), c.rates())


@query("dim_date", """
    select cast(strftime(d, '%Y%m%d') as int) as date_key, cast(d as date) as full_date, cast(year(d) as int) as year,
      cast(quarter(d) as int) as quarter, cast(month(d) as int) as month, monthname(d) as month_name,
      cast(day(d) as int) as day, cast(dayofweek(d) + 1 as int) as day_of_week, dayname(d) as day_name,
      dayofweek(d) in (0, 6) as is_weekend
    from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders)""")
def dim_date(c: Commerce) -> DataFrame:
    return star.dim_date_covering(c.raw("orders"), "o_orderdate")


@query("dim_customer", """
    select distinct customer_id, first_name, last_name, concat_ws(' ', first_name, last_name) as full_name, email,
      phone, country_code, city, segment, signup_date, is_active from customers""", "customers")
def dim_customer(c: Commerce) -> DataFrame:
    return star.dim_customer(c.customers()).drop("updated_at")


@query("dim_product", """
    select distinct product_id, sku, product_name, category, unit_price, unit_cost, currency, is_active
    from products""", "products")
def dim_product(c: Commerce) -> DataFrame:
    return star.dim_product(c.products()).drop("updated_at")


@query("dim_country", """
    select country_code, iso3, country_name, region, currency_code, lower(region) = 'asia' as in_asia, customers
    from (select distinct country_code, iso3, country_name, region, currency_code from countries)
    left join (select country_code, count(*) as customers from customers group by 1) using (country_code)""",
    "countries customers")
def dim_country(c: Commerce) -> DataFrame:
    population = c.customers().groupBy("country_code").agg(F.count(F.lit(1)).alias("customers"))
    dim = star.dim_country(c.countries()).drop("updated_at")
    return dim.join(population, "country_code", "left").withColumn("in_asia", F.lower("region") == "asia")


@query("star_join_region_sales", """
    select region, is_weekend, segment, cast(sum(line_total_usd) as decimal(18,2)) as usd, count(*) as lines
    from (select *, dayofweek(strptime(cast(order_date_key as varchar), '%Y%m%d')) in (0, 6) as is_weekend from fact) f
    join countries on shipping_country = country_code
    join (select customer_id, segment from customers) using (customer_id)
    join (select product_id from products where is_active) using (product_id) group by 1, 2, 3""",
    "fact countries products")
def star_join_region_sales(c: Commerce) -> DataFrame:
    wide = star.star_join(
        _fact(c), None, star.dim_product(c.products()), star.dim_country(c.countries()), star.dim_date_covering(c.raw("orders"), "o_orderdate"))
    active = wide.filter("product_is_active").withColumnsRenamed({"country_region": "region", "date_is_weekend": "is_weekend"})
    return star.sales_by_customer_attributes(active, star.dim_customer(c.customers()), ["segment"], ["region", "is_weekend"])


@query("large_local_amounts", """
    select currency, line_total_usd > 0 as earned, count(*) as lines, cast(sum(line_total_usd) as decimal(18,2)) as usd,
      count(*) filter (where line_total_local is null) as without_local
    from (select currency, cast(cast(base as decimal(30,6)) * cast(0.000062 as decimal(7,6)) as decimal(14,2)) as line_total_usd,
        try_cast(base as decimal(14,2)) as line_total_local
      from (select currency, cast(quantity * 1000 * (unit_price * 10000) as decimal(26,2)) * (100 - discount_pct) * cast(0.01 as decimal(3,2)) as base
        from items join shop_orders using (order_id) where currency <> 'USD'))
    group by 1, 2""", "items shop_orders")
def large_local_amounts(c: Commerce) -> DataFrame:
    """Lines of billions in currencies of little worth: no USD amount is lost for what its local amount was."""
    rates = c.orders().selectExpr("cast(order_date as date) as rate_date", "currency as quote_currency").distinct().withColumn(
        "rate_to_usd", F.lit("0.000062").cast("decimal(12,6)"))
    items = c.items().withColumns({"quantity": F.col("quantity") * 1000, "unit_price": (F.col("unit_price") * 10000).cast("decimal(12,2)")})
    fact = star.fact_sales(c.orders(), items, rates).filter("currency <> 'USD'")
    return fact.groupBy("currency", (F.col("line_total_usd") > 0).alias("earned")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("line_total_usd").cast("decimal(18,2)").alias("usd"), F.count_if(F.col("line_total_local").isNull()).alias("without_local"))


# -------------------------------------------------------------------- measures

_MEASURES = """cast(sum(line_total_usd) as decimal(18,2)) as total_sales_usd,
      cast(sum(line_total_local) as decimal(18,2)) as total_sales_local,
      count(distinct order_id) as total_orders, cast(sum(quantity) as bigint) as total_items_sold"""


@query("measures_total", f"select {_MEASURES} from fact", "fact")
def measures_total(c: Commerce) -> DataFrame:
    return measures.sales_measures(_fact(c)).drop("average_order_value_usd")


@query("measures_by_country", f"""
    select shipping_country, {_MEASURES} from fact group by 1""", "fact")
def measures_by_country(c: Commerce) -> DataFrame:
    return measures.sales_measures(_fact(c), ["shipping_country"]).drop("average_order_value_usd")


@query("measures_by_month", f"""
    select order_date_key // 100 as year_month, {_MEASURES} from fact group by 1""", "fact")
def measures_by_month(c: Commerce) -> DataFrame:
    dated = _fact(c).withColumn("year_month", F.floor(F.col("order_date_key") / 100).cast("int"))
    return measures.sales_measures(dated, ["year_month"]).drop("average_order_value_usd")


@query("average_order_value", """
    select shipping_country, cast(coalesce(round(cast(sum(line_total_usd) as double) / count(distinct order_id), 3), 0) as double) as aov
    from fact group by 1""", "fact")
def average_order_value(c: Commerce) -> DataFrame:
    by_country = measures.sales_measures(_fact(c), ["shipping_country"])
    return by_country.select("shipping_country", F.round(F.col("average_order_value_usd").cast("double"), 3).alias("aov"))


@query("active_customers", """
    select order_status, cast(sum(line_total_usd) as decimal(18,2)) as total_sales_usd,
      count(distinct customer_id) filter (where is_active) as active_customers,
      round(cast(sum(line_total_usd) as double) / count(distinct customer_id) filter (where is_active), 2) as per_customer
    from fact left join (select customer_id, is_active from customers) using (customer_id) group by 1""", "fact")
def active_customers(c: Commerce) -> DataFrame:
    measured = measures.customer_measures(_fact(c), c.customers(), ["order_status"])
    per = F.round(F.col("average_revenue_per_customer_usd").cast("double"), 2).alias("per_customer")
    return measured.select("order_status", "total_sales_usd", "active_customers", per)


@query("ytd_revenue", """
    select year, month, revenue_usd,
      cast(sum(revenue_usd) over (partition by year order by month) as decimal(18,2)) as ytd_revenue_usd
    from monthly""", "monthly")
def ytd_revenue(c: Commerce) -> DataFrame:
    return measures.ytd_revenue(measures.monthly_revenue(_fact(c)))


@query("prior_year_revenue", """
    select n.year, n.month, n.revenue_usd, p.revenue_usd as prior_year_revenue_usd
    from monthly n left join monthly p on p.year = n.year - 1 and p.month = n.month""", "monthly")
def prior_year_revenue(c: Commerce) -> DataFrame:
    return measures.prior_year_revenue(measures.monthly_revenue(_fact(c))).select(
        "year", "month", "revenue_usd", "prior_year_revenue_usd")


@query("yoy_growth", """
    select n.year, n.month,
      cast(coalesce(cast(n.revenue_usd - p.revenue_usd as double) / nullif(cast(p.revenue_usd as double), 0), 0) as decimal(18,4)) as growth
    from monthly n left join monthly p on p.year = n.year - 1 and p.month = n.month""", "monthly")
def yoy_growth(c: Commerce) -> DataFrame:
    grown = measures.yoy_growth(measures.monthly_revenue(_fact(c)))
    return grown.select("year", "month", F.col("yoy_growth").cast("decimal(18,4)").alias("growth"))


@query("ytd_by_day_country", """
    , daily as (select shipping_country, strptime(cast(order_date_key as varchar), '%Y%m%d')::date as sales_date,
        cast(sum(line_total_usd) as decimal(18,2)) as revenue_usd from fact group by 1, 2)
    select n.shipping_country, n.sales_date, n.revenue_usd,
      cast((select sum(t.revenue_usd) from daily t where t.shipping_country is not distinct from n.shipping_country
        and year(t.sales_date) = year(n.sales_date) and t.sales_date <= n.sales_date) as decimal(18,2)) as ytd_revenue_usd,
      max(p.revenue_usd) filter (p.sales_date = cast(n.sales_date - interval 1 year as date)) as prior_year_revenue_usd,
      cast(sum(p.revenue_usd) as decimal(18,2)) as prior_ytd_revenue_usd
    from daily n left join daily p on p.shipping_country is not distinct from n.shipping_country
      and year(p.sales_date) = year(n.sales_date) - 1 and p.sales_date <= cast(n.sales_date - interval 1 year as date)
    group by 1, 2, 3""", "fact")
def ytd_by_day_country(c: Commerce) -> DataFrame:
    slices = ["shipping_country"]
    return measures.to_date_by_day(measures.daily_revenue(_fact(c), slices), slices)


# ------------------------------------------------------- typed layer operators

_LINE_ORDER = "l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc"


@query("latest_per_key", f"""
    select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by {_LINE_ORDER}) = 1""")
def latest_per_key(c: Commerce) -> DataFrame:
    ties = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return dedup.latest_per_key(c.raw("lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate", ties)


_UPSERT = """
    select coalesce(t.order_id, s.order_id) as order_id,
      case when t.order_id is null or coalesce(s.updated_at >= t.updated_at, false) then s.status else t.status end as status,
      case when t.order_id is null or coalesce(s.updated_at >= t.updated_at, false) then s.total_amount else t.total_amount end as total_amount,
      case when t.order_id is null or coalesce(s.updated_at >= t.updated_at, false) then s.updated_at else t.updated_at end as updated_at
    from (select o_orderkey as order_id, o_orderstatus as status, cast(o_totalprice as decimal(14,2)) as total_amount,
            case when o_orderpriority <> '4-NOT SPECIFIED' then o_orderdate end as updated_at
          from orders where o_orderstatus <> 'P') t
    full join (select l_orderkey as order_id, l_linestatus as status, cast(l_extendedprice as decimal(14,2)) as total_amount,
            l_shipdate as updated_at from lineitem
          qualify row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_partkey desc,
            l_suppkey desc, l_quantity desc, l_extendedprice desc) = 1) s on t.order_id = s.order_id"""


def _upsert_sides(c: Commerce) -> tuple[DataFrame, DataFrame]:
    target = c.raw("orders").filter("o_orderstatus <> 'P'").selectExpr(
        "o_orderkey as order_id", "o_orderstatus as status", "cast(o_totalprice as decimal(14,2)) as total_amount",
        "case when o_orderpriority <> '4-NOT SPECIFIED' then o_orderdate end as updated_at")
    ties = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    newest = dedup.latest_per_key(c.raw("lineitem"), ["l_orderkey"], "l_shipdate", ties)
    source = newest.selectExpr("l_orderkey as order_id", "l_linestatus as status",
                               "cast(l_extendedprice as decimal(14,2)) as total_amount", "l_shipdate as updated_at")
    return target, source


@query("upsert_orders", _UPSERT)
def upsert_orders(c: Commerce) -> DataFrame:
    target, source = _upsert_sides(c)
    return dedup.upsert(target, source, ["order_id"], "updated_at")


@query("upsert_replay", _UPSERT)
def upsert_replay(c: Commerce) -> DataFrame:
    """The same batch twice changes nothing."""
    target, source = _upsert_sides(c)
    return dedup.upsert(dedup.upsert(target, source, ["order_id"], "updated_at"), source, ["order_id"], "updated_at")


ORDER_TEXT = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("priority", T.IntegerType()),
    T.StructField("total_amount", T.DecimalType(14, 2)), T.StructField("order_date", T.TimestampType()),
    T.StructField("order_day", T.DateType()), T.StructField("is_open", T.BooleanType()),
    T.StructField("absent", T.StringType()),
])


def _order_text(c: Commerce) -> DataFrame:
    return c.raw("orders").selectExpr(
        "cast(o_orderkey as string) as order_id", "substr(o_orderpriority, 1, 2) as priority",
        "cast(cast(o_totalprice as decimal(14,2)) as string) as total_amount",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') as order_date",
        "case when o_orderstatus = 'P' then o_orderpriority else date_format(o_orderdate, 'yyyy-MM-dd') end as order_day",
        "case o_orderstatus when 'O' then 'true' when 'F' then 'false' else o_orderpriority end as is_open",
        "o_orderpriority as note")


_ORDER_TEXT = """select cast(o_orderkey as varchar) as order_id, substr(o_orderpriority, 1, 2) as priority,
      cast(cast(o_totalprice as decimal(14,2)) as varchar) as total_amount,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as order_date,
      case when o_orderstatus = 'P' then o_orderpriority else strftime(o_orderdate, '%Y-%m-%d') end as order_day,
      case o_orderstatus when 'O' then 'true' when 'F' then 'false' else o_orderpriority end as is_open,
      o_orderpriority as note from orders"""


@query("typed_projection", f"""
    select try_cast(order_id as bigint) as order_id, case when priority ~ '^[0-9]+$' then try_cast(priority as int) end as priority,
      try_cast(total_amount as decimal(14,2)) as total_amount, try_cast(order_date as timestamp) as order_date,
      try_cast(order_day as date) as order_day, try_cast(is_open as boolean) as is_open, note
    from ({_ORDER_TEXT})""")
def typed_projection(c: Commerce) -> DataFrame:
    return casting.typed(_order_text(c), ORDER_TEXT)


@query("cast_failures", f"""
    select reason, count(*) as n from (
      select case when order_day is not null and try_cast(order_day as date) is null then 'Cannot read order_day as date' end as reason from ({_ORDER_TEXT})
      union all select case when try_cast(is_open as boolean) is null then 'Cannot read is_open as boolean' end from ({_ORDER_TEXT})
      union all select 'Cannot read priority as int' from ({_ORDER_TEXT}))
    where reason is not null group by reason""")
def cast_failures(c: Commerce) -> DataFrame:
    raw = _order_text(c)
    return raw.select(F.explode(casting.cast_failures(raw, ORDER_TEXT)).alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


def _refused(df: DataFrame, dataset: str, keys: list[str], **options) -> DataFrame:
    _, bad = rules.split(df, rules.rules_for(dataset, keys, with_source_rules=True), **options)
    return bad.select(*keys, "quarantine_reason")


@query("validate_orders", """
    select order_id, quarantine_reason from (select order_id, concat_ws('; ',
        case when total_amount < 0 then 'Negative total_amount' end,
        case when status not in ('pending', 'paid', 'shipped', 'delivered', 'cancelled', 'returned') then 'Invalid order status' end) as quarantine_reason
      from (select order_id, status, cast(total_amount - 10000 as decimal(14,2)) as total_amount from order_headers))
    where quarantine_reason <> ''""", "order_headers")
def validate_orders(c: Commerce) -> DataFrame:
    """Totals less a handling charge of 10000, which leaves some negative."""
    net = c.order_headers().withColumn("total_amount", (F.col("total_amount") - 10000).cast("decimal(14,2)"))
    return _refused(net, "orders", ["order_id"])


@query("validate_order_items", """
    select order_item_id, quarantine_reason from (select l_orderkey * 10 + l_linenumber as order_item_id, concat_ws('; ',
        case when l_returnflag = 'R' then 'Non-positive quantity' end,
        case when l_linestatus = 'F' and l_extendedprice > 0 and l_tax > 0.05 then 'Negative unit_price' end,
        case when cast(round(l_discount * 100) as int) * 12 > 100 then 'Discount pct out of 0-100 range' end) as quarantine_reason
      from lineitem) where quarantine_reason <> ''""")
def validate_order_items(c: Commerce) -> DataFrame:
    """Returned lines count negative, some prices are credits, discounts are yearly."""
    lines = c.raw("lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber as order_item_id",
        "cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end as int) as quantity",
        "cast(case when l_linestatus = 'F' and l_tax > 0.05 then -l_extendedprice else l_extendedprice end as decimal(12,2)) as unit_price",
        "cast(cast(round(l_discount * 100) as int) * 12 as decimal(5,2)) as discount_pct")
    return _refused(lines, "order_items", ["order_item_id"])


@query("validate_customers", r"""
    select customer_id, quarantine_reason from (select customer_id, concat_ws('; ',
        case when not regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$') then 'Invalid email format' end,
        case when timestamp '1996-06-01' < created_at then 'updated_at prior to created_at' end,
        case when segment not in ('consumer', 'small_business', 'enterprise') then 'Invalid segment' end) as quarantine_reason
      from (select customer_id, created_at, case segment when 'building' then 'consumer' when 'machinery' then 'enterprise' else segment end as segment,
              case when is_active then email else first_name || '#' || last_name end as email from customers))
    where quarantine_reason <> ''""", "customers")
def validate_customers(c: Commerce) -> DataFrame:
    changed = c.customers().selectExpr(
        "customer_id", "created_at", "timestamp'1996-06-01' as updated_at",
        "case segment when 'building' then 'consumer' when 'machinery' then 'enterprise' else segment end as segment",
        "case when is_active then email else concat(first_name, '#', last_name) end as email")
    return _refused(changed, "customers", ["customer_id"])


@query("validate_products", """
    select product_id, quarantine_reason from (select product_id, concat_ws('; ',
        case when unit_price - 950 < 0 then 'Negative unit_price' end,
        case when unit_cost - 950 < 0 then 'Negative unit_cost' end) as quarantine_reason from products)
    where quarantine_reason <> ''""", "products")
def validate_products(c: Commerce) -> DataFrame:
    rebated = c.products().withColumns({p: F.col(p) - 950 for p in ("unit_price", "unit_cost")})
    return _refused(rebated, "products", ["product_id"])


_PAYMENT_REASONS = """concat_ws('; ',
        case when amount < 0 then 'Negative payment amount' end,
        case when payment_status not in ('pending', 'completed', 'failed', 'refunded') then 'Invalid payment status' end,
        case when payment_status = 'completed' and paid_at is null then 'Completed payment without paid_at' end,
        case when payment_method not in ('card', 'paypal', 'bank_transfer', 'apple_pay', 'gift_card') then 'Invalid payment method' end)"""


@query("validate_payments", f"""
    select payment_id, quarantine_reason from (select payment_id, {_PAYMENT_REASONS} as quarantine_reason from payments)
    where quarantine_reason <> ''""", "payments")
def validate_payments(c: Commerce) -> DataFrame:
    return _refused(c.payments(), "payments", ["payment_id"])


@query("validate_reviews", """
    select event_id, 'Rating outside 1-5 range' as quarantine_reason from reviews where rating not between 1 and 5""", "reviews")
def validate_reviews(c: Commerce) -> DataFrame:
    return _refused(c.reviews(), "reviews", ["event_id"])


@query("quarantine_reasons", f"""
    select quarantine_reason, count(*) as n from (select {_PAYMENT_REASONS} as quarantine_reason from payments)
    where quarantine_reason <> '' group by 1""", "payments")
def quarantine_reasons(c: Commerce) -> DataFrame:
    return _refused(c.payments(), "payments", ["payment_id"]).groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("n"))


@query("valid_payments", f"""
    select payment_id, amount, payment_status from payments where {_PAYMENT_REASONS} = ''""", "payments")
def valid_payments(c: Commerce) -> DataFrame:
    good, _ = rules.split(c.payments(), rules.rules_for("payments", ["payment_id"], with_source_rules=True))
    return good.select("payment_id", "amount", "payment_status")


@query("strict_null_validation", f"""
    select order_id, concat_ws('; ', case when order_id is null then 'Primary key order_id is null' end,
      case when status is null or status not in ('pending', 'paid', 'shipped', 'delivered', 'cancelled', 'returned') then 'Invalid order status' end) as quarantine_reason
    from (select order_id, case when status not like '%not specified%' and dayofweek(order_date) <> 0 then status end as status from order_headers)
    where status is null""", "order_headers")
def strict_null_validation(c: Commerce) -> DataFrame:
    """A status left empty passes by default and is refused when NULL counts as a failure."""
    some_null = c.order_headers().withColumn(
        "status", F.expr("case when status not like '%not specified%' and dayofweek(order_date) <> 1 then status end"))
    return _refused(some_null, "orders", ["order_id"], on_null="fail")


# ------------------------------------------------------------------- increments


@query("incremental_window", """
    select event_id, ts from events where ts > timestamp '2024-01-05 12:00:00' and ts <= timestamp '2024-01-20 23:59:30'""")
def incremental_window(c: Commerce) -> DataFrame:
    upper = incremental.window_upper(datetime(2024, 1, 21), lag_seconds=30)
    return incremental.incremental_window(c.raw("events"), "ts", "2024-01-05T12:00:00+00:00", upper).select("event_id", "ts")


@query("first_window", "select event_id, ts from events where ts <= timestamp '2024-01-20'")
def first_window(c: Commerce) -> DataFrame:
    return incremental.incremental_window(c.raw("events"), "ts", None, "2024-01-20").select("event_id", "ts")


@query("updated_since", "select event_id, ts from events where ts >= timestamp '2024-01-15 06:00:00'")
def updated_since(c: Commerce) -> DataFrame:
    return incremental.updated_since(c.raw("events"), "2024-01-15T07:00:00+01:00", "ts").select("event_id", "ts")


@query("currency_filter", "select order_id, total_amount from shop_orders where currency = 'NATION_7'", "shop_orders")
def currency_filter(c: Commerce) -> DataFrame:
    return incremental.of_currency(c.orders(), "nation_7", "currency").select("order_id", "total_amount")


@query("page_slice", """
    select event_id, ts, (select count(*) from events) as total, (select count(*) from events) > 1500 as has_more
    from events order by ts, event_id limit 500 offset 1000""")
def page_slice(c: Commerce) -> DataFrame:
    return pages.page_slice(c.raw("events").select("event_id", "ts"), 3, 500, ["ts", "event_id"])


@query("next_watermark", """
    select event_type, greatest(max(ts), null) as watermark from events group by 1""")
def next_watermark(c: Commerce) -> DataFrame:
    return incremental.next_watermark(c.raw("events"), "ts", by=("event_type",))


@query("watermark_without_rows", """
    select coalesce(max(ts), timestamp '2024-06-01') as watermark from events where ts > timestamp '2030-01-01'""")
def watermark_without_rows(c: Commerce) -> DataFrame:
    late = incremental.incremental_window(c.raw("events"), "ts", since="2030-01-01")
    return incremental.next_watermark(late, "ts", "2024-06-01")


@query("pending_batches", """
    select distinct batch_id from landed where batch_id not in (select batch_id from bronze)""", "bronze")
def pending_batches(c: Commerce) -> DataFrame:
    return incremental.pending_batches(c.landed(), c.bronze())


@query("loaded_batches", """
    select batch_id from landed where dow = 2 union select batch_id from landed where value > 450""", "landed")
def loaded_batches(c: Commerce) -> DataFrame:
    return incremental.batch_ids(c.landed().filter("dow = 2"), c.landed().filter("value > 450"))


@query("batch_reconciliation", """
    select coalesce(m.batch_id, b.batch_id) as batch_id, record_count, n as "rows",
      case when record_count is null then 'unexpected' when n is null then 'missing' when n <> record_count then 'mismatch' else 'ok' end as verdict
    from manifests m full join (select batch_id, count(*) as n from bronze group by 1) b on m.batch_id = b.batch_id""",
    "manifests bronze")
def batch_reconciliation(c: Commerce) -> DataFrame:
    return reconcile.batch_reconciliation(c.bronze(), c.manifests())


@query("lineage_nulls", """
    select count(*) filter (where finished_at is null) as finished_at, count(*) filter (where error_type is null) as error_type,
      count(*) filter (where batch_id is null) as batch_id from runs""", "runs")
def lineage_nulls(c: Commerce) -> DataFrame:
    return reconcile.null_counts(c.runs(), ["finished_at", "error_type", "batch_id"])


@query("page_envelopes", """
    select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as updated_at,
      event_type as quote_currency from events""")
def page_envelopes(c: Commerce) -> DataFrame:
    """Events wrapped into response bodies of at most 500 rows, then read back."""
    row = F.struct(F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
                   F.col("event_type").alias("quote_currency"))
    bodies = c.raw("events").groupBy(F.expr("event_id div 500").alias("page")).agg(F.collect_list(row).alias("data")).select(
        F.to_json(F.struct("data", "page", F.lit(True).alias("has_more"))).alias("body"))
    rows, _ = pages.explode_pages(bodies, "updated_at", ["event_id", "updated_at", "quote_currency"])
    return rows


@query("invalid_envelopes", """
    select event_type, reason, count(*) as n from (select event_type, case event_type
        when 'click' then 'Response is not valid JSON'
        when 'error' then 'Response must be an object with a ''data'' list'
        when 'view' then 'Row is missing watermark field ''updated_at''' end as reason from events)
    where reason is not null group by 1, 2""")
def invalid_envelopes(c: Commerce) -> DataFrame:
    bodies = c.raw("events").select("event_type", F.expr("""case event_type
        when 'click' then '<html>' when 'error' then props
        when 'view' then concat('{"data":[', props, ']}')
        else concat('{"data":[{"updated_at":"', ts, '"}],"has_more":false}') end""").alias("body"))
    judged = pages.judge_pages(bodies, "updated_at").filter("reason is not null")
    return judged.groupBy("event_type", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("pages_extra_fields", """
    select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as updated_at, event_type,
      case when event_id % 3 = 0 then props end as extra from events""")
def pages_extra_fields(c: Commerce) -> DataFrame:
    """Rows keep every field that any row has, also those that only some have."""
    row = F.struct(F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("updated_at"), "event_type",
                   F.expr("case when event_id % 3 = 0 then props end").alias("extra"))
    bodies = c.raw("events").groupBy(F.expr("event_id div 500").alias("page")).agg(F.collect_list(row).alias("data")).select(
        F.to_json(F.struct("data")).alias("body"))
    return pages.explode_pages(bodies, "updated_at")[0]


@query("pages_incomplete", """
    select kind, case kind when 'gap' then 'Pages are not 1 to ' || n || ' once each' when 'more' then 'The last page says that there are more'
        when 'total' then 'Pages hold ' || r || ' rows of a total of ' || (r + 1) end as reason
    from (select count(distinct event_id // 500) as n, count(*) as r from events), (values ('whole'), ('gap'), ('more'), ('total')) k(kind)""")
def pages_incomplete(c: Commerce) -> DataFrame:
    """Events in pages (two or more of them), whole, without the first page, with more behind the last, and with one row too few."""
    row = F.struct(F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))
    paged = c.raw("events").groupBy(F.expr("event_id div 500 + 1").alias("page")).agg(F.collect_list(row).alias("data"))
    known = paged.agg(F.max("page").alias("last"), F.sum(F.size("data")).alias("rows")).first()

    def verdict(kind: str) -> DataFrame:
        kept = paged.filter("page <> 1") if kind == "gap" else paged
        total = F.lit(known["rows"] + (kind == "total"))
        body = F.to_json(F.struct("data", "page", total.alias("total"), ((F.col("page") < known["last"]) | F.lit(kind == "more")).alias("has_more")))
        judged = pages.judge_pages(kept.select(body.alias("body")), "updated_at")
        return pages.incomplete_pages(judged).select(F.lit(kind).alias("kind"), "reason")

    return reduce(DataFrame.unionByName, [verdict(k) for k in ("whole", "gap", "more", "total")])


@query("lossless_text", """
    select event_id, case when microsecond(ts) % 1000000 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end || '+00:00' as ts,
      cast(cast(value as decimal(12,2)) as varchar) as value, strftime(ts, '%Y-%m-%d') as day, props from events""")
def lossless_text(c: Commerce) -> DataFrame:
    return lossless.lossless(c.raw("events").selectExpr(
        "event_id", "ts", "cast(value as decimal(12,2)) as value", "cast(ts as date) as day", "props"))


# ---------------------------------------------------------------- data quality


def _suite_sql(layer: str, dataset: str, source: str, checks: list[tuple[str, str, str, str]]) -> str:
    parts = [
        f"""select '{layer}' as layer, '{dataset}' as dataset, '{rule.replace("'", "''")}' as rule, f = 0 as passed, f as failed, n as total,
        case when n = 0 then 'Empty DataFrame' when f = 0 then '{ok}' else 'Found ' || f || ' {bad}' end as detail
        from (select count(*) as n, {failed} as f from {source})"""
        for rule, failed, ok, bad in checks
    ]
    return "\nunion all\n".join(parts)


def _null(c: str) -> tuple[str, str, str, str]:
    return f"NullCheck({c})", f"count(*) filter (where {c} is null)", "No null values", "null value(s)"


def _range(c: str, lo, hi=None) -> tuple[str, str, str, str]:
    out = " or ".join(([f"{c} < {lo}"] if lo is not None else []) + ([f"{c} > {hi}"] if hi is not None else []))
    return f"RangeCheck({c}, min={lo}, max={hi})", f"count(*) filter (where {out})", "All values within range", "value(s) out of range"


def _set(c: str, allowed: tuple) -> tuple[str, str, str, str]:
    return f"SetCheck({c}, allowed={allowed})", f"count(*) filter (where {c} not in {allowed})", "All values in allowed set", "invalid value(s)"


def _unique(*cols: str) -> tuple[str, str, str, str]:
    key = "struct_pack(" + ", ".join(f"k{i} := {c}" for i, c in enumerate(cols)) + ")"
    return f"UniqueCheck({', '.join(cols)})", f"count(*) - count(distinct {key})", "All keys unique", "duplicate key row(s)"


@query("dq_null", _suite_sql("silver", "customers", "customers", [_null("customer_id"), _null("phone"), _null("city")]), "customers")
def dq_null(c: Commerce) -> DataFrame:
    checks = tuple(quality.NullCheck(x) for x in ("customer_id", "phone", "city"))
    return quality.run_suite(c.customers(), quality.Suite("customers", "silver", checks))


@query("dq_range", _suite_sql("silver", "payments", "payments", [_range("amount", 0), _range("amount", None, 300), _range("amount", 0, 300)]), "payments")
def dq_range(c: Commerce) -> DataFrame:
    checks = (quality.RangeCheck("amount", 0), quality.RangeCheck("amount", max_val=300), quality.RangeCheck("amount", 0, 300))
    return quality.run_suite(c.payments(), quality.Suite("payments", "silver", checks))


@query("dq_set", _suite_sql("silver", "payments", "payments", [_set("payment_status", rules.PAYMENT_STATUSES), _set("payment_method", rules.PAYMENT_METHODS)]), "payments")
def dq_set(c: Commerce) -> DataFrame:
    checks = (quality.SetCheck("payment_status", rules.PAYMENT_STATUSES), quality.SetCheck("payment_method", rules.PAYMENT_METHODS))
    return quality.run_suite(c.payments(), quality.Suite("payments", "silver", checks))


@query("dq_unique", _suite_sql("silver", "lineitem", "lineitem", [_unique("l_orderkey", "l_linenumber"), _unique("l_partkey")])
       + "\nunion all\n" + _suite_sql("silver", "customers", "customers", [_unique("phone")]), "customers")
def dq_unique(c: Commerce) -> DataFrame:
    lines = quality.Suite("lineitem", "silver", (quality.UniqueCheck(("l_orderkey", "l_linenumber")), quality.UniqueCheck(("l_partkey",))))
    phones = quality.Suite("customers", "silver", (quality.UniqueCheck(("phone",)),))
    return quality.run_suite(c.raw("lineitem"), lines).unionByName(quality.run_suite(c.customers(), phones))


@query("dq_referential", """
    select 'silver' as layer, 'reviews' as dataset, 'ReferentialIntegrityCheck(customer_id -> parent.customer_id)' as rule,
      f = 0 as passed, f as failed, n as total, case when f = 0 then 'All foreign keys valid' else 'Found ' || f || ' orphan record(s)' end as detail
    from (select count(*) as n, count(*) filter (where customer_id not in (select c_custkey from customer)) as f from reviews)
    union all
    select 'silver', 'items', 'ReferentialIntegrityCheck(order_id -> parent.order_id)', f = 0, f, n,
      case when f = 0 then 'All foreign keys valid' else 'Found ' || f || ' orphan record(s)' end
    from (select count(*) as n, count(*) filter (where order_id not in (select o_orderkey from orders)) as f from items)""", "reviews items")
def dq_referential(c: Commerce) -> DataFrame:
    reviews = quality.Suite("reviews", "silver", (quality.ReferentialIntegrityCheck("customer_id", c.customers(), "customer_id"),))
    items = quality.Suite("items", "silver", (quality.ReferentialIntegrityCheck("order_id", c.order_headers(), "order_id"),))
    return quality.run_suite(c.reviews(), reviews).unionByName(quality.run_suite(c.items(), items))


@query("dq_missing_column", """
    select 'silver' as layer, 'orders' as dataset, r as rule, p as passed, cast(0 as bigint) as failed, t as total, d as detail
    from (select count(*) as n from orders), lateral (values
      ('NullCheck(coupon)', false, cast(0 as bigint), 'Column ''coupon'' not found'),
      ('UniqueCheck(order_id, coupon)', false, cast(0 as bigint), 'Column ''coupon'' not found'),
      ('NullCheck(order_id)', true, n, 'No null values')) v(r, p, t, d)""")
def dq_missing_column(c: Commerce) -> DataFrame:
    checks = (quality.NullCheck("coupon"), quality.UniqueCheck(("order_id", "coupon")), quality.NullCheck("order_id"))
    return quality.run_suite(c.order_headers(), quality.Suite("orders", "silver", checks))


def _silver_tables(c: Commerce) -> dict[str, DataFrame]:
    return {"customers": c.customers(), "products": c.products(), "orders": c.order_headers(),
            "order_items": c.items(), "payments": c.payments()}


@query("dq_silver_suites", "\nunion all\n".join([
    _suite_sql("silver", "customers", "customers", [_null("customer_id"), _null("email"), _unique("customer_id")]),
    _suite_sql("silver", "products", "products", [_null("product_id"), _unique("product_id"), _range("unit_price", 0), _range("unit_cost", 0)]),
    _suite_sql("silver", "orders", "order_headers", [_null("order_id"), _null("customer_id"), _unique("order_id"), _range("total_amount", 0), _set("status", rules.ORDER_STATUSES)]),
    _suite_sql("silver", "order_items", "items", [_null("order_item_id"), _unique("order_item_id"), _range("quantity", 1), _range("unit_price", 0)]),
    _suite_sql("silver", "payments", "payments", [_null("payment_id"), _unique("payment_id"), _range("amount", 0), _set("payment_status", rules.PAYMENT_STATUSES)]),
]), "customers products order_headers items payments")
def dq_silver_suites(c: Commerce) -> DataFrame:
    tables = _silver_tables(c)
    results = [quality.run_suite(tables[n], s) for n, s in quality.suites("silver").items()]
    return reduce(DataFrame.unionByName, results)


@query("dq_gold_suites", "\nunion all\n".join([
    _suite_sql("gold", "fact_sales", "fact", [_null("sales_fact_key"), _unique("sales_fact_key"), _range("line_total_usd", 0)]),
    _suite_sql("gold", "dim_customer", "customers", [_null("customer_id"), _unique("customer_id")]),
    _suite_sql("gold", "dim_product", "products", [_null("product_id"), _unique("product_id")]),
    _suite_sql("gold", "dim_date", "(select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date_key from orders)",
               [_null("date_key"), _unique("date_key")]),
]), "fact products")
def dq_gold_suites(c: Commerce) -> DataFrame:
    tables = {"fact_sales": _fact(c), "dim_customer": star.dim_customer(c.customers()),
              "dim_product": star.dim_product(c.products()), "dim_date": star.dim_date_covering(c.raw("orders"), "o_orderdate")}
    results = [quality.run_suite(tables[n], s) for n, s in quality.suites("gold").items()]
    return reduce(DataFrame.unionByName, results)


@query("dq_summary", """
    select 'silver' as layer, 'payments' as dataset, cast(4 as bigint) as total_rules,
      cast(1 as bigint) + cast(u = 0 as int) + cast(a = 0 as int) + cast(s = 0 as int) as passed_rules,
      cast(3 as bigint) - cast(u = 0 as int) - cast(a = 0 as int) - cast(s = 0 as int) as failed_rules, u + a + s = 0 as passed
    from (select count(*) - count(distinct payment_id) as u, count(*) filter (where amount < 0) as a,
      count(*) filter (where payment_status not in ('pending', 'completed', 'failed', 'refunded')) as s from payments)""", "payments")
def dq_summary(c: Commerce) -> DataFrame:
    return quality.suite_summary(quality.run_suite(c.payments(), quality.SILVER_SUITES["payments"]))


# -------------------------------------------------------------------- detectors


@query("dup_email_case", "select lower(email) as email, count(*) as customers from contacts group by 1 having count(*) > 1", "contacts")
def dup_email_case(c: Commerce) -> DataFrame:
    return detect.email_case_duplicates(c.contacts())


@query("same_person_latest", """
    select email, event_id from (select lower(trim(email)) as email, event_id, ts from (select event_id, ts,
        case when event_type in ('error', 'signup') then upper(' user' || user_id || '@shop.example') else 'user' || user_id || '@shop.example' end as email from events))
    qualify row_number() over (partition by email order by ts desc, event_id desc) = 1""")
def same_person_latest(c: Commerce) -> DataFrame:
    """One record per address once case and blanks are ignored: the newest."""
    seen = c.raw("events").selectExpr("event_id", "ts", """case when event_type in ('error', 'signup')
        then upper(concat(' user', user_id, '@shop.example')) else concat('user', user_id, '@shop.example') end as email""")
    same = seen.withColumn("email", text.normal_email(F.col("email")))
    return dedup.latest_per_key(same, ["email"], "ts", ("event_id",)).select("email", "event_id")


@query("duplicate_excess", """
    select cast(coalesce(sum(n - 1), 0) as bigint) as excess from (select count(*) as n from contacts group by lower(email) having count(*) > 1)""", "contacts")
def duplicate_excess(c: Commerce) -> DataFrame:
    return detect.duplicate_excess(c.contacts(), text.normal_email(F.col("email")))


@query("messy_country_code", """
    select customer_id, case when is_active then country_code else lower(country_code) end as country_code
    from customers where not is_active""", "customers")
def messy_country_code(c: Commerce) -> DataFrame:
    typed_by_hand = c.customers().withColumn("country_code", F.expr("if(is_active, country_code, lower(country_code))"))
    return detect.messy_codes(typed_by_hand, "country_code").select("customer_id", "country_code")


@query("standard_country_code", "select country_code, count(*) as customers from customers group by 1", "customers")
def standard_country_code(c: Commerce) -> DataFrame:
    messy = c.customers().withColumn("country_code", F.expr("if(is_active, country_code, concat(' ', lower(country_code)))"))
    return detect.standard_codes(messy, "country_code").groupBy("country_code").agg(F.count(F.lit(1)).alias("customers"))


@query("messy_category", """
    select product_id, category, upper(category[1]) || lower(category[2:]) as standard_category
    from (select product_id, case when unit_cost > 700 then lower(category) else upper(category[1]) || lower(category[2:]) end as category from products)
    where category <> upper(category[1]) || lower(category[2:])""", "products")
def messy_category(c: Commerce) -> DataFrame:
    canonical = c.products().select(F.initcap("category").alias("category")).distinct()
    messy = c.products().withColumn("category", F.expr("if(unit_cost > 700, lower(category), initcap(category))"))
    return detect.messy_categories(messy, canonical).select("product_id", "category", "standard_category")


@query("null_profile", """
    select 'phone' as column_name, count(*) as "rows", count(*) filter (where phone is null) as nulls from customers
    union all select 'city', count(*), count(*) filter (where city is null) from customers""", "customers")
def null_profile(c: Commerce) -> DataFrame:
    return detect.null_profile(c.customers(), ["phone", "city"])


@query("negative_payments", "select payment_id, amount from payments where amount < 0", "payments")
def negative_payments(c: Commerce) -> DataFrame:
    return detect.negative_amounts(c.payments(), "amount").select("payment_id", "amount")


_CREATED = "(select l_orderkey as order_id, min(l_shipdate) as created_at from lineitem group by 1)"


def _orders_created(c: Commerce) -> DataFrame:
    first = c.items().groupBy("order_id").agg(F.min("updated_at").alias("created_at"))
    return c.order_headers().join(first, "order_id")


@query("future_dates", f"""
    select order_id, order_date, created_at from order_headers join {_CREATED} using (order_id) where order_date > created_at""", "order_headers")
def future_dates(c: Commerce) -> DataFrame:
    return detect.future_dated(_orders_created(c)).select("order_id", "order_date", "created_at")


@query("order_total_reconciliation", """
    select order_id, total_amount, coalesce(s, 0) as lines_total from order_headers left join (
      select order_id, cast(sum(cast(cast(quantity * unit_price as decimal(16,2)) * (100 - discount_pct) * cast(0.01 as decimal(3,2)) as decimal(14,2))) as decimal(18,2)) as s
      from items group by 1) using (order_id) where total_amount >= 0 and total_amount <> coalesce(s, 0)""", "order_headers items")
def order_total_reconciliation(c: Commerce) -> DataFrame:
    return detect.order_total_mismatches(c.order_headers(), c.items())


@query("line_total_cents", """
    select order_id, cast(sum((cast(round(unit_price * 100) as bigint) * quantity * (100 - cast(discount_pct as int)) + 50) // 100) as bigint) as cents
    from items group by 1""", "items")
def line_total_cents(c: Commerce) -> DataFrame:
    cents = money.line_cents((F.col("unit_price") * 100).cast("bigint"), F.col("quantity"), F.col("discount_pct").cast("int"))
    return c.items().groupBy("order_id").agg(F.sum(cents).alias("cents"))


@query("payment_reconciliation", """
    select payment_id, order_id, amount, total_amount from payments join order_headers using (order_id)
    where payment_status = 'completed' and amount >= 0 and amount <> total_amount""", "payments order_headers")
def payment_reconciliation(c: Commerce) -> DataFrame:
    return detect.payment_mismatches(c.payments(), c.order_headers()).select("payment_id", "order_id", "amount", "total_amount")


@query("orphan_reviews", """
    select event_id, customer_id from reviews where customer_id not in (select c_custkey from customer)""", "reviews")
def orphan_reviews(c: Commerce) -> DataFrame:
    return detect.orphan_reviews(c.reviews(), c.customers()).select("event_id", "customer_id")


@query("orphans_with_null_keys", """
    select event_id, k from (select event_id, case when event_type <> 'error' then event_id end as k from events)
    where k is null or k not in (select c_custkey from customer)""")
def orphans_with_null_keys(c: Commerce) -> DataFrame:
    child = c.raw("events").selectExpr("event_id", "case when event_type <> 'error' then event_id end as k")
    return reconcile.orphans(child, "k", c.raw("customer"), "c_custkey")


@query("invalid_rating", "select event_id, rating from reviews where rating not between 1 and 5", "reviews")
def invalid_rating(c: Commerce) -> DataFrame:
    return detect.invalid_ratings(c.reviews()).select("event_id", "rating")


@query("repeated_reviews", "select review_id, count(*) as n from reviews group by 1 having count(*) > 1", "reviews")
def repeated_reviews(c: Commerce) -> DataFrame:
    return detect.repeated_reviews(c.reviews())


@query("fx_restated", """
    select rate_date, quote_currency, rate, updated_at from quotes where cast(updated_at as date) > rate_date
    qualify row_number() over (partition by rate_date, quote_currency order by updated_at desc, rate desc, l_orderkey desc, l_partkey desc) = 1""", "quotes")
def fx_restated(c: Commerce) -> DataFrame:
    late = detect.restated_rates(c.quotes())
    newest = dedup.latest_per_key(late, ["rate_date", "quote_currency"], "updated_at", ("rate", "l_orderkey", "l_partkey"))
    return newest.select("rate_date", "quote_currency", "rate", "updated_at")


@query("fx_spine_gaps", """
    select quote_currency, d as rate_date from (select distinct quote_currency from quotes),
      (select cast(unnest(generate_series(cast(min(rate_date) as timestamp), cast(max(rate_date) as timestamp), interval 1 day)) as date) as d from quotes)
    where (quote_currency, d) not in (select (quote_currency, rate_date) from quotes)""", "quotes")
def fx_spine_gaps(c: Commerce) -> DataFrame:
    return detect.missing_rate_days(c.quotes())


@query("fx_bad_rates", """
    select l_orderkey, l_partkey, quote_currency, rate from quotes where rate <= 0 or (quote_currency = 'USD' and rate <> 1)""", "quotes")
def fx_bad_rates(c: Commerce) -> DataFrame:
    return detect.bad_rates(c.quotes()).select("l_orderkey", "l_partkey", "quote_currency", "rate")


@query("currency_mismatch", """
    select order_id, customer_id, currency, currency_code from
      (select order_id, customer_id, case when status = 'shipped' then 'USD' else currency end as currency from shop_orders)
    join (select customer_id, currency_code from customers) using (customer_id) where currency <> currency_code""", "shop_orders")
def currency_mismatch(c: Commerce) -> DataFrame:
    priced = c.orders().withColumn("currency", F.expr("if(status = 'shipped', 'USD', currency)"))
    return detect.currency_mismatches(priced, c.customers(), c.countries())


@query("order_before_customer", """
    select order_id, order_date as ordered_at, created_at as customer_since from order_headers
    join (select customer_id, created_at from customers) using (customer_id) where order_date < created_at""", "order_headers customers")
def order_before_customer(c: Commerce) -> DataFrame:
    orders = c.order_headers().withColumn("created_at", F.col("order_date"))
    return detect.orders_before_customer(orders, c.customers()).select("order_id", "ordered_at", "customer_since")


@query("defect_counts", """
    select 'payments' as dataset, 'negative' as defect, count(*) as "rows", count(*) filter (where amount < 0) as n from payments
    union all select 'payments', 'unpaid', count(*), count(*) filter (where payment_status = 'completed' and paid_at is null) from payments
    union all select 'customers', 'no_city', count(*), count(*) filter (where city is null) from customers
    union all select 'reviews', 'bad_rating', count(*), count(*) filter (where rating not between 1 and 5) from reviews""", "payments customers reviews")
def defect_counts(c: Commerce) -> DataFrame:
    return (
        detect.defect_counts(c.payments(), "payments", {"negative": "amount < 0", "unpaid": "payment_status = 'completed' and paid_at is null"})
        .unionByName(detect.defect_counts(c.customers(), "customers", {"no_city": "city is null"}))
        .unionByName(detect.defect_counts(c.reviews(), "reviews", {"bad_rating": "rating not between 1 and 5"}))
    )


@query("slug_names", "select p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') as slug from part")
def slug_names(c: Commerce) -> DataFrame:
    return c.raw("part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@query("slug_accents", r"""
    select doc_id, regexp_replace(lower(strip_accents(s)), '[^a-z0-9]', '', 'g') as slug
    from (select doc_id, regexp_replace(text, '[^\x00-\x7F\x{C0}-\x{D6}\x{D8}-\x{DE}\x{E0}-\x{F6}\x{F8}-\x{FE}]', '', 'g') as s from documents)""")
def slug_accents(c: Commerce) -> DataFrame:
    """Whole texts in four languages as slugs: their letters are folded, not lost."""
    return c.raw("documents").select("doc_id", text.slug(F.regexp_replace("text", "[^\\x00-\\x7F\u00c0-\u00d6\u00d8-\u00de\u00e0-\u00f6\u00f8-\u00fe]+", "")).alias("slug"))


@query("date_keys", """
    select l_orderkey, l_linenumber, l_shipdate, cast(strftime(l_shipdate, '%Y%m%d') as int) as date_key, cast(year(l_shipdate) as int) as y,
      cast(month(l_shipdate) as int) as m from lineitem""")
def date_keys(c: Commerce) -> DataFrame:
    keyed = c.raw("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", dates.date_key(F.col("l_shipdate")).alias("date_key"))
    return keyed.withColumns({"y": dates.key_year(F.col("date_key")), "m": dates.key_month(F.col("date_key"))})


# ------------------------------------------------------------------------ audit


@query("run_summary", """
    select pipeline_name, source_system, dataset, count(*) as total_runs, count(*) filter (where status = 'success') as successful_runs,
      count(*) filter (where status = 'failed') as failed_runs, cast(sum(records_extracted) as bigint) as total_records_extracted,
      cast(sum(records_processed) as bigint) as total_records_processed, cast(sum(records_rejected) as bigint) as total_records_rejected,
      max(started_at) as last_run_at from runs group by 1, 2, 3""", "runs")
def run_summary(c: Commerce) -> DataFrame:
    return audit.run_summary(c.runs())


@query("failed_runs", """
    select run_id, pipeline_name, source_system, dataset, batch_id, started_at, finished_at, error_type, error_message
    from runs where status = 'failed' order by started_at desc""", "runs")
def failed_runs(c: Commerce) -> DataFrame:
    return audit.failed_runs(c.runs())


@query("recent_runs", "select run_id, started_at, status from runs order by started_at desc, run_id desc limit 50", "runs")
def recent_runs(c: Commerce) -> DataFrame:
    return audit.recent_runs(c.runs().select("run_id", "started_at", "status"), 50)


@query("latest_watermarks", """
    select * from (select source_system, dataset, case when status <> 'failed' then batch_id end as watermark, started_at as updated_at, run_id
      from runs qualify row_number() over (partition by source_system, dataset order by started_at desc, run_id desc) = 1)
    where watermark is not null""", "runs")
def latest_watermarks(c: Commerce) -> DataFrame:
    log = c.runs().selectExpr("source_system", "dataset", "case when status <> 'failed' then batch_id end as watermark",
                              "started_at as updated_at", "run_id")
    return audit.latest_watermarks(log)


@query("processed_total", """
    select cast(sum(records_processed) filter (where status = 'success') as bigint) as records_processed, count(*) as total_runs from runs""", "runs")
def processed_total(c: Commerce) -> DataFrame:
    return audit.processed_total(c.runs(), default=0)


@query("current_runs", """
    select run_id, status, finished_at from (
      select run_id, 'running' as status, cast(null as timestamp) as finished_at from runs
      union all select run_id, status, finished_at from runs where finished_at is not null)
    qualify row_number() over (partition by run_id order by finished_at desc nulls last) = 1""", "runs")
def current_runs(c: Commerce) -> DataFrame:
    runs = c.runs()
    started = runs.selectExpr("run_id", "'running' as status", "cast(null as timestamp) as finished_at")
    finished = runs.filter("finished_at is not null").select("run_id", "status", "finished_at")
    return audit.current_runs(started.unionByName(finished))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Commerce(spark, sf_dir))

    return {name: bind(fn) for name, fn in SPARK.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
