"""The given tables seen as the commerce datasets the package works on.

Each dataset has a Spark form (a function) and a DuckDB form (a named query in ``VIEWS``) with the
same columns, so a query and its check start from the same rows. Whole tables are mapped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import apply_settings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Commerce:
    """Datasets derived from the tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = apply_settings(spark), sf_dir

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def countries(self) -> DataFrame:
        """The nations; the first one has the base currency."""
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
            "n_name as country_code",
            "concat('ISO_', n_nationkey) as iso3",
            "initcap(n_name) as country_name",
            "r_name as region",
            "case when n_nationkey = 0 then 'USD' else n_name end as currency_code",
            "n_nationkey",
        )

    def customers(self) -> DataFrame:
        """Customers whose account opened a number of days after 1995 that their balance gives."""
        customer = self.raw("customer")
        countries = self.countries().drop("iso3")
        return customer.join(countries, customer.c_nationkey == countries.n_nationkey).selectExpr(
            "c_custkey as customer_id",
            "substring_index(c_name, '#', 1) as first_name",
            "substring_index(c_name, '#', -1) as last_name",
            "concat(lower(replace(c_name, '#', '.')), '@', lower(c_mktsegment), '.example') as email",
            "case when c_acctbal >= 0 then concat('+', c_custkey) end as phone",
            "country_code",
            "case when c_mktsegment <> 'BUILDING' then region end as city",
            "lower(c_mktsegment) as segment",
            "date_add(date'1995-01-01', cast(floor(abs(c_acctbal) / 10) as int)) as signup_date",
            "c_acctbal >= 0 as is_active",
            "cast(date_add(date'1995-01-01', cast(floor(abs(c_acctbal) / 10) as int)) as timestamp) as created_at",
            "currency_code",
        )

    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey as product_id",
            "concat(p_brand, '-', p_partkey) as sku",
            "p_name as product_name",
            "p_type as category",
            "cast(p_retailprice as decimal(12,2)) as unit_price",
            "cast(cast(p_retailprice as decimal(12,2)) - 10 * p_size as decimal(12,2)) as unit_cost",
            "'USD' as currency",
            "p_size < 40 as is_active",
        )

    def order_headers(self) -> DataFrame:
        """Orders on their own; priorities stand for states, one of which is not a known one."""
        return self.raw("orders").selectExpr(
            "o_orderkey as order_id",
            "o_custkey as customer_id",
            "o_orderdate as order_date",
            """case o_orderpriority when '1-URGENT' then 'shipped' when '2-HIGH' then 'paid'
               when '3-MEDIUM' then 'pending' when '5-LOW' then 'delivered'
               else lower(o_orderpriority) end as status""",
            "cast(o_totalprice as decimal(14,2)) as total_amount",
        )

    def orders(self) -> DataFrame:
        """Orders with the currency and country of their customer."""
        home = self.customers().selectExpr("customer_id", "currency_code as currency", "country_code as shipping_country")
        return self.order_headers().join(home, "customer_id")

    def items(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber as order_item_id",
            "l_orderkey as order_id",
            "l_partkey as product_id",
            "cast(l_quantity as int) as quantity",
            "cast(l_extendedprice as decimal(12,2)) as unit_price",
            "cast(cast(round(l_discount * 100) as int) as decimal(5,2)) as discount_pct",
            "l_shipdate as updated_at",
        )

    def rates(self) -> DataFrame:
        """A rate per nation and working day from the first to the last order; none on Saturdays and Sundays.

        Its size is nations x calendar days whatever the size of the other tables.
        """
        bounds = self.raw("orders").selectExpr("cast(o_orderdate as date) as day").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
        days = F.sequence(bounds.select("lo").scalar(), bounds.select("hi").scalar(), F.expr("interval 1 day"))
        return (
            self.raw("nation")
            .select("n_nationkey", "n_name", F.explode(days).alias("rate_date"))
            .filter("dayofweek(rate_date) not in (1, 7)")
            .selectExpr(
                "rate_date",
                "case when n_nationkey = 0 then 'USD' else n_name end as quote_currency",
                """cast(cast(40 + 3 * n_nationkey + dayofmonth(rate_date) as decimal(12,6))
                   * cast(0.01 as decimal(3,2)) as decimal(12,6)) as rate_to_usd""",
            )
        )

    def quotes(self) -> DataFrame:
        """Rates seen in shipments: per supplier nation and shipping day, restated during the
        days after by later lines of the order."""
        line, supplier = self.raw("lineitem"), self.raw("supplier")
        nation = self.raw("nation")
        return (
            line.join(supplier, line.l_suppkey == supplier.s_suppkey)
            .join(nation, supplier.s_nationkey == nation.n_nationkey)
            .selectExpr(
                "cast(l_shipdate as date) as rate_date",
                "case when n_nationkey = 0 then 'USD' else n_name end as quote_currency",
                "cast(round(l_discount * 100) as int) as rate",
                "l_shipdate + make_interval(0, 0, 0, 0, l_linenumber * 8, 0, 0) as updated_at",
                "l_orderkey",
                "l_partkey",
            )
        )

    def payments(self) -> DataFrame:
        """Events as payments net of a fee of 5.00; clicks stand for an unknown state."""
        return self.raw("events").selectExpr(
            "event_id as payment_id",
            "event_id as order_id",
            """case when cast(get_json_object(props, '$.k') as int) < 40 then 'card'
                    when cast(get_json_object(props, '$.k') as int) < 90 then 'paypal' else 'cash' end as payment_method""",
            """case event_type when 'purchase' then 'completed' when 'view' then 'pending'
                    when 'error' then 'failed' when 'signup' then 'refunded' else event_type end as payment_status""",
            "cast(cast(value as decimal(14,2)) - cast(5 as decimal(14,2)) as decimal(14,2)) as amount",
            "case when cast(get_json_object(props, '$.k') as int) >= 10 then ts end as paid_at",
            "ts as created_at",
        )

    def reviews(self) -> DataFrame:
        """Events as reviews: one id per user and day, so ids repeat; reviewers beyond the
        customers are unknown."""
        return self.raw("events").selectExpr(
            "concat(user_id, '-', date_format(ts, 'yyyyMMdd')) as review_id",
            "event_id",
            "event_id as customer_id",
            "user_id as product_id",
            "cast(floor(cast(get_json_object(props, '$.k') as int) / 14) as int) as rating",
            "event_type as comment",
            "ts as review_date",
        )

    def contacts(self) -> DataFrame:
        """Addresses users left behind, in upper case after an error or a sign-up."""
        return self.raw("events").selectExpr(
            """case when event_type in ('error', 'signup') then upper(concat('user', user_id, '@shop.example'))
                    else concat('user', user_id, '@shop.example') end as email"""
        ).distinct()

    def runs(self) -> DataFrame:
        """Events as pipeline runs: errors failed."""
        return self.raw("events").selectExpr(
            "event_id as run_id",
            "concat('pipeline_', dayofweek(ts)) as pipeline_name",
            "case when value < 25 then 'files' else 'postgres' end as source_system",
            "concat('dataset_', user_id) as dataset",
            "date_format(ts, 'yyyyMMdd') as batch_id",
            "ts as started_at",
            "case when event_type <> 'view' then ts + make_interval(0, 0, 0, 0, 0, 5, 0) end as finished_at",
            """case event_type when 'error' then 'failed' when 'view' then 'running'
                    when 'click' then 'partial' else 'success' end as status""",
            "cast(get_json_object(props, '$.k') as bigint) as records_extracted",
            "cast(floor(value) as bigint) as records_processed",
            "cast(user_id as bigint) as records_rejected",
            "case when event_type = 'error' then 'IngestionError' end as error_type",
            "case when event_type = 'error' then concat('event ', event_id) end as error_message",
        )

    def landed(self) -> DataFrame:
        """Events as landed rows, one batch per day."""
        return self.raw("events").selectExpr(
            "event_id", "ts as ingestion_timestamp", "event_type as source_system",
            "date_format(ts, 'yyyyMMdd') as batch_id", "value", "dayofweek(ts) as dow", "user_id", "props",
        )

    def bronze(self) -> DataFrame:
        """The landed rows a loader kept that ran on working days and lost values from 300 on."""
        return self.landed().filter("dow not in (1, 7) and value < 300")

    def manifests(self) -> DataFrame:
        return self.landed().groupBy("batch_id").agg(F.count(F.lit(1)).alias("record_count"))


VIEWS = {
    "countries": """select n_name as country_code, 'ISO_' || n_nationkey as iso3,
        upper(n_name[1]) || lower(n_name[2:]) as country_name, r_name as region,
        case when n_nationkey = 0 then 'USD' else n_name end as currency_code, n_nationkey
        from nation join region on n_regionkey = r_regionkey""",
    "customers": """select c_custkey as customer_id, split_part(c_name, '#', 1) as first_name,
        split_part(c_name, '#', 2) as last_name,
        lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example' as email,
        case when c_acctbal >= 0 then '+' || c_custkey end as phone, country_code,
        case when c_mktsegment <> 'BUILDING' then region end as city, lower(c_mktsegment) as segment,
        date '1995-01-01' + cast(floor(abs(c_acctbal) / 10) as int) as signup_date,
        c_acctbal >= 0 as is_active,
        cast(date '1995-01-01' + cast(floor(abs(c_acctbal) / 10) as int) as timestamp) as created_at,
        currency_code
        from customer join countries on c_nationkey = n_nationkey""",
    "products": """select p_partkey as product_id, p_brand || '-' || p_partkey as sku, p_name as product_name,
        p_type as category, cast(p_retailprice as decimal(12,2)) as unit_price,
        cast(cast(p_retailprice as decimal(12,2)) - 10 * p_size as decimal(12,2)) as unit_cost,
        'USD' as currency, p_size < 40 as is_active from part""",
    "order_headers": """select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_date,
        case o_orderpriority when '1-URGENT' then 'shipped' when '2-HIGH' then 'paid'
          when '3-MEDIUM' then 'pending' when '5-LOW' then 'delivered' else lower(o_orderpriority) end as status,
        cast(o_totalprice as decimal(14,2)) as total_amount from orders""",
    "shop_orders": """select h.*, currency_code as currency, country_code as shipping_country
        from order_headers h join customers using (customer_id)""",
    "items": """select l_orderkey * 10 + l_linenumber as order_item_id, l_orderkey as order_id,
        l_partkey as product_id, cast(l_quantity as int) as quantity,
        cast(l_extendedprice as decimal(12,2)) as unit_price,
        cast(cast(round(l_discount * 100) as int) as decimal(5,2)) as discount_pct,
        l_shipdate as updated_at from lineitem""",
    "rates": """select cast(d as date) as rate_date,
        case when n_nationkey = 0 then 'USD' else n_name end as quote_currency,
        cast(cast(40 + 3 * n_nationkey + day(d) as decimal(12,6)) * cast(0.01 as decimal(3,2)) as decimal(12,6)) as rate_to_usd
        from nation, (select unnest(generate_series(cast(min(o_orderdate) as date), cast(max(o_orderdate) as date), interval 1 day)) as d from orders)
        where dayofweek(d) not in (0, 6)""",
    "quotes": """select cast(l_shipdate as date) as rate_date,
        case when n_nationkey = 0 then 'USD' else n_name end as quote_currency,
        cast(round(l_discount * 100) as int) as rate,
        l_shipdate + to_hours(l_linenumber * 8) as updated_at, l_orderkey, l_partkey
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""",
    "payments": """select event_id as payment_id, event_id as order_id,
        case when k < 40 then 'card' when k < 90 then 'paypal' else 'cash' end as payment_method,
        case event_type when 'purchase' then 'completed' when 'view' then 'pending'
          when 'error' then 'failed' when 'signup' then 'refunded' else event_type end as payment_status,
        cast(cast(value as decimal(14,2)) - cast(5 as decimal(14,2)) as decimal(14,2)) as amount,
        case when k >= 10 then ts end as paid_at, ts as created_at
        from (select *, cast(json_extract_string(props, '$.k') as int) as k from events)""",
    "reviews": """select user_id || '-' || strftime(ts, '%Y%m%d') as review_id, event_id,
        event_id as customer_id, user_id as product_id,
        cast(floor(cast(json_extract_string(props, '$.k') as int) / 14) as int) as rating,
        event_type as comment, ts as review_date from events""",
    "contacts": """select distinct case when event_type in ('error', 'signup')
        then upper('user' || user_id || '@shop.example') else 'user' || user_id || '@shop.example' end as email
        from events""",
    "runs": """select event_id as run_id, 'pipeline_' || (dayofweek(ts) + 1) as pipeline_name,
        case when value < 25 then 'files' else 'postgres' end as source_system,
        'dataset_' || user_id as dataset, strftime(ts, '%Y%m%d') as batch_id, ts as started_at,
        case when event_type <> 'view' then ts + interval 5 minute end as finished_at,
        case event_type when 'error' then 'failed' when 'view' then 'running'
          when 'click' then 'partial' else 'success' end as status,
        cast(json_extract_string(props, '$.k') as bigint) as records_extracted,
        cast(floor(value) as bigint) as records_processed, user_id as records_rejected,
        case when event_type = 'error' then 'IngestionError' end as error_type,
        case when event_type = 'error' then 'event ' || event_id end as error_message from events""",
    "landed": """select event_id, ts as ingestion_timestamp, event_type as source_system,
        strftime(ts, '%Y%m%d') as batch_id, value, dayofweek(ts) + 1 as dow, user_id, props from events""",
    "bronze": "select * from landed where dow not in (1, 7) and value < 300",
    "manifests": "select batch_id, count(*) as record_count from landed group by batch_id",
    "fact": """select order_id || '_' || order_item_id as sales_fact_key, order_id, order_item_id, customer_id,
        product_id, cast(strftime(order_date, '%Y%m%d') as int) as order_date_key, shipping_country,
        status as order_status, currency, quantity, unit_price as unit_price_local, discount_pct,
        cast(base as decimal(14,2)) as line_total_local, rate as exchange_rate_to_usd,
        cast(cast(base as decimal(24,6)) * rate as decimal(14,2)) as line_total_usd
        from (select o.*, i.order_item_id, i.product_id, i.quantity, i.unit_price, i.discount_pct,
            cast(quantity * unit_price as decimal(16,2)) * (100 - discount_pct) * cast(0.01 as decimal(3,2)) as base,
            case when currency = 'USD' then cast(1 as decimal(12,6)) else coalesce(rate_to_usd, cast(1 as decimal(12,6))) end as rate
          from items i join shop_orders o using (order_id)
          left join rates on rate_date = cast(order_date as date) and quote_currency = currency)""",
    "monthly": """select order_date_key // 10000 as year, order_date_key % 10000 // 100 as month,
        cast(sum(line_total_usd) as decimal(18,2)) as revenue_usd from fact group by 1, 2""",
}

NEEDS = {
    "customers": ("countries",),
    "shop_orders": ("countries", "customers", "order_headers"),
    "bronze": ("landed",),
    "manifests": ("landed",),
    "fact": ("countries", "customers", "order_headers", "shop_orders", "items", "rates"),
    "monthly": ("countries", "customers", "order_headers", "shop_orders", "items", "rates", "fact"),
}


def with_views(names: str, sql: str) -> str:
    """``sql`` preceded by the named datasets and what they are derived from."""
    wanted: list[str] = []
    for name in names.split():
        for view in (*NEEDS.get(name, ()), name):
            if view not in wanted:
                wanted.append(view)
    heads = ",\n".join(f"{v} as ({VIEWS[v]})" for v in wanted)
    return f"with {heads}\n{sql}" if heads else sql
