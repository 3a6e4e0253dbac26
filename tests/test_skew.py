"""One key holds a third of all rows: results stay whole, plans do not send it to one task."""

from collections import Counter
from decimal import Decimal as D

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalake.operators import dedup, detect, quality, reconcile, star

N = 30_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """Rows 0..N-1; every third has the key 0, a sixth have none, the rest their own."""
    return spark.range(N).selectExpr(
        "id", "case when id % 3 = 0 then 0 when id % 6 = 1 then null else id end as k", "id % 1000 as v",
        "timestamp_seconds(id % 977) as updated_at").repartition(8)


@pytest.fixture(scope="module")
def small_partitions(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_latest_per_key(hot):
    got = {r.k: r.id for r in dedup.latest_per_key(hot, ["k"], "updated_at", ("id",)).collect()}
    best = {}
    for r in hot.collect():
        if r.k not in best or (r.updated_at, r.id) > best[r.k]:
            best[r.k] = (r.updated_at, r.id)
    assert got == {k: i for k, (_, i) in best.items()}


def test_unique_and_referential_checks(spark, hot):
    parent = spark.range(1, N, 2).withColumnRenamed("id", "p")
    suite = quality.Suite("t", "silver", (quality.UniqueCheck(("k",)), quality.ReferentialIntegrityCheck("k", parent, "p")))
    got = {r.rule.split("(")[0]: r.failed for r in quality.run_suite(hot, suite).collect()}
    keys = [r.k for r in hot.select("k").collect()]
    assert got["UniqueCheck"] == N - len(set(keys))
    assert got["ReferentialIntegrityCheck"] == sum(k is None or k % 2 == 0 for k in keys)


def test_orphans_keep_null_keys_out_of_the_join(spark, hot, small_partitions):
    lost = reconcile.orphans(hot, "k", spark.range(1, N, 2).withColumnRenamed("id", "p"), "p")
    expected = [r.id for r in hot.collect() if r.k is None or r.k % 2 == 0]
    assert sorted(r.id for r in lost.collect()) == sorted(expected)
    plan = plan_of(lost)
    assert "Union" not in plan and "_spread_child" in plan.split("hashpartitioning", 1)[1].split(")")[0]


def test_duplicates_are_counted_before_the_shuffle(hot):
    counts = Counter(r.k for r in hot.select("k").collect())
    assert detect.duplicate_excess(hot, F.col("k")).first().excess == sum(n - 1 for n in counts.values() if n > 1)


def test_hot_order_is_split_in_the_fact_join(spark, small_partitions):
    items = spark.range(N).selectExpr(
        "id as order_item_id", "if(id % 3 = 0, 7, id % 500) as order_id", "id % 50 as product_id", "1 as quantity",
        "cast(id % 90 + 1 as decimal(12,2)) as unit_price", "cast(id % 11 as decimal(5,2)) as discount_pct")
    orders = spark.range(500).selectExpr(
        "id as order_id", "id % 40 as customer_id", "timestamp'2025-01-01' as order_date", "'paid' as status", "'USD' as currency", "'US' as shipping_country")
    fact = star.fact_sales(orders, items)
    rows = fact.select("order_item_id", "line_total_usd").collect()
    assert len(rows) == N
    want = sum((D(i % 90 + 1) * (100 - i % 11) / 100).quantize(D("0.01"), "ROUND_HALF_UP") for i in range(N))
    assert sum(r.line_total_usd for r in rows) == want
    done = fact.select("order_item_id", "line_total_usd")
    done.collect()
    assert "skew=true" in plan_of(done)


def test_kpi_of_a_hot_group(spark):
    fact = spark.range(N).selectExpr(
        "id as order_item_id", "id div 3 as order_id", "id % 777 as customer_id", "id % 50 as product_id", "20250101 as order_date_key",
        "if(id % 3 = 0, 'US', concat('C', id % 20)) as shipping_country", "1 as quantity", "cast(1.25 as decimal(14,2)) as line_total_usd")
    kpi = {r.shipping_country: (r.total_orders, r.unique_customers, r.total_items_sold) for r in star.kpi_monthly_sales(fact).collect()}
    groups = {}
    for i in range(N):
        country = "US" if i % 3 == 0 else f"C{i % 20}"
        orders, customers, n = groups.setdefault(country, (set(), set(), [0]))
        orders.add(i // 3), customers.add(i % 777)
        n[0] += 1
    assert kpi == {c: (len(o), len(p), n[0]) for c, (o, p, n) in groups.items()}


def test_upsert_of_a_hot_bucket(spark):
    """Many copies of a few keys on top of a table: the newest copy wins, nothing else moves."""
    target = spark.range(1000).selectExpr("id", "0 as v", "timestamp_seconds(0) as updated_at")
    changes = spark.range(N).selectExpr("if(id % 3 = 0, 5, id % 1500) as id", "id as v", "timestamp_seconds(id) as updated_at")
    newest = dedup.latest_per_key(changes, ["id"], "updated_at")
    got = {r.id: r.v for r in dedup.upsert(target, newest, ["id"], "updated_at").collect()}
    want = {i: 0 for i in range(1000)}
    for i in range(N):
        want[5 if i % 3 == 0 else i % 1500] = i
    assert got == want
