from datetime import date, datetime
from decimal import Decimal as D

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalake.functions.text import normal_email
from stratalake.operators import audit, detect, quality, reconcile


def verdicts(df, *checks):
    results = quality.run_suite(df, quality.Suite("t", "silver", checks))
    return {r.rule: (r.passed, r.failed, r.total, r.detail) for r in results.collect()}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (None, 11, None), (None, -1, "z")], "k int, v int, s string")


def test_checks(table):
    got = verdicts(
        table, quality.NullCheck("k"), quality.RangeCheck("v", 0, 10), quality.RangeCheck("v", max_val=10),
        quality.SetCheck("s", ("a", "b")), quality.UniqueCheck(("k",)), quality.UniqueCheck(("k", "v")),
        quality.NullCheck("none"), quality.UniqueCheck(("k", "none")),
    )
    assert got["NullCheck(k)"] == (False, 2, 4, "Found 2 null value(s)")
    assert got["RangeCheck(v, min=0, max=10)"] == (False, 2, 4, "Found 2 value(s) out of range")
    assert got["RangeCheck(v, min=None, max=10)"][1] == 1
    assert got["SetCheck(s, allowed=('a', 'b'))"][:2] == (False, 1)
    assert got["UniqueCheck(k)"] == (False, 2, 4, "Found 2 duplicate key row(s)")
    assert got["UniqueCheck(k, v)"] == (True, 0, 4, "All keys unique")
    assert got["NullCheck(none)"] == got["UniqueCheck(k, none)"] == (False, 0, 0, "Column 'none' not found")


def test_empty_table_passes(table):
    got = verdicts(table.limit(0), quality.NullCheck("k"), quality.UniqueCheck(("k",)))
    assert set(got.values()) == {(True, 0, 0, "Empty DataFrame")}


def test_referential_integrity(spark, table):
    parent = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    got = verdicts(table, quality.ReferentialIntegrityCheck("k", parent, "id"), quality.NullCheck("v"))
    assert got["ReferentialIntegrityCheck(k -> parent.id)"] == (False, 2, 4, "Found 2 orphan record(s)")
    empty = verdicts(table.limit(0), quality.ReferentialIntegrityCheck("k", parent, "id"))
    assert list(empty.values()) == [(True, 0, 0, "Empty DataFrame")]
    absent = verdicts(table, quality.ReferentialIntegrityCheck("none", parent, "id"))
    assert list(absent.values()) == [(False, 0, 0, "Column 'none' not found")]


def test_one_pass_for_a_suite(table):
    results = quality.run_suite(table, quality.Suite("t", "silver", (quality.NullCheck("k"), quality.RangeCheck("v", 0), quality.SetCheck("s", ("a",)))))
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_shipped_suites():
    assert sum(len(s.checks) for s in quality.suites("silver").values()) == 20
    assert sum(len(s.checks) for s in quality.suites("gold").values()) == 9
    for layer, names in (("silver", ["nope"]), ("bronze", None)):
        with pytest.raises(ValueError):
            quality.suites(layer, names)


def test_summary(table):
    summary = quality.suite_summary(quality.run_suite(table, quality.Suite("t", "silver", (quality.NullCheck("k"), quality.NullCheck("v"), quality.UniqueCheck(("k", "v")))))).first()
    assert (summary.total_rules, summary.passed_rules, summary.failed_rules, summary.passed) == (3, 1, 2, False)


def test_orphans_count_null_keys(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows_of(reconcile.orphans(child, "k", parent, "id"), "v") == [("b",), ("c",)]


def test_batch_reconciliation(spark):
    table = spark.createDataFrame([("b1",), ("b1",), ("b2",), ("b9",)], "batch_id string")
    manifests = spark.createDataFrame([("b1", 2), ("b2", 3), ("b3", 1), ("b4", 0)], "batch_id string, record_count bigint")
    got = {r.batch_id: r.verdict for r in reconcile.batch_reconciliation(table, manifests).collect()}
    assert got == {"b1": "ok", "b2": "mismatch", "b3": "missing", "b9": "unexpected"}


# Planted by a rule on the number n, so the numbers that must be found are known.
N = 300


def test_planted_customer_defects(spark):
    people = spark.range(N).selectExpr(
        "id", "if(id % 10 = 0, upper(concat('u', id - 1, '@x.org')), concat('u', id, '@x.org')) as email",
        "if(id % 25 = 3, 'us', 'US') as country_code", "if(id % 7 = 0, null, 'Rome') as city")
    # Ten's addresses repeat those of the nines before them; the first has no predecessor.
    assert detect.duplicate_excess(people, normal_email(F.col("email"))).first().excess == N // 10 - 1
    assert detect.email_case_duplicates(people).count() == N // 10 - 1
    assert detect.messy_codes(people, "country_code").count() == N // 25
    assert detect.messy_codes(detect.standard_codes(people, "country_code"), "country_code").count() == 0
    nulls = detect.null_profile(people, ["city", "email"])
    assert rows_of(nulls, "column_name", "rows", "nulls") == [("city", N, 43), ("email", N, 0)]
    counts = detect.defect_counts(people, "customers", {"no_city": "city is null", "low": "country_code = 'us'"})
    assert rows_of(counts, "defect", "rows", "n") == [("low", N, 12), ("no_city", N, 43)]


def test_planted_order_defects(spark):
    orders = spark.range(N).selectExpr(
        "id as order_id",
        "cast(case when id % 50 = 1 then -20 when id % 30 = 7 then 21 else 20 end as decimal(14,2)) as total_amount",
        "timestamp'2025-01-02' as order_date", "if(id % 100 = 5, timestamp'2025-01-01', timestamp'2025-01-03') as created_at")
    items = spark.range(2 * N).selectExpr("id div 2 as order_id", "1 as quantity", "cast(10 as decimal(12,2)) as unit_price", "cast(0 as decimal(5,2)) as discount_pct")
    assert detect.negative_amounts(orders, "total_amount").count() == 6
    assert detect.order_total_mismatches(orders, items).count() == 10
    assert detect.future_dated(orders).count() == 3
    lone = orders.filter("order_id = 0")
    assert detect.order_total_mismatches(lone, items.limit(0)).first().lines_total == 0
    payments = orders.selectExpr("order_id as payment_id", "order_id", "if(order_id % 60 = 2, total_amount + 1, total_amount) as amount",
                                 "if(order_id % 120 = 2, 'pending', 'completed') as payment_status")
    assert detect.payment_mismatches(payments, orders).count() == 2


def test_categories(spark):
    products = spark.createDataFrame([(1, "TOYS"), (2, "Toys"), (3, "odd")], "id int, category string")
    canonical = spark.createDataFrame([("Toys",)], "category string")
    assert rows_of(detect.standard_categories(products, canonical), "id", "standard_category") == [(1, "Toys"), (2, "Toys"), (3, "odd")]
    assert rows_of(detect.messy_categories(products, canonical), "id") == [(1,)]


def test_reviews(spark):
    reviews = spark.createDataFrame([("r1", 1, 5), ("r1", 1, 0), ("r2", 9, 6), ("r3", None, 1)], "review_id string, customer_id int, rating int")
    people = spark.createDataFrame([(1,)], "customer_id int")
    assert detect.orphan_reviews(reviews, people).count() == 2
    assert detect.invalid_ratings(reviews).count() == 2
    assert rows_of(detect.repeated_reviews(reviews), "*") == [("r1", 2)]


def test_rates(spark):
    rates = spark.createDataFrame(
        [(date(2025, 1, 1), "EUR", D("0.9"), datetime(2025, 1, 1, 18)), (date(2025, 1, 3), "EUR", D("0"), datetime(2025, 1, 5)),
         (date(2025, 1, 2), "USD", D("1"), datetime(2025, 1, 2)), (date(2025, 1, 3), "USD", D("2"), datetime(2025, 1, 3))],
        "rate_date date, quote_currency string, rate decimal(12,6), updated_at timestamp")
    assert rows_of(detect.missing_rate_days(rates), "quote_currency", "rate_date") == [("EUR", date(2025, 1, 2)), ("USD", date(2025, 1, 1))]
    assert detect.missing_rate_days(rates, "2025-01-01", "2025-01-04").count() == 4
    assert rows_of(detect.restated_rates(rates), "rate_date") == [(date(2025, 1, 3),)]
    assert detect.bad_rates(rates).count() == 2


def test_order_against_customer(spark):
    people = spark.createDataFrame([(1, "de", datetime(2025, 1, 2)), (2, "US", datetime(2025, 1, 2))], "customer_id int, country_code string, created_at timestamp")
    countries = spark.createDataFrame([("DE", "EUR"), ("US", "USD")], "country_code string, currency_code string")
    orders = spark.createDataFrame([(10, 1, "EUR", datetime(2025, 1, 1)), (11, 2, "EUR", datetime(2025, 1, 3))], "order_id int, customer_id int, currency string, created_at timestamp")
    assert rows_of(detect.currency_mismatches(orders, people, countries), "order_id", "currency_code") == [(11, "USD")]
    assert rows_of(detect.orders_before_customer(orders, people), "order_id") == [(10,)]


def test_audit_views(spark):
    runs = spark.createDataFrame(
        [("1", "p", "s", "d", "b", datetime(2025, 1, 1), None, "success", 10, 9, 1, None, None),
         ("2", "p", "s", "d", "b", datetime(2025, 1, 2), None, "failed", 5, 0, 0, "ValueError", "bad"),
         ("3", "p", "s", "d", "b", datetime(2025, 1, 2), None, "partial", 1, 1, 0, None, None)],
        "run_id string, pipeline_name string, source_system string, dataset string, batch_id string, started_at timestamp, finished_at timestamp, status string, records_extracted bigint, records_processed bigint, records_rejected bigint, error_type string, error_message string")
    s = audit.run_summary(runs).first()
    assert (s.total_runs, s.successful_runs, s.failed_runs, s.total_records_extracted, s.last_run_at) == (3, 1, 1, 16, datetime(2025, 1, 2))
    assert audit.failed_runs(runs).first().error_type == "ValueError"
    assert [r.run_id for r in audit.recent_runs(runs, 2).collect()] == ["3", "2"]
    assert audit.processed_total(runs, 7).first().records_processed == 9
    assert audit.processed_total(runs.limit(0), 7).first().records_processed == 7
