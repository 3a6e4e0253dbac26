from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.functions import casting, dates, lossless, money, text
from stratalake.operators import rules
from stratalake.sources.specs import TYPED_SPECS


def test_typed_columns_become_null_when_they_do_not_parse(spark):
    raw = spark.createDataFrame(
        [("1", "19.90", "2025-01-15", "true", "x"), ("12.7", "abc", "nope", "maybe", "y")],
        "id string, total string, day string, ok string, extra string",
    )
    schema = StructType.fromDDL("id int, total decimal(12,2), day date, ok boolean, absent string")
    out = casting.typed(raw, schema)
    assert out.columns == ["id", "total", "day", "ok", "extra"]
    assert rows_of(out, "*") == [
        (1, Decimal("19.90"), date(2025, 1, 15), True, "x"), (None, None, None, None, "y"),
    ]
    failures = raw.select(casting.cast_failures(raw, schema).alias("f")).collect()
    assert failures[0].f == [] and len(failures[1].f) == 4


@pytest.mark.parametrize(
    "dataset, row, expected",
    [
        ("customers", {"customer_id": 1, "email": "invalid-email-format"}, "Invalid email format"),
        ("customers", {"customer_id": 1, "email": "a.b+c@x-y.org"}, None),
        ("customers", {"customer_id": 1, "email": "a@b.c"}, "Invalid email format"),
        ("products", {"product_id": 1, "unit_price": -1, "unit_cost": -2}, "Negative unit_price; Negative unit_cost"),
        ("orders", {"order_id": 1, "total_amount": -5, "status": "lost"}, "Negative total_amount; Invalid order status"),
        ("orders", {"order_id": 1, "total_amount": 0, "status": "returned"}, None),
        ("order_items", {"order_item_id": 1, "quantity": 0, "unit_price": -1, "discount_pct": 101},
         "Non-positive quantity; Negative unit_price; Discount pct out of 0-100 range"),
        ("order_items", {"order_item_id": 1, "quantity": 1, "discount_pct": 100}, None),
        ("payments", {"payment_id": 1, "amount": -1, "payment_status": "gone"}, "Negative payment amount; Invalid payment status"),
        ("reviews", {"review_id": 1, "rating": 6}, "Rating outside 1-5 range"),
        ("reviews", {"review_id": 1, "rating": 0}, "Rating outside 1-5 range"),
    ],
)
def test_rules(spark, dataset, row, expected):
    keys = TYPED_SPECS[dataset].primary_key
    df = spark.createDataFrame([row])
    good, bad = rules.split(df, rules.rules_for(dataset, keys))
    if expected is None:
        assert good.count() == 1 and bad.count() == 0
    else:
        assert good.count() == 0
        assert bad.first().quarantine_reason == expected


def test_null_key_and_null_predicates(spark):
    df = spark.createDataFrame([(None, 3), (1, None)], "review_id string, rating int")
    rs = rules.rules_for("reviews", ["review_id"])
    good, bad = rules.split(df, rs)
    assert rows_of(good, "review_id") == [("1",)]
    assert bad.first().quarantine_reason == "Primary key review_id is null"
    _, strict = rules.split(df, rs, on_null="fail")
    assert strict.count() == 2
    with pytest.raises(ValueError):
        rules.split(df, rs, on_null="maybe")


def test_source_rules_are_optional(spark):
    df = spark.createDataFrame([(1, "completed", None, "cash")], "payment_id int, payment_status string, paid_at timestamp, payment_method string")
    assert rules.split(df, rules.rules_for("payments"))[1].count() == 0
    bad = rules.split(df, rules.rules_for("payments", with_source_rules=True))[1]
    assert bad.first().quarantine_reason == "Completed payment without paid_at; Invalid payment method"


def test_quarantine_of_nothing_keeps_the_schema(spark):
    df = spark.createDataFrame([(1,)], "a int")
    good, bad = rules.split(df, rules.rules_for("countries"))
    assert good.count() == 1 and bad.count() == 0
    assert bad.columns == ["a", "quarantine_reason", "quarantined_at"]


def test_money_is_exact(spark):
    df = spark.createDataFrame([(2, Decimal("100.00"), Decimal("10.00")), (3, Decimal("0.35"), None)], "q int, p decimal(12,2), d decimal(5,2)")
    amount = money.line_amount(F.col("q"), F.col("p"), F.col("d"))
    assert [r[0] for r in df.select(money.to_money(amount)).collect()] == [Decimal("180.00"), Decimal("1.05")]
    rate = F.lit("1.10").cast("decimal(12,6)")
    assert df.select(money.to_money(amount * rate)).first()[0] == Decimal("198.00")
    assert df.select(money.rate_to_usd(F.lit("150").cast("decimal(18,6)"))).first()[0] == Decimal("0.0066666667")
    assert df.select(money.rate_to_usd(F.lit("0").cast("decimal(18,6)"))).first()[0] is None


@pytest.mark.parametrize("cents, qty, disc, expected", [(999, 1, 5, 949), (1, 1, 50, 1), (333, 3, 15, 849), (10**15, 4, 0, 4 * 10**15)])
def test_line_cents_round_half_up(spark, cents, qty, disc, expected):
    df = spark.createDataFrame([(cents, qty, disc)], "c bigint, q int, d int")
    assert df.select(money.line_cents(F.col("c"), F.col("q"), F.col("d"))).first()[0] == expected == (cents * qty * (100 - disc) + 50) // 100


def test_keys_and_text(spark):
    df = spark.createDataFrame([(date(2025, 1, 5), " Müller-Straße No. 7 ", " User@X.ORG ")], "d date, s string, e string")
    row = df.select(
        dates.date_key(F.col("d")).alias("k"), dates.key_year(F.lit(20250105)).alias("y"), dates.key_month(F.lit(20251205)).alias("m"),
        text.slug(F.col("s")).alias("slug"), text.normal_email(F.col("e")).alias("email"),
    ).first()
    assert (row.k, row.y, row.m, row.email) == (20250105, 2025, 12, "user@x.org")
    assert row.slug == "mullerstraeno7"


def test_lossless_text(spark):
    df = spark.createDataFrame(
        [(Decimal("19.90"), datetime(2025, 1, 15, 10), datetime(2025, 1, 15, 10, 0, 0, 250000), date(2025, 1, 2), "Zoë", None)],
        "money decimal(12,2), ts timestamp, exact timestamp_ntz, day date, name string, nothing string",
    )
    assert tuple(lossless.lossless(df).first()) == (
        "19.90", "2025-01-15T10:00:00+00:00", "2025-01-15T10:00:00.250000+00:00", "2025-01-02", "Zoë", None)


def test_lossless_refuses_what_json_cannot_say(spark):
    with pytest.raises(lossless.UnsupportedValue):
        lossless.lossless(spark.createDataFrame([(bytearray(b"x"),)], "b binary"))
    nan = spark.createDataFrame([(float("nan"),)], "v double")
    with pytest.raises(Exception, match="NaN"):
        lossless.lossless(nan).collect()


@pytest.mark.parametrize("target", ["int", "bigint", "decimal(14,2)", "boolean", "date", "timestamp"])
def test_the_guard_turns_nothing_away_that_the_cast_reads(spark, target):
    texts = ["1", " 1 ", "\t-7\n", "+3", "12.7", "12.", ".5", "1e2", "-1E-2", "1 2", "", " ", "abc", "1-", "--1", "99999999999", "1e40",
             "TRUE", " f ", "Yes", "no", "on", "0", "2025-01-15", "2025-1-5", "2025-01-15 10:00:00", "2025-01-15T10:00:00.5+02:00", "\x7f4", "٣", None]
    raw = spark.createDataFrame([(t,) for t in texts], "v string")
    schema = StructType.fromDDL(f"v {target}")
    guarded = [r[0] for r in casting.typed(raw, schema).collect()]
    plain = [r[0] for r in raw.select(F.col("v").try_cast(target)).collect()]
    assert guarded == plain


def test_slug_folds_many_rare_letters_by_ranges(spark):
    """Long texts with ligatures, marks and letters that don't decompose; the class of rare letters is a list of ranges."""
    many = "\u00c9t\u00e9 \ufb03 \u2167 \u338f, \u00df_\u4e2d-" * 2000
    row = spark.createDataFrame([(many, "\ufb01", None, "")], "a string, b string, c string, d string").select(
        *[text.slug(F.col(n)).alias(n) for n in "abcd"]).first()
    assert (row.a, row.b, row.c, row.d) == ("eteffiviiikg" * 2000, "fi", None, "")
    assert text._class_of("cab\ufb01") == "[\\x{61}-\\x{63}\\x{FB01}-\\x{FB01}]"


def test_narrowing_rounds_as_try_cast_does_without_its_exceptions(spark):
    edge = ["999999999999.994999", "999999999999.995000", "-999999999999.994999", "-999999999999.995000", "0.005000", "-0.004999", "9999999999999999999.999999", None]
    df = spark.createDataFrame([(None if x is None else Decimal(x),) for x in edge], "x decimal(25,6)")
    for precision, scale in (money.MONEY, (19, 6), (25, 6)):
        both = df.select(money.narrowed(F.col("x"), precision, scale).alias("a"), F.col("x").try_cast(f"decimal({precision},{scale})").alias("b"))
        assert [r.a for r in both.collect()] == [r.b for r in both.collect()]
    # try_cast throws and catches an exception for each amount that is too large
    lines = df.select(F.lit(1).alias("q"), F.lit("1.00").cast("decimal(12,2)").alias("p"), F.lit("0").cast("decimal(5,2)").alias("d"), "x")
    local = money.line_amount(F.col("q"), F.col("p"), F.col("d"))
    plan = lines.select(money.to_money(local + F.col("x")), money.converted(local, F.lit("2").cast(money.RATE)))._jdf.queryExecution().toString()
    assert "try_cast" not in plan.lower()
