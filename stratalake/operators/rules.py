"""Row validation: each rule is a predicate and the reason given when it does not hold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that decide which rows are valid.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
ORDER_STATUSES = ("pending", "paid", "shipped", "delivered", "cancelled", "returned")
PAYMENT_STATUSES = ("pending", "completed", "failed", "refunded")
PAYMENT_METHODS = ("card", "paypal", "bank_transfer", "apple_pay", "gift_card")
SEGMENTS = ("consumer", "small_business", "enterprise")


@dataclass(frozen=True)
class Rule:
    """``holds`` is a SQL predicate over ``columns``; the rule is skipped if one is absent."""

    message: str
    holds: str
    columns: tuple[str, ...]

    @property
    def predicate(self) -> Column:
        return F.expr(self.holds)


def _one_of(column: str, values: Sequence[str]) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


def key_rules(keys: Sequence[str]) -> tuple[Rule, ...]:
    return tuple(Rule(f"Primary key {k} is null", f"{k} is not null", (k,)) for k in keys)


# What each dataset's rows must satisfy on their way into the typed layer. Bounds and messages are
# fixed values.
DATASET_RULES: dict[str, tuple[Rule, ...]] = {
    "customers": (
        Rule("Invalid email format", f"email rlike r'{EMAIL_PATTERN}'", ("email",)),
        Rule("updated_at prior to created_at", "updated_at >= created_at", ("created_at", "updated_at")),
    ),
    "products": (
        Rule("Negative unit_price", "unit_price >= 0", ("unit_price",)),
        Rule("Negative unit_cost", "unit_cost >= 0", ("unit_cost",)),
    ),
    "orders": (
        Rule("Negative total_amount", "total_amount >= 0", ("total_amount",)),
        Rule("Invalid order status", _one_of("status", ORDER_STATUSES), ("status",)),
    ),
    "order_items": (
        Rule("Non-positive quantity", "quantity > 0", ("quantity",)),
        Rule("Negative unit_price", "unit_price >= 0", ("unit_price",)),
        Rule("Discount pct out of 0-100 range", "discount_pct between 0 and 100", ("discount_pct",)),
    ),
    "payments": (
        Rule("Negative payment amount", "amount >= 0", ("amount",)),
        Rule("Invalid payment status", _one_of("payment_status", PAYMENT_STATUSES), ("payment_status",)),
    ),
    "reviews": (Rule("Rating outside 1-5 range", "rating between 1 and 5", ("rating",)),),
}

# Constraints the source database enforces itself; asked for with ``with_source_rules``.
SOURCE_RULES: dict[str, tuple[Rule, ...]] = {
    "customers": (Rule("Invalid segment", _one_of("segment", SEGMENTS), ("segment",)),),
    "payments": (
        Rule(
            "Completed payment without paid_at",
            "payment_status <> 'completed' or paid_at is not null",
            ("payment_status", "paid_at"),
        ),
        Rule("Invalid payment method", _one_of("payment_method", PAYMENT_METHODS), ("payment_method",)),
    ),
}


def rules_for(dataset: str, keys: Sequence[str] = (), with_source_rules: bool = False) -> tuple[Rule, ...]:
    extra = SOURCE_RULES.get(dataset, ()) if with_source_rules else ()
    return key_rules(keys) + DATASET_RULES.get(dataset, ()) + extra


def reasons(df: DataFrame, rules: Sequence[Rule], on_null: str = "pass") -> Column:
    """``array<string>`` of the reasons a row is refused for, in rule order.

    A predicate that is NULL lets the row pass; ``on_null="fail"`` refuses it.
    """
    if on_null not in ("pass", "fail"):
        raise ValueError(f"on_null must be 'pass' or 'fail', not {on_null!r}")
    failed = []
    for rule in rules:
        if all(c in df.columns for c in rule.columns):
            verdict = F.coalesce(rule.predicate, F.lit(on_null == "pass"))
            failed.append(F.when(~verdict, F.lit(rule.message)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def with_reasons(df: DataFrame, rules: Sequence[Rule], on_null: str = "pass") -> DataFrame:
    return df.withColumn("_reasons", reasons(df, rules, on_null))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("_reasons") == 0).drop("_reasons")


def refused(judged: DataFrame, at: Column | None = None) -> DataFrame:
    return (
        judged.filter(F.size("_reasons") > 0)
        .withColumn("quarantine_reason", F.array_join("_reasons", "; "))
        .withColumn("quarantined_at", F.current_timestamp() if at is None else at)
        .drop("_reasons")
    )


def split(df: DataFrame, rules: Sequence[Rule], on_null: str = "pass", at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, refused rows with ``quarantine_reason`` and ``quarantined_at``)."""
    judged = with_reasons(df, rules, on_null)
    return accepted(judged), refused(judged, at)
