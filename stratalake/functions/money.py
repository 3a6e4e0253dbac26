"""Exact decimal money: one rounding, at the end.

The operand precisions keep every product inside 38 digits, so nothing is rounded on the way: a local
amount has 19 digits before the point, and at the smallest rate, 0.000001, such an amount
is already too large for a money column. Narrowing compares with the column's bound first: an amount too large for
its column becomes NULL, which ``operators.star.unfit_amounts`` counts and ``plans.daily`` refuses after gold is built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = (14, 2)
RATE = "decimal(12,6)"
#: An unrounded amount that can still be multiplied by a rate without losing a digit.
EXACT = (25, 6)
WIDE_RATE = "decimal(18,10)"


def _decimal(value: str, as_type: str) -> Column:
    return F.lit(value).cast(as_type)


def discount_or_zero(discount_pct: Column) -> Column:
    return F.coalesce(discount_pct.cast("decimal(5,2)"), _decimal("0", "decimal(5,2)"))


def narrowed(amount: Column, precision: int, scale: int) -> Column:
    """``amount`` as a decimal of this type, rounded half up; NULL where it is too large.

    The same as ``try_cast``, which throws and catches an exception for each row that is too large.
    """
    unfit = f"{'9' * (precision - scale)}.{'9' * scale}5"  # what rounding would carry into one digit more
    return F.when(F.abs(amount) < _decimal(unfit, f"decimal({precision + 1},{scale + 1})"), amount.cast(f"decimal({precision},{scale})"))


def line_amount(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """quantity x price less the discount per cent, unrounded."""
    gross = quantity.cast("decimal(10,0)") * unit_price.cast("decimal(12,2)")
    kept_pct = _decimal("100", "decimal(5,2)") - discount_or_zero(discount_pct)
    return narrowed(gross * (kept_pct * _decimal("0.01", "decimal(3,2)")), *EXACT)


def line_cents(cents: Column, quantity: Column, discount_pct: Column) -> Column:
    """Line total in whole cents, half a cent rounding up."""
    hundredths = cents * quantity * (F.lit(100) - discount_pct)
    return F.call_function("div", (hundredths + F.lit(50)).cast("bigint"), F.lit(100).cast("bigint"))


def to_money(amount: Column) -> Column:
    return narrowed(amount, *MONEY)


def narrow_product(amount: Column, rate: Column) -> Column:
    """An unrounded amount below 10**13 times a rate of up to 18 digits, exactly; NULL for a larger amount."""
    return narrowed(amount, 19, 6) * rate


def converted(amount: Column, rate: Column, product: Column | None = None) -> Column:
    """An unrounded amount times a rate, rounded once to money.

    Below 10**13 the product with a rate of up to 18 digits is exact. Above, a rate of more than 12 digits
    leaves ten decimal places of the product before it is rounded. ``product``: a column that holds :func:`narrow_product`.
    """
    return F.coalesce(to_money(narrow_product(amount, rate) if product is None else product), to_money(amount * rate))


def rate_to_usd(units_per_usd: Column) -> Column:
    """USD per unit from a quote in units per USD; NULL for a zero or missing quote."""
    return F.try_divide(_decimal("1", "decimal(18,10)"), units_per_usd.cast("decimal(18,6)")).cast(WIDE_RATE)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0))
