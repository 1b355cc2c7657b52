"""Numeric helpers on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIVIDE_BY_ZERO = "Cannot divide by zero"


def money(col: Column, scale: int = 2, precision: int = 38) -> Column:
    """Exact decimal view of an amount with ``scale`` places; a value that is no number becomes null."""
    return col.try_cast(f"decimal({precision},{scale})")


def lost_amounts(col: Column, scale: int = 2, precision: int = 38) -> Column:
    """Number of values that are numbers but do not fit ``money``, to be counted beside a sum."""
    return F.count_if(col.try_cast("double").isNotNull() & money(col, scale, precision).isNull())


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, or null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def divide_or_message(numerator: Column, denominator: Column) -> Column:
    """Quotient as text, or a readable message when the denominator is zero."""
    quotient = safe_ratio(numerator, denominator)
    return F.when(denominator == 0, F.lit(DIVIDE_BY_ZERO)).otherwise(quotient.cast("string"))


def parse_number(text: Column) -> Column:
    """Number in ``text``, or null when it is none."""
    return text.try_cast("double")


def total_with_tax(subtotal: Column, rate: float | str) -> Column:
    """Tax applied once to the subtotal, two decimals."""
    return F.round(subtotal * (1 + F.lit(rate).cast("decimal(9,4)")), 2)
