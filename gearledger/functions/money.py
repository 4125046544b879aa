"""Exact money arithmetic: sums stay decimal, ratios are rounded half up through a decimal."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(11,2)"
TOTAL = "decimal(28,2)"
RATIO = "decimal(18,2)"

GOODS_TAX = 1.13
SERVICE_TAX = 1.06


def zero_if_null(c: Column | str, dtype: str = TOTAL) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast(dtype), F.lit(0).cast(dtype))


def cents(c: Column | str) -> Column:
    """Two-place amount as a whole number of cents. Row-level sums add these: they are as exact
    as decimals and several times cheaper, and an overflow beyond 9e16 units is an error."""
    c = F.col(c) if isinstance(c, str) else c
    return (c * 100).cast("bigint")


def from_cents(c: Column) -> Column:
    return (c.cast("decimal(26,0)") * F.lit(Decimal("0.01"))).cast(TOTAL)


def cents_if(condition: Column, c: Column) -> Column:
    """Money total of a cents column over the rows that meet a condition; zero without any."""
    return from_cents(F.coalesce(F.sum(F.when(condition, c)), F.lit(0)))


def total(c: Column | str) -> Column:
    """Sum that is zero, not null, for a group without values."""
    return zero_if_null(F.sum(c))


def total_if(condition: Column, c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return total(F.when(condition, c))


def count_sum(condition: Column, n: str = "n") -> Column:
    """Sum of pre-aggregated counts."""
    return F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0).cast("long"))


def round2(c: Column) -> Column:
    """Round half up to two places. The decimal step makes the result independent of how a
    double is printed, so that it can be checked on another engine."""
    return F.round(c.cast("decimal(28,6)"), 2).cast(RATIO)


def ex_tax(amount: Column, rate: float) -> Column:
    """Amount without the tax contained in it."""
    return round2(amount.cast("double") / F.lit(rate))


def quotient(a: Column, b: Column) -> Column:
    """a / b as a double; null when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))
