"""Ratios and conditional aggregates with the NULL rules the reports rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL when the denominator is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """Share in percent, scaled before dividing."""
    return F.round(F.try_divide(num * F.lit(100.0), den.cast("double")), digits)


def per_mille(revenue: Column, impressions: Column, digits: int = 4) -> Column:
    """Effective revenue per thousand impressions."""
    return F.round(ratio(revenue, impressions) * F.lit(1000.0), digits)


def flag(cond: Column) -> Column:
    """1 where any row of the group meets ``cond``, else 0."""
    return F.max(F.when(cond, 1).otherwise(0))


def sum_where(cond: Column, value: Column) -> Column:
    """Sum over matching rows; other rows count as 0.0."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0.0)))
