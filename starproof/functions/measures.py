"""Money and ratio expressions. Revenue and margin are computed here, never stored.

Line amounts are decimals: their sums do not depend on how rows are split over
tasks, so a rerun on another cluster gives the same cent. Ratios are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starproof import specs


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def year_key(d: Column) -> Column:
    return F.date_format(d, "yyyy")


def line_revenue(quantity: Column, unit_price: Column, discount_rate: Column) -> Column:
    """quantity x price x (1 - discount); NULL when any part is missing or the product has too many digits."""
    return F.try_multiply(F.try_multiply(quantity, unit_price), 1 - discount_rate).try_cast(specs.LINE_MONEY)


def line_cost(quantity: Column, unit_cost: Column) -> Column:
    return F.try_multiply(quantity, unit_cost).try_cast(specs.LINE_MONEY)


def as_double(c: Column) -> Column:
    return c.cast("double")


def pct(part: Column, whole: Column) -> Column:
    """100 x part / whole in double, NULL on a zero or missing whole."""
    return F.try_divide(F.lit(100.0) * as_double(part), as_double(whole))


def variance(actual: Column, budget: Column) -> Column:
    """actual - budget: no actual counts as zero, no budget leaves NULL."""
    return F.coalesce(actual, F.lit(0)) - budget


def variance_pct(actual: Column, budget: Column) -> Column:
    return pct(variance(actual, budget), budget)


def discount_band(rate: Column) -> Column:
    """Four bands. A missing rate lands in the last one, like any unmatched value."""
    none, low, middle, high = specs.DISCOUNT_BANDS
    return (
        F.when(rate == 0, none)
        .when(rate <= F.lit("0.05").cast("decimal(3,2)"), low)
        .when(rate <= F.lit("0.10").cast("decimal(3,2)"), middle)
        .otherwise(high)
    )


def sum_or_zero(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))
