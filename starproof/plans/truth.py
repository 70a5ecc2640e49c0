"""The independent calculation path: figures from clean data, expectations, round trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starproof import specs
from starproof.functions import measures as m
from starproof.functions import parsing


def _money(c):
    return m.as_double(F.round(c, 2))


def _priced(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lines that carry the status of their order already are not joined with the orders again."""
    revenue = m.line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_rate"))
    detailed = lines.join(products.select("product_code", "category", "unit_cost"), "product_code")
    return (
        (detailed if "status" in lines.columns else detailed.join(orders, "order_id"))
        .withColumn("revenue", revenue)
        .withColumn("margin", revenue - m.line_cost(F.col("quantity"), F.col("unit_cost")))
    )


def business_truth(
    orders: DataFrame, lines: DataFrame, products: DataFrame, delivered: Sequence[str] = specs.DELIVERED
) -> DataFrame:
    """One row: delivered revenue, margin, rate, and the sizes of the clean tables."""
    sold = F.col("status").isin(*delivered)
    figures = _priced(lines, orders, products).agg(
        F.sum(F.when(sold, F.col("revenue"))).alias("revenue"), F.sum(F.when(sold, F.col("margin"))).alias("margin"),
        F.count_if(sold).alias("delivered_lines"),
    )
    return figures.select(
        _money(F.col("revenue")).alias("delivered_revenue"), _money(F.col("margin")).alias("delivered_margin"),
        F.round(m.pct(F.col("margin"), F.col("revenue")), 2).alias("margin_rate_pct"),
        orders.select(F.count(F.lit(1))).scalar().alias("orders"),
        lines.select(F.count(F.lit(1))).scalar().alias("lines"),
        "delivered_lines",
        products.select(F.countDistinct("category")).scalar().alias("categories"),
    )


def actual_by_period_region_category(
    orders: DataFrame, lines: DataFrame, products: DataFrame, customers: DataFrame,
    delivered: Sequence[str] = specs.DELIVERED,
) -> DataFrame:
    """Delivered revenue and margin on the budget grid (period x region x category)."""
    sold = orders.filter(F.col("status").isin(*delivered)).join(
        customers.select("customer_code", "region_code"), "customer_code"
    )
    return _priced(lines, sold, products).groupBy(m.month_key(F.col("order_date")).alias("period"), "region_code", "category").agg(
        m.as_double(F.sum("revenue")).alias("actual_revenue"), m.as_double(F.sum("margin")).alias("actual_margin")
    )


def revenue_lost(
    clean_lines: DataFrame, orders: DataFrame, unreadable: DataFrame | Column, delivered: Sequence[str] = specs.DELIVERED
) -> DataFrame:
    """True revenue of delivered lines whose exported amount cannot be read.

    ``unreadable`` holds the (order_id, line_id) keys without a usable price, or is a condition on the lines. Lines that
    carry the status of their order are not looked up in the orders.
    """
    sold = F.col("status").isin(*delivered)
    revenue = m.line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_rate"))
    if isinstance(unreadable, Column):
        hit = clean_lines.filter(unreadable)
    else:
        hit = clean_lines.join(unreadable.select("order_id", "line_id").distinct(), ["order_id", "line_id"], "left_semi")
    if "status" in clean_lines.columns:
        hit = hit.filter(sold)
    else:
        hit = hit.join(orders.filter(sold).select("order_id"), "order_id", "left_semi")
    return hit.agg(
        F.count(F.lit(1)).alias("lost_lines"), m.as_double(m.sum_or_zero(revenue)).alias("lost_revenue")
    )


def expectations(truth: DataFrame, lost: DataFrame, invalid_dates: DataFrame, invalid_amounts: DataFrame) -> DataFrame:
    """What cleaning must find: manifest keys, one row. Reconciled = true - lost revenue."""
    return truth.select(
        F.round(F.col("delivered_revenue") - lost.select("lost_revenue").scalar(), 2).alias("ca_reconcilie_attendu_eur"),
        F.col("lines").alias("nb_lignes_apres_dedup"),
        invalid_dates.scalar().alias("nb_dates_invalides_attendu"),
        invalid_amounts.scalar().alias("nb_montants_invalides_attendu"),
        F.col("categories").alias("nb_categories_apres_normalisation"),
    )


def round_trip(raw_sales: DataFrame, raw_products: DataFrame, expected: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """A second, minimal cleaning of the raw rows, compared with the expectations.

    Shares no operator with the pipeline beyond the scalar parsers: whole copies
    of a key collapse by aggregation and the revenue is summed straight from the
    denormalised rows. Expects one status, price and date per key.
    """
    one = raw_sales.groupBy("order_id", "line_id").agg(
        *[F.min(c).alias(c) for c in ("order_date", "quantity", "unit_price", "discount_rate", "status")]
    )
    price, date = parsing.french_amount(F.col("unit_price")), parsing.strict_date(F.col("order_date"), (parsing.FRENCH_DATE,))
    revenue = m.line_revenue(
        parsing.whole_number(F.col("quantity")), price, parsing.points_to_rate(F.col("discount_rate"))
    )
    counted = F.when(date.isNotNull() & F.col("status").isin(*specs.DELIVERED), revenue)
    got = one.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"), F.count_if(date.isNull()).alias("dates"),
            F.count_if(price.isNull()).alias("amounts"), m.as_double(m.sum_or_zero(counted)).alias("revenue"),
        )
    ).scalar()
    categories = raw_products.select(F.countDistinct(parsing.canonical_category(F.col("category")))).scalar()
    frame = expected.select(F.struct("*").alias("want"), got.alias("got"), categories.alias("categories"))
    pairs = [
        ("Rows after de-duplication", "got.rows", "want.nb_lignes_apres_dedup"),
        ("Invalid dates", "got.dates", "want.nb_dates_invalides_attendu"),
        ("Invalid amounts", "got.amounts", "want.nb_montants_invalides_attendu"),
        ("Canonical categories", "categories", "want.nb_categories_apres_normalisation"),
        ("Reconciled revenue (€)", "got.revenue", "want.ca_reconcilie_attendu_eur"),
    ]
    rows = [
        F.struct(
            F.lit(i).alias("check_no"), F.lit(label).alias("label"), F.col(a).cast("double").alias("obtained"),
            F.col(b).cast("double").alias("expected"),
            (F.abs(F.col(a).cast("double") - F.col(b).cast("double")) < (tolerance if "€" in label else 0.5)).alias("ok"),
        )
        for i, (label, a, b) in enumerate(pairs, start=1)
    ]
    return frame.select(F.inline(F.array(*rows)))
