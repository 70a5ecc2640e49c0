"""One-row cleaning reports. Each report is a single aggregation over its source."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starproof import specs
from starproof.functions import measures as m
from starproof.operators.reshape import KEYS, is_subtotal


def _rows() -> Column:
    return F.count(F.lit(1))


def _missing(name: str) -> Column:
    return F.count_if(F.col(name).isNull())


def _overflows() -> Column:
    """All parts of the amount are readable but it has too many digits, hence NULL."""
    parts = [F.col(c) for c in ("quantity", "unit_price", "discount_rate")]
    return parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull() & m.line_revenue(*parts).isNull()


def sales_metrics() -> list[Column]:
    """What is counted of ``audit_sales`` output; sums only, so they can be observed while it is written."""
    return [
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("rows_raw"), _rows().alias("rows_after_dedup"),
        _missing("order_date").alias("invalid_dates"), _missing("unit_price").alias("invalid_amounts"),
        _missing("quantity").alias("invalid_quantities"), _missing("discount_rate").alias("invalid_discounts"),
        F.count_if(_overflows()).alias("overflowing_lines"),
    ]


def sales_report(counted: DataFrame, files_read: int | Column) -> DataFrame:
    """The cleaning report from one row of ``sales_metrics``."""
    files = files_read if isinstance(files_read, Column) else F.lit(files_read).cast("bigint")
    return counted.select(
        files.alias("files_read"), "rows_raw", "rows_after_dedup",
        (F.col("rows_raw") - F.col("rows_after_dedup")).alias("duplicates_removed"), "invalid_dates", "invalid_amounts",
        (F.col("rows_after_dedup") - F.col("invalid_dates")).alias("rows_kept"), "invalid_quantities", "invalid_discounts",
        "overflowing_lines",
    )


def sales_counters(audited: DataFrame, files_read: int | Column) -> DataFrame:
    """Counters of ``audit_sales`` output: raw rows, copies, unreadable values, overflows, kept."""
    return sales_report(audited.agg(*sales_metrics()), files_read)


def overflowing_lines(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count_if(_overflows()).alias("overflowing_lines"))


def product_counters(products: DataFrame) -> DataFrame:
    return products.agg(
        _rows().alias("rows"),
        F.countDistinct("_raw_category").alias("categories_raw"),
        F.countDistinct("category").alias("categories_canonical"),
        F.count_if(~F.col("category").eqNullSafe(F.col("_raw_category"))).alias("products_recategorised"),
    )


def customer_counters(customers: DataFrame, segments: Iterable[str] = specs.SEGMENTS) -> DataFrame:
    known = F.coalesce(F.col("segment").isin(*segments), F.lit(False))
    return customers.agg(
        _rows().alias("rows"),
        _missing("first_order_date").alias("invalid_first_order_dates"),
        F.count_if(~F.col("segment").eqNullSafe(F.col("_raw_segment"))).alias("segments_normalised"),
        F.count_if(~known).alias("invalid_segments"),
        F.countDistinct("segment").alias("distinct_segments"),
    )


def salesperson_counters(salespeople: DataFrame) -> DataFrame:
    per_code = salespeople.groupBy("salesperson_code").agg(
        _rows().alias("n"), _missing("hire_date").alias("bad")
    )
    return per_code.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_hire_dates"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_codes"),
    )


def budget_counters(budget: DataFrame, sheet_rows: DataFrame) -> DataFrame:
    """Grid completeness of the long budget, with the subtotal rows that were dropped."""
    per_key = budget.groupBy(*KEYS).agg(
        _rows().alias("n"),
        F.count_if(F.col("budget_revenue").isNull() | F.col("budget_margin").isNull()).alias("bad"),
    )
    dropped = sheet_rows.agg(
        F.struct(
            F.countDistinct("file").alias("files"), F.count_if(is_subtotal()).alias("subtotals")
        ).alias("s")
    ).scalar()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.countDistinct("region_name").alias("regions"),
        F.countDistinct("category").alias("categories"),
        F.countDistinct("period").alias("periods"),
        F.coalesce(F.sum(F.when(is_subtotal(), F.col("n"))), F.lit(0)).alias("leaked_subtotals"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("missing_amounts"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"),
    ).withColumn("_sheets", dropped).select(
        F.col("_sheets.files").alias("files_read"), "rows", "regions", "categories", "periods",
        F.col("_sheets.subtotals").alias("subtotal_rows_dropped"), "leaked_subtotals", "missing_amounts", "duplicate_keys",
    )
