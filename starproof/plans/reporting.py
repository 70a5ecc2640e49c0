"""Delivered-revenue reporting: line annex, monthly and per-salesperson totals, KPIs, series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starproof import specs
from starproof.functions import measures as m
from starproof.functions.text import favourable
from starproof.operators.facts import delivered_orders
from starproof.operators.ranking import rows_within_share


def reporting_lines(star: dict[str, DataFrame], delivered: Sequence[str] = specs.DELIVERED) -> DataFrame:
    """Delivered lines: date, month, salesperson name, amount. An unreadable price
    leaves the line in place with a NULL amount; an unknown salesperson stays as NULL."""
    orders, lines = delivered_orders(star, delivered), star["fact_line"]
    reps = star["dim_salesperson"].select("salesperson_code", F.col("name").alias("salesperson"))
    header, body = ["order_id", "order_date"], ["order_id", "quantity", "unit_price", "discount_rate"]
    if "salesperson_code" in orders.columns:
        orders = orders.select(*header, "salesperson_code").join(reps, "salesperson_code", "left")
        lines = lines.select(*body)
    else:
        orders = orders.select(*header)
        lines = lines.select(*body, "salesperson_code").join(reps, "salesperson_code", "left")
    amount = m.line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_rate"))
    return lines.join(orders, "order_id").select(
        F.col("order_date").alias("date"), m.month_key(F.col("order_date")).alias("month"), "salesperson",
        amount.alias("amount"),
    )


def delivered_revenue(lines: DataFrame, orders: DataFrame, delivered: Sequence[str] = specs.DELIVERED) -> DataFrame:
    """One row: revenue of delivered lines that have a price, 0 when there is none. Lines are summed by order before they
    meet the orders, so an order's lines that lie together cost one shuffled row."""
    kept = orders.filter(F.col("status").isin(*delivered)).select("order_id")
    priced = lines.filter(F.col("unit_price").isNotNull())
    amount = m.line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_rate"))
    per_order = priced.groupBy("order_id").agg(F.sum(amount).alias("amount"))
    return per_order.join(kept, "order_id").agg(
        m.as_double(m.sum_or_zero(F.col("amount"))).alias("revenue")
    )


def _revenue_by(lines: DataFrame, axis: str) -> DataFrame:
    return lines.filter(F.col(axis).isNotNull()).groupBy(axis).agg(
        m.as_double(m.sum_or_zero(F.col("amount"))).alias("revenue")
    )


def revenue_by_month(lines: DataFrame) -> DataFrame:
    return _revenue_by(lines, "month").orderBy("month")


def revenue_by_salesperson(lines: DataFrame) -> DataFrame:
    return _revenue_by(lines, "salesperson").orderBy(F.col("revenue").desc(), "salesperson")


def reporting_views(
    star: dict[str, DataFrame], delivered: Sequence[str] = specs.DELIVERED
) -> tuple[DataFrame, DataFrame, DataFrame]:
    lines = reporting_lines(star, delivered)
    return lines, revenue_by_month(lines), revenue_by_salesperson(lines)


def _months(*order):
    """Order over all months. Months are calendar-bounded (twelve a year), so this
    one-partition window sees a few hundred aggregated rows, never fact rows."""
    return Window.partitionBy(F.lit(0)).orderBy(*(order or ("month",)))


def _change(current, previous):
    return F.try_divide((current - previous) * 100.0, F.abs(previous))


def cumulative_revenue(by_month: DataFrame) -> DataFrame:
    running = F.sum(F.col("revenue").cast("decimal(38,6)")).over(
        _months().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return by_month.select("month", "revenue", m.as_double(running).alias("cumulative_revenue")).orderBy("month")


def month_over_month(by_month: DataFrame) -> DataFrame:
    """Variation to the previous month; the first month and zero previous months leave."""
    with_previous = by_month.withColumn("previous", F.lag("revenue").over(_months()))
    return (
        with_previous.filter(F.col("previous") != 0)
        .select("month", _change(F.col("revenue"), F.col("previous")).alias("variation_pct"))
        .withColumn("flag", favourable(F.col("variation_pct")))
        .orderBy("month")
    )


def top_salespeople(by_salesperson: DataFrame, n: int = 10) -> DataFrame:
    return by_salesperson.orderBy(F.col("revenue").desc(), "salesperson").limit(n)


def average_basket(lines: DataFrame) -> DataFrame:
    """Revenue per valid line and month; a month without a valid line divides by one."""
    per_month = lines.filter(F.col("month").isNotNull()).groupBy("month").agg(
        m.as_double(m.sum_or_zero(F.col("amount"))).alias("revenue"), F.count("amount").alias("n")
    )
    divisor = F.greatest(F.col("n"), F.lit(1))
    return per_month.select(
        "month", divisor.alias("valid_lines"), (F.col("revenue") / divisor).alias("average_basket")
    ).orderBy("month")


def basket_of(by_month: DataFrame, valid_lines: DataFrame) -> DataFrame:
    """The same from a monthly table and separate line counts (month, n): unknown counts as one."""
    divisor = F.greatest(F.coalesce(F.col("n"), F.lit(1)), F.lit(1))
    return by_month.join(valid_lines, "month", "left").select(
        "month", divisor.cast("bigint").alias("valid_lines"), (F.col("revenue") / divisor).alias("average_basket")
    ).orderBy("month")


def dashboard_kpis(lines: DataFrame) -> DataFrame:
    """Thirteen indicators in one row; ties go to the earliest month and first name.

    Months, salespeople and the grand total come from one pass over the lines
    (grouping sets); the indicators are one aggregate over those few rows.
    """
    month, rep = F.col("month"), F.col("salesperson")
    sets = lines.groupingSets([[month], [rep], []], month, rep).agg(
        F.grouping_id("month", "salesperson").alias("_set"),
        m.as_double(m.sum_or_zero(F.col("amount"))).alias("revenue"), F.count("amount").alias("n"),
    )
    revenue = F.col("revenue")
    of_month, of_rep, of_all = (
        (F.col("_set") == 1) & month.isNotNull(), (F.col("_set") == 2) & rep.isNotNull(), F.col("_set") == 3,
    )
    pair = F.struct("month", "revenue")
    largest, smallest = F.struct((-revenue).alias("r"), month), F.struct(revenue, month)
    # a calendar-bounded list: the two latest months are its last elements
    history = F.array_sort(F.collect_list(F.when(of_month, pair)))
    framed = sets.agg(
        F.max(F.when(of_all, revenue)).alias("total_revenue"),
        F.max(F.when(of_all, F.col("n"))).alias("valid_line_count"),
        F.count_if(of_month).alias("active_months"),
        F.min_by(pair, F.when(of_month, largest)).alias("best"),
        F.min_by(pair, F.when(of_month, smallest)).alias("worst"),
        history.alias("history"),
        F.count_if(of_rep).alias("active_salespeople"),
        F.min_by(F.struct("salesperson", "revenue"), F.when(of_rep, F.struct((-revenue).alias("r"), rep))).alias("top"),
    )
    last = F.try_element_at("history", F.lit(-1))["revenue"]
    previous = F.try_element_at("history", F.lit(-2))["revenue"]

    def per(count: str):
        return F.coalesce(F.try_divide("total_revenue", count), F.lit(0.0))

    return framed.select(
        "total_revenue", "valid_line_count",
        per("valid_line_count").alias("average_basket"), per("active_months").alias("monthly_avg_revenue"),
        "active_months",
        F.col("best.month").alias("best_month"), F.col("best.revenue").alias("best_month_revenue"),
        F.col("worst.month").alias("worst_month"), F.col("worst.revenue").alias("worst_month_revenue"),
        _change(last, previous).alias("last_mom_growth_pct"),
        F.col("top.salesperson").alias("top_salesperson"), F.col("top.revenue").alias("top_salesperson_revenue"),
        "active_salespeople",
    )


def best_and_worst_month(by_month: DataFrame) -> DataFrame:
    revenue = F.col("revenue")
    pair = F.struct("month", "revenue")
    return by_month.agg(
        F.min_by(pair, F.struct((-revenue).alias("r"), F.col("month"))).alias("best"),
        F.min_by(pair, F.struct(revenue, F.col("month"))).alias("worst"),
    ).select(
        F.col("best.month").alias("best_month"), F.col("best.revenue").alias("best_month_revenue"),
        F.col("worst.month").alias("worst_month"), F.col("worst.revenue").alias("worst_month_revenue"),
    )


def customers_for_share(pareto: DataFrame, share: float = 80.0) -> DataFrame:
    """How many customers make ``share`` % of revenue (at least one), and their part of all."""
    counted = pareto.agg(
        F.greatest(F.count_if(F.col("cumulative_pct") <= share), F.lit(1)).alias("customers_for_share"),
        F.count(F.lit(1)).alias("customers"),
    )
    return counted.withColumn("customers_pct", m.pct(F.col("customers_for_share"), F.col("customers")))


def customers_for_mark(base: DataFrame, share: float = 80.0) -> DataFrame:
    """``customers_for_share`` straight from the lines of ``base`` (customer_code, revenue), without ranking the customers."""
    per_customer = base.groupBy("customer_code").agg(F.sum("revenue").alias("revenue"))
    rows, customers = rows_within_share(per_customer, "revenue", share)
    counted = base.sparkSession.createDataFrame([(max(rows, 1), customers)], "customers_for_share bigint, customers bigint")
    return counted.withColumn("customers_pct", m.pct(F.col("customers_for_share"), F.col("customers")))


def oldest_customers(customers: DataFrame, segment: str, n: int) -> DataFrame:
    """The ``n`` longest-standing customers of a segment by first order date."""
    return customers.filter(F.col("segment") == segment).orderBy(
        F.col("first_order_date").asc_nulls_last(), "customer_code"
    ).limit(n)
