"""The twelve finance views.

Every view is a function of a *base*: delivered lines or any roll-up of them
that still carries the view's axis (the measures are additive). Money leaves as
double, orderings are total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starproof import specs
from starproof.functions import measures as m
from starproof.operators.facts import NO_FILTERS, Filters, delivered_lines, rollup_sum
from starproof.operators.ranking import running_share, with_share
from starproof.sources.store import materialise

_RATE = "margin_rate_pct"
CUBE_AXES = ("month", "year", "category", "region", "segment", "discount_band")
CUSTOMER_AXES = ("customer_code", "company_name", "segment", "year")


def _with_rate(df: DataFrame) -> DataFrame:
    return df.withColumn(_RATE, m.pct(F.col("margin"), F.col("revenue")))


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: m.as_double(F.col(c)) for c in columns})


def _by_revenue(df: DataFrame, *ties: str) -> DataFrame:
    return df.orderBy(F.col("revenue").desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])


def _by_axis(base: DataFrame, axis: str, share: bool) -> DataFrame:
    totals = rollup_sum(base, [axis]).select(axis, "revenue", "margin")
    totals = _with_rate(with_share(totals) if share else totals)
    columns = [axis, "revenue", "margin", _RATE, *(["revenue_share_pct"] if share else [])]
    return _doubles(totals.select(*columns), "revenue", "margin")


def monthly(base: DataFrame) -> DataFrame:
    return _by_axis(base, "month", share=False).orderBy(F.col("month").asc_nulls_last())


def by_year(base: DataFrame) -> DataFrame:
    per_year = base.groupBy("year").agg(
        F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"),
        F.countDistinct("customer_code").alias("active_customers"),
    )
    return _doubles(_with_rate(per_year), "revenue", "margin").select(
        "year", "revenue", "margin", _RATE, "active_customers"
    ).orderBy(F.col("year").asc_nulls_last())


def by_category(base: DataFrame) -> DataFrame:
    return _by_revenue(_by_axis(base, "category", share=True), "category")


def by_salesperson(base: DataFrame) -> DataFrame:
    return _by_revenue(_by_axis(base, "salesperson", share=True), "salesperson")


def by_segment(base: DataFrame) -> DataFrame:
    per_segment = base.groupBy("segment").agg(
        F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"),
        F.countDistinct("customer_code").alias("customers"),
    )
    view = _with_rate(with_share(per_segment)).select(
        "segment", "revenue", "margin", _RATE, "customers", "revenue_share_pct"
    )
    return _by_revenue(_doubles(view, "revenue", "margin"), "segment")


def by_discount_band(base: DataFrame) -> DataFrame:
    bands = _with_rate(with_share(rollup_sum(base, ["discount_band"])))
    return (
        _doubles(bands, "revenue")
        .orderBy(F.col("min_discount").asc_nulls_last(), "discount_band")
        .select("discount_band", "line_count", "revenue", _RATE, "revenue_share_pct")
    )


def _planned(star: dict[str, DataFrame], filters: Filters) -> DataFrame:
    """Budget rows with their region name; only month and region filters apply to them."""
    regions = star["dim_region"].select("region_code", F.col("region_name").alias("region"))
    budget = star["fact_budget"].withColumnRenamed("period", "month")
    if filters.months:
        budget = budget.filter(F.col("month").isin(*filters.months))
    if filters.regions:
        regions = regions.filter(F.col("region").isin(*filters.regions))
    return budget.join(regions, "region_code")


def budget_by(
    base: DataFrame, star: dict[str, DataFrame], axis: str, filters: Filters = NO_FILTERS
) -> DataFrame:
    """Actual against budget along ``month`` or ``region``: full outer, budget missing stays NULL."""
    planned = _planned(star, filters).groupBy(axis).agg(
        F.sum("budget_revenue").alias("budget_revenue"), F.sum("budget_margin").alias("budget_margin"),
    )
    actual = rollup_sum(base, [axis]).select(axis, F.col("revenue").alias("actual_revenue"), F.col("margin").alias("actual_margin"))
    both = planned.join(actual, axis, "full_outer")

    def block(what: str):
        a, b = F.col(f"actual_{what}"), F.col(f"budget_{what}")
        return [
            m.as_double(F.coalesce(a, F.lit(0))).alias(f"actual_{what}"),
            m.as_double(b).alias(f"budget_{what}"),
            m.as_double(m.variance(a, b)).alias(f"variance_{what}"),
            m.variance_pct(a, b).alias(f"variance_{what}_pct"),
        ]

    return both.select(axis, *block("revenue"), *block("margin"))


def budget_monthly(base: DataFrame, star: dict[str, DataFrame], filters: Filters = NO_FILTERS) -> DataFrame:
    return budget_by(base, star, "month", filters).orderBy(F.col("month").asc_nulls_last())


def budget_by_region(base: DataFrame, star: dict[str, DataFrame], filters: Filters = NO_FILTERS) -> DataFrame:
    return budget_by(base, star, "region", filters).orderBy(
        F.col("actual_revenue").desc_nulls_last(), F.col("region").asc_nulls_last()
    )


def without_incomparable_variance(view: DataFrame, filters: Filters) -> DataFrame:
    """NULL variances and a flag when the filters leave budget and actual on different scopes."""
    ok = filters.budget_comparable
    columns = [
        F.when(F.lit(ok), F.col(c)).alias(c) if c.startswith("variance_") else F.col(c) for c in view.columns
    ]
    return view.select(*columns, F.lit(ok).alias("budget_comparable"))


def years_of(base: DataFrame) -> list[str]:
    """Years present, for the pivot columns: a list bounded by the calendar."""
    return [r.year for r in base.select("year").filter("year IS NOT NULL").distinct().orderBy("year").collect()]


def category_mix(base: DataFrame, years: Sequence[str] | None = None) -> DataFrame:
    """Revenue share of each category inside each year, one ``part_<year>`` column per year.

    The category x year cells are stored once: they give the pivot its columns,
    the yearly totals and the shares without going back to the facts.
    """
    cells = materialise(rollup_sum(base, ["category", "year"]).select("category", "year", "revenue"), "mix")
    per_year = cells.groupBy("year").agg(F.sum("revenue").alias("year_revenue"))
    shares = cells.join(per_year, "year").select(
        "category", F.concat(F.lit("part_"), "year").alias("column"),
        m.pct(F.col("revenue"), F.col("year_revenue")).alias("share"),
    )
    columns = [f"part_{y}" for y in (years if years is not None else years_of(cells))]
    return shares.groupBy("category").pivot("column", columns).agg(F.first("share")).orderBy(
        F.col("category").asc_nulls_last()
    )


def client_pareto(base: DataFrame, with_code: bool = False) -> DataFrame:
    """Customers by revenue with their running share (ABC curve)."""
    per_customer = base.groupBy("customer_code").agg(F.sum("revenue").alias("revenue"))
    curve = running_share(per_customer, "customer_code")
    columns = [*(["customer_code"] if with_code else []), "rank", "revenue", "cumulative_pct"]
    return _doubles(curve.select(*columns), "revenue").orderBy("rank")


def client_top(base: DataFrame, n: int = 15, by: Sequence[str] = ("company_name", "segment")) -> DataFrame:
    """The ``n`` largest customers. Grouping is by name and segment, so homonyms merge
    unless ``by`` adds the customer code."""
    top = _with_rate(with_share(rollup_sum(base, list(by)).select(*by, "revenue", "margin")))
    return _by_revenue(_doubles(top, "revenue").select(*by, "revenue", "revenue_share_pct", _RATE), *by).limit(n)


def budget_totals(star: dict[str, DataFrame], filters: Filters = NO_FILTERS) -> DataFrame:
    """Planned revenue and margin of the filtered scope, one row, 0 when there is none."""
    return _planned(star, filters).agg(
        m.sum_or_zero(F.col("budget_revenue")).alias("revenue"), m.sum_or_zero(F.col("budget_margin")).alias("margin")
    )


def summary(by_year_view: DataFrame, plan_totals: DataFrame) -> DataFrame:
    """One row of totals, variances and first-to-last-year growth.

    The years partition the delivered lines, so their sums are the totals and one
    pass over that small view gives everything but the plan. ``active_customers``
    is the best year's count, not a distinct count over the period.
    """
    exact = "decimal(38,6)"
    point = F.when(F.col("year").isNotNull(), F.struct("revenue", F.col(_RATE).alias("rate")))
    framed = by_year_view.agg(
        m.sum_or_zero(F.col("revenue").cast(exact)).alias("revenue"),
        m.sum_or_zero(F.col("margin").cast(exact)).alias("margin"),
        F.count("year").alias("years"),
        F.min_by(point, "year").alias("first"),
        F.max_by(point, "year").alias("last"),
        F.coalesce(F.max("active_customers"), F.lit(0)).alias("active_customers"),
    ).withColumn("plan", plan_totals.select(F.struct("*")).scalar())
    revenue, margin = F.col("revenue"), F.col("margin")
    plan_revenue, plan_margin = F.col("plan.revenue"), F.col("plan.margin")
    first, last = F.col("first"), F.col("last")
    two_years = F.col("years") >= 2
    return framed.select(
        m.as_double(revenue).alias("revenue"),
        m.as_double(margin).alias("margin"),
        m.pct(margin, revenue).alias(_RATE),
        m.as_double(plan_revenue).alias("budget_revenue"),
        m.as_double(plan_margin).alias("budget_margin"),
        m.as_double(revenue - plan_revenue).alias("variance_revenue"),
        m.pct(revenue - plan_revenue, plan_revenue).alias("variance_revenue_pct"),
        m.as_double(margin - plan_margin).alias("variance_margin"),
        m.pct(margin - plan_margin, plan_margin).alias("variance_margin_pct"),
        F.when(two_years, m.pct(last["revenue"] - first["revenue"], first["revenue"])).alias("revenue_yoy_pct"),
        F.when(two_years, last["rate"] - first["rate"]).alias("margin_rate_delta_pts"),
        "active_customers",
    )


def active_customers_period(base: DataFrame) -> DataFrame:
    """Distinct customers over the whole period (the summary shows the best year)."""
    return base.agg(F.countDistinct("customer_code").alias("active_customers_period"))


def stored_base(
    star: dict[str, DataFrame], filters: Filters = NO_FILTERS, delivered: Sequence[str] = specs.DELIVERED
) -> DataFrame:
    """Delivered lines with every axis, joined once and written narrow to shared storage."""
    axes = (*CUBE_AXES, "customer_code", "company_name", "salesperson")
    return materialise(delivered_lines(star, axes, filters, delivered), "delivered-lines")


def build_views(
    star: dict[str, DataFrame],
    filters: Filters = NO_FILTERS,
    delivered: Sequence[str] = specs.DELIVERED,
    base: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All twelve views from one pass over the facts.

    Without ``base`` the filters go into the joins and their scans. A session that
    changes filters often passes an unfiltered ``stored_base`` instead: a refresh
    then only scans that table. Two roll-ups follow, stored because several views
    read them: ``cube`` (calendar x small business axes, bounded by those axes)
    and ``customers`` (one row per customer and year).
    """
    base = stored_base(star, filters, delivered) if base is None else filters.on(base)
    cube = materialise(rollup_sum(base, CUBE_AXES), "cube")
    customers = materialise(rollup_sum(base, CUSTOMER_AXES), "customer-years")
    year = by_year(customers)
    return {
        "summary": summary(year, budget_totals(star, filters)),
        "by_year": year,
        "monthly": monthly(cube),
        "by_category": by_category(cube),
        "budget_monthly": budget_monthly(cube, star, filters),
        "budget_by_region": budget_by_region(cube, star, filters),
        "category_mix": category_mix(cube),
        "by_salesperson": by_salesperson(base),
        "by_segment": by_segment(customers),
        "client_pareto": client_pareto(customers),
        "client_top": client_top(customers),
        "by_discount_band": by_discount_band(cube),
    }


def filter_options(star: dict[str, DataFrame], delivered: Sequence[str] = specs.DELIVERED) -> dict[str, DataFrame]:
    """Distinct sorted non-null choices of each filter axis."""
    base = {
        "month": delivered_lines(star, ["month"], delivered=delivered, cost=False),
        "region": star["dim_region"].select(F.col("region_name").alias("region")),
        "segment": star["dim_customer"].select("segment"),
        "salesperson": star["dim_salesperson"].select(F.col("name").alias("salesperson")),
    }
    return {
        axis: df.select(axis).filter(F.col(axis).isNotNull()).distinct().orderBy(axis) for axis, df in base.items()
    }
