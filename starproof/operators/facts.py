"""The delivered-line base of every view, and its additive roll-ups."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starproof import specs
from starproof.functions import measures as m

# axis -> star table that carries it
_CUSTOMER_AXES = {"company_name", "segment", "region"}
_ORDER_AXES = {"month", "year", "customer_code"}
_LINE_AXES = {"discount_band"}
AXES = _CUSTOMER_AXES | _ORDER_AXES | _LINE_AXES | {"category", "salesperson"}


@dataclass(frozen=True)
class Filters:
    """Presentation filters; None or an empty selection means no filter."""

    months: Sequence[str] | None = None
    regions: Sequence[str] | None = None
    segments: Sequence[str] | None = None
    salespeople: Sequence[str] | None = None

    def axes(self) -> set[str]:
        chosen = {"month": self.months, "region": self.regions, "segment": self.segments, "salesperson": self.salespeople}
        return {axis for axis, values in chosen.items() if values}

    def on(self, base: DataFrame) -> DataFrame:
        """The same filters on a base that carries the axes as columns."""
        for axis, values in (
            ("month", self.months), ("region", self.regions), ("segment", self.segments), ("salesperson", self.salespeople),
        ):
            base = _isin(base, axis, values)
        return base

    @property
    def budget_comparable(self) -> bool:
        """Budgets know months and regions only; other filters make variances meaningless."""
        return not (self.segments or self.salespeople)


NO_FILTERS = Filters()


def selection(chosen: Iterable[str], choices: Sequence[str]) -> list[str] | None:
    """A widget-like selection -> filter values: nothing or everything chosen is no filter."""
    picked = list(chosen)
    return None if not picked or len(picked) == len(choices) else picked


def month_range(start: str, end: str, months: Sequence[str]) -> list[str] | None:
    return selection([x for x in months if start <= x <= end], months)


def _isin(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    return df.filter(F.col(column).isin(*values)) if values else df


def _within(orders: DataFrame, months: Sequence[str] | None) -> DataFrame:
    """The months as one date range: unlike a formatted month, it reaches the scan."""
    if not months or not all(re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", x) for x in months):
        return orders
    year, month = map(int, max(months).split("-"))
    end = dt.date(year + month // 12, month % 12 + 1, 1)
    start = dt.date.fromisoformat(f"{min(months)}-01")
    return orders.filter((F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end)))


def delivered_orders(star: dict[str, DataFrame], delivered: Sequence[str] = specs.DELIVERED) -> DataFrame:
    return star["fact_order"].filter(F.col("status").isin(*delivered))


def delivered_lines(
    star: dict[str, DataFrame],
    axes: Iterable[str],
    filters: Filters = NO_FILTERS,
    delivered: Sequence[str] = specs.DELIVERED,
    cost: bool = True,
) -> DataFrame:
    """Delivered lines with revenue and margin, plus the asked axes only.

    Dimensions are left-joined so that an unknown key stays visible as NULL, and
    only those an axis or a filter needs are joined at all. Customer attributes
    are attached to orders, before lines multiply them. Lines meet their orders
    first, so only delivered ones look up products and people. No broadcast is forced:
    a dimension is broadcast when its size is under the session's threshold,
    otherwise the join shuffles and adaptive execution splits hot keys.
    """
    wanted = set(axes) | filters.axes()
    unknown = wanted - AXES
    if unknown:
        raise ValueError(f"unknown axes {sorted(unknown)}")
    orders, lines = _within(delivered_orders(star, delivered), filters.months), star["fact_line"]

    header: list[Column] = [F.col("order_id")]
    if "month" in wanted:
        header.append(m.month_key(F.col("order_date")).alias("month"))
    if "year" in wanted:
        header.append(m.year_key(F.col("order_date")).alias("year"))
    if wanted & (_CUSTOMER_AXES | {"customer_code"}):
        header.append(F.col("customer_code"))
    rep_on_order = "salesperson_code" in orders.columns
    if "salesperson" in wanted and rep_on_order:
        header.append(F.col("salesperson_code"))
    orders = _isin(orders.select(*header), "month", filters.months)
    if wanted & _CUSTOMER_AXES:
        orders = _with_customer(orders, star, wanted)
        orders = _isin(_isin(orders, "segment", filters.segments), "region", filters.regions)
    if "salesperson" in wanted and rep_on_order:
        orders = _isin(_with_rep(orders, star), "salesperson", filters.salespeople)

    body = ["order_id", "quantity", "unit_price", "discount_rate"]
    if cost or "category" in wanted:
        body.append("product_code")
    if "salesperson" in wanted and not rep_on_order:
        body.append("salesperson_code")
    joined = lines.select(*body).join(orders, "order_id")
    if cost or "category" in wanted:
        joined = joined.join(star["dim_product"].select("product_code", "category", "unit_cost"), "product_code", "left")
    if "salesperson" in wanted and not rep_on_order:
        joined = _isin(_with_rep(joined, star), "salesperson", filters.salespeople)

    revenue = m.line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_rate"))
    amounts = [revenue.alias("revenue")]
    if cost:
        amounts.append((revenue - m.line_cost(F.col("quantity"), F.col("unit_cost"))).alias("margin"))
    if "discount_band" in wanted:
        amounts += [
            m.discount_band(F.col("discount_rate")).alias("discount_band"),
            F.col("discount_rate").alias("min_discount"),
        ]
    kept = [a for a in sorted(set(axes)) if a != "discount_band"]
    return joined.select(*kept, *amounts, F.lit(1).cast("bigint").alias("line_count"))


def _with_customer(orders: DataFrame, star: dict[str, DataFrame], wanted: set[str]) -> DataFrame:
    customers = star["dim_customer"].select("customer_code", "company_name", "segment", "region_code")
    if "region" in wanted:
        regions = star["dim_region"].select("region_code", F.col("region_name").alias("region"))
        customers = customers.join(regions, "region_code", "left")
    keep = [c for c in ("company_name", "segment", "region") if c in wanted]
    return orders.join(customers.select("customer_code", *keep), "customer_code", "left")


def _with_rep(df: DataFrame, star: dict[str, DataFrame]) -> DataFrame:
    reps = star["dim_salesperson"].select("salesperson_code", F.col("name").alias("salesperson"))
    return df.join(reps, "salesperson_code", "left").drop("salesperson_code")


def rollup_sum(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold the base to ``keys``. The measures are additive, so a roll-up can be
    folded again and every view gives the same figures on it as on the lines."""
    extra = [F.min("min_discount").alias("min_discount")] if "min_discount" in base.columns else []
    margin = [F.sum("margin").alias("margin")] if "margin" in base.columns else []
    return base.groupBy(*keys).agg(
        F.sum("revenue").alias("revenue"), *margin, F.sum("line_count").alias("line_count"), *extra
    )
