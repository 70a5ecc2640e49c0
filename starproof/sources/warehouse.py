"""Maps order-management tables (TPC-H-like Parquet) to the star, and to raw exports.

The salesperson is the line's supplier, so that key sits on the lines here; the
fact operators accept it on either fact table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starproof.functions import measures as m
from starproof.operators.facts import delivered_orders

DELIVERED = ("F",)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


# Declared layouts: no job is spent on reading footers, and a plan names its input types.
LAYOUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class WarehouseStar(dict):
    """The star tables, each planned on first use, so a view opens only what it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._read = lambda name: table(spark, sf_dir, name)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = getattr(self, f"_{name}")()
        return self[name]

    def _nation(self) -> DataFrame:
        # a provably unique key lets Catalyst drop the left join where no region is asked for
        nation = self._read("nation").select("n_nationkey", F.col("n_regionkey").alias("region_code"))
        return nation.dropDuplicates(["n_nationkey"])

    def _dim_region(self) -> DataFrame:
        return self._read("region").select(F.col("r_regionkey").alias("region_code"), F.col("r_name").alias("region_name"))

    def _dim_salesperson(self) -> DataFrame:
        return self._read("supplier").join(self._nation(), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("s_suppkey").alias("salesperson_code"), F.col("s_name").alias("name"), "region_code",
            F.lit(None).cast("date").alias("hire_date"),
        )

    def _dim_product(self) -> DataFrame:
        return self._read("part").select(
            F.col("p_partkey").alias("product_code"), F.col("p_name").alias("label"), F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"), F.col("p_retailprice").alias("unit_cost"),
            F.col("p_retailprice").alias("list_price"), F.lit(None).cast("string").alias("supplier"),
        )

    def _dim_customer(self) -> DataFrame:
        no_text = F.lit(None).cast("string")
        return self._read("customer").join(self._nation(), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("customer_code"), F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("segment"), no_text.alias("venue_type"), "region_code", no_text.alias("city"),
            F.lit(None).cast("bigint").alias("salesperson_code"), F.lit(None).cast("date").alias("first_order_date"),
        )

    def _fact_order(self) -> DataFrame:
        return self._read("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_custkey").alias("customer_code"), F.col("o_orderstatus").alias("status"),
        )

    def _fact_line(self) -> DataFrame:
        return self._read("lineitem").select(
            F.col("l_linenumber").alias("line_id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_code"), F.col("l_suppkey").alias("salesperson_code"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("l_discount").alias("discount_rate"),
        )

    def _fact_budget(self) -> DataFrame:
        return budget_plan(self)


def star(spark: SparkSession, sf_dir: str) -> WarehouseStar:
    return WarehouseStar(spark, sf_dir)


def budget_plan(tables: dict[str, DataFrame]) -> DataFrame:
    """A plan by month, region and category, proportional to delivered quantities."""
    regions = tables["dim_customer"].select("customer_code", "region_code")
    orders = delivered_orders(tables, DELIVERED).select(
        "order_id", m.month_key(F.col("order_date")).alias("period"), "customer_code"
    ).join(regions, "customer_code", "left")
    categories = tables["dim_product"].select("product_code", "category")
    lines = tables["fact_line"].select("order_id", "product_code", "quantity").join(categories, "product_code", "left")
    units = lines.join(orders, "order_id").groupBy("period", "region_code", "category").agg(F.sum("quantity").alias("q"))
    weight = F.col("q") * (100 + 3 * F.col("region_code"))
    return units.select(
        "period", "region_code", "category",
        (weight * 40).cast("decimal(18,4)").alias("budget_revenue"),
        (weight * 24).cast("decimal(18,4)").alias("budget_margin"),
    )
