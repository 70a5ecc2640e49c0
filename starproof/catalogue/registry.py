from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` together with its SQL twin."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = Query(fn, sql)
        return fn

    return register


# ---------------------------------------------------------------------------
# SQL fragments shared by the twins
# ---------------------------------------------------------------------------

REVENUE = "CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))"
COST = "CAST(l.l_quantity AS DECIMAL(10,0)) * CAST(p.p_retailprice AS DECIMAL(12,2))"

BASE = f"""base AS (
  SELECT strftime(o.o_orderdate, '%Y-%m') AS month, strftime(o.o_orderdate, '%Y') AS year,
         o.o_custkey AS customer_code, c.c_name AS company_name, c.c_mktsegment AS segment,
         p.p_type AS category, r.r_name AS region, s.s_name AS salesperson, l.l_discount AS discount,
         {REVENUE} AS revenue, {REVENUE} - {COST} AS margin
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE o.o_orderstatus = 'F')"""

BUDGET = """budget AS (
  SELECT strftime(o.o_orderdate, '%Y-%m') AS period, n.n_regionkey AS region_code, p.p_type AS category,
         CAST(sum(l.l_quantity) AS BIGINT) * 40 * (100 + 3 * n.n_regionkey) AS budget_revenue,
         CAST(sum(l.l_quantity) AS BIGINT) * 24 * (100 + 3 * n.n_regionkey) AS budget_margin
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderstatus = 'F' GROUP BY 1, 2, 3)"""


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def ratio(part: str, whole: str) -> str:
    return f"100.0 * {dbl(part)} / NULLIF({dbl(whole)}, 0)"


RATE = ratio("sum(margin)", "sum(revenue)")
SHARE = ratio("sum(revenue)", "sum(sum(revenue)) OVER ()")
