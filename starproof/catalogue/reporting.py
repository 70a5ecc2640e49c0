"""Reporting views, indicators and chart series as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from starproof.catalogue import exports as x
from starproof.catalogue.registry import BASE, dbl, query
from starproof.catalogue.quality import _customers
from starproof.plans import publish, reporting
from starproof.sources.warehouse import DELIVERED, star

_MONTH = f"by_month AS (SELECT month, {dbl('sum(revenue)')} AS revenue FROM base GROUP BY 1)"
_REP = f"by_rep AS (SELECT salesperson, {dbl('sum(revenue)')} AS revenue FROM base GROUP BY 1)"


def _lines(spark, sf_dir):
    return reporting.reporting_lines(star(spark, sf_dir), DELIVERED)


def _months(spark, sf_dir):
    return reporting.revenue_by_month(_lines(spark, sf_dir))


@query("reporting_lines", """SELECT CAST(o_orderdate AS DATE) AS date, strftime(o_orderdate, '%Y-%m') AS month, s_name AS salesperson,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE o_orderstatus = 'F'""")
def reporting_lines(spark, sf_dir):
    return _lines(spark, sf_dir).withColumn("amount", F.col("amount").cast("double"))


@query("revenue_by_month", f"WITH {BASE}, {_MONTH} SELECT * FROM by_month ORDER BY month")
def revenue_by_month(spark, sf_dir):
    return _months(spark, sf_dir)


@query("revenue_by_salesperson", f"WITH {BASE}, {_REP} SELECT * FROM by_rep ORDER BY revenue DESC, salesperson")
def revenue_by_salesperson(spark, sf_dir):
    return reporting.revenue_by_salesperson(_lines(spark, sf_dir))


@query("cumulative_revenue", f"""WITH {BASE}, m AS (SELECT month, sum(revenue) AS r FROM base GROUP BY 1)
SELECT month, {dbl('r')} AS revenue, {dbl('sum(r) OVER (ORDER BY month)')} AS cumulative_revenue FROM m ORDER BY month""")
def cumulative_revenue(spark, sf_dir):
    return reporting.cumulative_revenue(_months(spark, sf_dir))


_MOM = """mom AS (SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS previous FROM by_month)"""


@query("mom_variation", f"""WITH {BASE}, {_MONTH}, {_MOM}
SELECT month, (revenue - previous) * 100.0 / abs(previous) AS variation_pct,
       CASE WHEN revenue - previous >= 0 THEN 'favourable' ELSE 'unfavourable' END AS flag
FROM mom WHERE previous <> 0 ORDER BY month""")
def mom_variation(spark, sf_dir):
    return reporting.month_over_month(_months(spark, sf_dir))


@query("average_basket", f"""WITH {BASE}, m AS (SELECT month, sum(revenue) AS r, count(revenue) AS n FROM base GROUP BY 1)
SELECT month, greatest(n, 1) AS valid_lines, {dbl('r')} / greatest(n, 1) AS average_basket FROM m ORDER BY month""")
def average_basket(spark, sf_dir):
    return reporting.average_basket(_lines(spark, sf_dir))


@query("top10_salespeople", f"WITH {BASE}, {_REP} SELECT * FROM by_rep ORDER BY revenue DESC, salesperson LIMIT 10")
def top10_salespeople(spark, sf_dir):
    return reporting.top_salespeople(reporting.revenue_by_salesperson(_lines(spark, sf_dir)))


_BEST = """best AS (SELECT month AS best_month, revenue AS best_month_revenue FROM by_month ORDER BY revenue DESC, month LIMIT 1),
worst AS (SELECT month AS worst_month, revenue AS worst_month_revenue FROM by_month ORDER BY revenue, month LIMIT 1)"""


@query("best_worst_month", f"WITH {BASE}, {_MONTH}, {_BEST} SELECT * FROM best, worst")
def best_worst_month(spark, sf_dir):
    return reporting.best_and_worst_month(_months(spark, sf_dir))


@query("dashboard_kpis", f"""WITH {BASE}, {_MONTH}, {_REP}, {_MOM}, {_BEST},
tot AS (SELECT {dbl('sum(revenue)')} AS total_revenue, count(revenue) AS n FROM base),
top AS (SELECT salesperson AS top_salesperson, revenue AS top_salesperson_revenue FROM by_rep ORDER BY revenue DESC, salesperson LIMIT 1),
latest AS (SELECT (revenue - previous) * 100.0 / abs(previous) AS last_mom_growth_pct FROM mom ORDER BY month DESC LIMIT 1)
SELECT total_revenue, n AS valid_line_count, total_revenue / n AS average_basket,
       total_revenue / (SELECT count(*) FROM by_month) AS monthly_avg_revenue, (SELECT count(*) FROM by_month) AS active_months,
       best.*, worst.*, last_mom_growth_pct, top.*, (SELECT count(*) FROM by_rep) AS active_salespeople
FROM tot, best, worst, top, latest""")
def dashboard_kpis(spark, sf_dir):
    return reporting.dashboard_kpis(_lines(spark, sf_dir))


@query("basket_join", f"""WITH {BASE}, m AS (SELECT month, sum(revenue) AS r, count(*) AS n FROM base GROUP BY 1)
SELECT month, CASE WHEN month < '1997' THEN n ELSE 1 END AS valid_lines,
       {dbl('r')} / CASE WHEN month < '1997' THEN n ELSE 1 END AS average_basket FROM m ORDER BY month""")
def basket_join(spark, sf_dir):
    """Counts known for the first years only: the other months divide by one."""
    lines = _lines(spark, sf_dir)
    known = lines.filter("month < '1997'").groupBy("month").agg(F.count("amount").alias("n"))
    return reporting.basket_of(reporting.revenue_by_month(lines), known)


@query("period_bounds", f"""WITH {BASE}, b AS (SELECT min(month) AS first_month, max(month) AS last_month FROM base)
SELECT *, first_month || ' → ' || last_month AS period_label, 'reporting_' || first_month || '_to_' || last_month AS stem,
       first_month[:4] || '_' || last_month[:4] AS folder FROM b""")
def period_bounds(spark, sf_dir):
    return publish.period_bounds(_months(spark, sf_dir))


@query("monthly_export", f"WITH {BASE}, {_MONTH} SELECT month, revenue AS revenue_eur FROM by_month ORDER BY month")
def monthly_export(spark, sf_dir):
    return publish.monthly_export(_months(spark, sf_dir))


@query("oldest_cohort", f"""WITH {x.RAW_CUSTOMERS}
SELECT c_custkey AS customer_code, segment, first_order_date FROM customers WHERE segment = 'BUILDING'
ORDER BY first_order_date ASC NULLS LAST, CAST(c_custkey AS VARCHAR) LIMIT 25""")
def oldest_cohort(spark, sf_dir):
    cohort = reporting.oldest_customers(_customers(spark, sf_dir), "BUILDING", 25)
    return cohort.select(F.col("customer_code").cast("bigint").alias("customer_code"), "segment", "first_order_date")
