"""Display texts as queries: every line or customer of the tables is formatted."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starproof import specs
from starproof.catalogue.finance import SUMMARY, summary_of
from starproof.catalogue.quality import _RECON, _report
from starproof.catalogue.registry import BASE, BUDGET, QUERIES, RATE, query, ratio
from starproof.functions import text as t
from starproof.plans import checks, publish, views
from starproof.operators import facts
from starproof.sources.warehouse import DELIVERED, star, table


def _grouped(cents: str, sep: str) -> str:
    """Sign, grouped units, comma, two digits, from a whole number of cents."""
    return (
        f"CASE WHEN {cents} < 0 THEN '-' ELSE '' END || replace(format('{{:,}}', abs({cents}) // 100), ',', {sep})"
        f" || ',' || lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0')"
    )


def _one(x: str) -> str:
    return f"replace(format('{{:.1f}}', {x}), '.', ',')"


def _sign(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN '+' ELSE '' END"


_BAL = "CAST(round(c_acctbal * 100) AS BIGINT)"


@query("format_money_fr", f"""SELECT c_custkey AS customer_code, {_grouped(_BAL, "' '")} || ' €' AS money,
       {_grouped(_BAL, 'chr(160)')} AS raw,
       CASE WHEN c_custkey % 10 = 0 THEN '—' ELSE {_grouped(_BAL, "' '")} || ' €' END AS with_missing FROM customer""")
def format_money_fr(spark, sf_dir):
    x = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_code"), t.money(x).alias("money"), t.raw_amount(x).alias("raw"),
        t.money(F.when(F.col("c_custkey") % 10 != 0, x)).alias("with_missing"),
    )


@query("format_integer_fr", """SELECT p_partkey AS product_code,
       CASE WHEN p_partkey % 10 = 0 THEN '—' ELSE replace(format('{:,}', CAST(trunc(p_retailprice * 1000) AS BIGINT)), ',', ' ') END AS units
FROM part""")
def format_integer_fr(spark, sf_dir):
    x = F.when(F.col("p_partkey") % 10 != 0, F.col("p_retailprice") * 1000)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_code"), t.integer(x).alias("units"))


_PCT = "(c_acctbal / 16)"


@query("format_pct_signed", f"""SELECT c_custkey AS customer_code, {_one(_PCT)} || ' %' AS plain,
       {_sign(_PCT)} || {_one(_PCT)} || ' %' AS signed, {_sign(_PCT)} || {_one(_PCT)} || ' pts' AS points,
       CASE WHEN c_custkey % 10 = 0 THEN 'n/a' ELSE {_sign(_PCT)} || {_one(_PCT)} || ' %' END AS with_missing,
       CASE WHEN c_custkey % 10 = 0 THEN '—' ELSE {_one(_PCT)} || ' %' END AS with_dash FROM customer""")
def format_pct_signed(spark, sf_dir):
    x = F.col("c_acctbal") / 16
    some = F.when(F.col("c_custkey") % 10 != 0, x)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_code"), t.percent(x).alias("plain"), t.percent(x, signed=True).alias("signed"),
        t.signed_points(x).alias("points"), t.signed_percent(some).alias("with_missing"), t.percent(some).alias("with_dash"),
    )


@query("compact_labels", """SELECT o_orderkey AS order_id,
  CASE WHEN abs(v) >= 1000000 THEN format('{:.1f}', v / 1000000) || 'M €' WHEN abs(v) >= 1000 THEN format('{:.0f}', v / 1000) || 'k €'
       ELSE format('{:.0f}', v) || ' €' END AS money,
  CASE WHEN p = 0 THEN '0 %' ELSE CASE WHEN p >= 0 THEN '+' ELSE '' END || format('{:.1f}', p) || ' %' END AS signed,
  format('{:.0f}', p) || ' %' AS unsigned
FROM (SELECT o_orderkey, o_totalprice * (o_orderkey % 11) - 500000 AS v, CAST(o_orderkey % 7 AS DOUBLE) - 3 AS p FROM orders)""")
def compact_labels(spark, sf_dir):
    key = F.col("o_orderkey")
    v, p = F.col("o_totalprice") * (key % 11) - 500000, (key % 7).cast("double") - 3
    return table(spark, sf_dir, "orders").select(
        key.alias("order_id"), t.compact_money(v).alias("money"), t.axis_percent(p).alias("signed"),
        t.axis_percent(p, signed=False).alias("unsigned"),
    )


@query("favourable_flag", """SELECT c_custkey AS customer_code,
  CASE WHEN b IS NULL THEN 'neutral' WHEN b >= 0 THEN 'favourable' ELSE 'unfavourable' END AS higher_is_better,
  CASE WHEN b IS NULL THEN 'neutral' WHEN b <= 0 THEN 'favourable' ELSE 'unfavourable' END AS lower_is_better
FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS b FROM customer)""")
def favourable_flag(spark, sf_dir):
    x = F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_code"), t.favourable(x).alias("higher_is_better"),
        t.favourable(x, higher_is_better=False).alias("lower_is_better"),
    )


def _money0(x: str) -> str:
    return f"replace(format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT)), ',', ' ') || ' €'"


_NARRATIVE = f"""CASE WHEN revenue_yoy_pct IS NOT NULL THEN 'Le chiffre d''affaires atteint ' || {_money0('revenue')} || ', '
      || CASE WHEN revenue_yoy_pct >= 0 THEN 'en hausse' ELSE 'en baisse' END || ' de ' || {_one('abs(revenue_yoy_pct)')} || ' % sur un an.'
    ELSE 'Le chiffre d''affaires atteint ' || {_money0('revenue')} || ' sur la période.' END
  || ' ' || CASE WHEN margin_rate_delta_pts IS NOT NULL THEN 'Le taux de marge s''établit à ' || {_one('margin_rate_pct')} || ' %, '
      || CASE WHEN margin_rate_delta_pts < 0 THEN 'en recul de ' || {_one('abs(margin_rate_delta_pts)')} || ' pts'
              WHEN margin_rate_delta_pts > 0 THEN 'en progression de ' || {_one('abs(margin_rate_delta_pts)')} || ' pts' ELSE 'stable' END
      || ' par rapport à N-1.' ELSE 'Le taux de marge s''établit à ' || {_one('margin_rate_pct')} || ' %.' END
  || CASE WHEN variance_revenue_pct IS NOT NULL THEN ' L''activité est '
      || CASE WHEN variance_revenue_pct < 0 THEN 'sous le budget' ELSE 'au-dessus du budget' END || ' de ' || {_one('abs(variance_revenue_pct)')}
      || ' % sur le CA et de ' || {_one('abs(variance_margin_pct)')} || ' % sur la marge.' ELSE '' END
  || CASE WHEN revenue_yoy_pct > 0 AND margin_rate_delta_pts < 0 THEN ' Point d''attention : la croissance du CA s''accompagne d''une érosion'
      || ' de la marge — à investiguer (mix produit, politique de remises).' ELSE '' END"""


@query("narrative", f"WITH {BASE}, {BUDGET}, {SUMMARY} SELECT {_NARRATIVE} AS narrative FROM summary")
def narrative(spark, sf_dir):
    return summary_of(spark, sf_dir).select(t.narrative().alias("narrative"))


@query("narrative_by_month", f"""WITH {BASE}, m AS (SELECT month, sum(revenue) AS r, {RATE} AS margin_rate_pct FROM base GROUP BY 1),
g AS (SELECT month, CAST(r AS DOUBLE) AS revenue, margin_rate_pct,
        (CAST(r AS DOUBLE) - lag(CAST(r AS DOUBLE)) OVER w) * 100.0 / abs(lag(CAST(r AS DOUBLE)) OVER w) AS revenue_yoy_pct,
        margin_rate_pct - lag(margin_rate_pct) OVER w AS margin_rate_delta_pts,
        CAST(NULL AS DOUBLE) AS variance_revenue_pct, CAST(NULL AS DOUBLE) AS variance_margin_pct FROM m WINDOW w AS (ORDER BY month))
SELECT month, {_NARRATIVE} AS narrative FROM g ORDER BY month""")
def narrative_by_month(spark, sf_dir):
    """The same sentences against the previous month: up, down, no history."""
    from starproof.plans.reporting import _change, _months

    by_month = views.monthly(facts.delivered_lines(star(spark, sf_dir), ["month"], delivered=DELIVERED))
    w = _months()
    moved = by_month.select(
        "month", "revenue", "margin_rate_pct", _change(F.col("revenue"), F.lag("revenue").over(w)).alias("revenue_yoy_pct"),
        (F.col("margin_rate_pct") - F.lag("margin_rate_pct").over(w)).alias("margin_rate_delta_pts"),
        F.lit(None).cast("double").alias("variance_revenue_pct"), F.lit(None).cast("double").alias("variance_margin_pct"),
    )
    return moved.select("month", t.narrative().alias("narrative")).orderBy("month")


_VALUE = (
    "CASE WHEN contains(label, '€') THEN {money} ELSE replace(format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT)), ',', ' ') END"
)


def _value(x: str) -> str:
    return _VALUE.format(x=x, money=_grouped(f"CAST(round({x} * 100) AS BIGINT)", "' '") + " || ' €'")


@query("reconciliation_table", f"""{_RECON}
SELECT check_no, label AS "check", {_value('obtained')} AS obtained, {_value('expected')} AS expected,
       CASE WHEN ok THEN 'OK' ELSE 'ALERT' END AS status FROM final ORDER BY check_no""")
def reconciliation_table(spark, sf_dir):
    return checks.report_table(_report(spark, sf_dir)).drop("detail")


_TWO = "format('{{:,.2f}}', {x})"


@query("reconciliation_text", f"""{_RECON}
SELECT string_agg('[' || rpad(CASE WHEN ok THEN 'OK' ELSE 'ALERT' END, 5, ' ') || '] ' || rpad(label, 36, ' ')
       || ' obtained=' || {_TWO.format(x='obtained')} || ' expected=' || {_TWO.format(x='expected')}
       || CASE WHEN label LIKE 'FK %' THEN '  (orphan foreign keys)'
               WHEN label LIKE '%segments' THEN '  (' || (SELECT count(DISTINCT segment) FROM customers) || ' distinct segments)'
               WHEN label LIKE '%grid' THEN '  (' || (SELECT count(*) FROM budget WHERE budget_revenue IS NULL OR budget_margin IS NULL) || ' missing amounts)'
               WHEN label LIKE '%revenue%' THEN (SELECT '  (gap ' || format('{{:.4f}}', abs(o.unrounded - round(e.revenue, 2))) || ' € = '
                 || format('{{:.5f}}', 100 * abs(o.unrounded - round(e.revenue, 2)) / abs(round(e.revenue, 2))) || ' %, tolerance 0.100 %)' FROM obtained o, expected e)
               ELSE '' END, chr(10) ORDER BY check_no)
       || chr(10) || CASE WHEN bool_and(ok) THEN '=> INTEGRITY OK' ELSE '=> INTEGRITY ALERT' END AS report FROM final""")
def reconciliation_text(spark, sf_dir):
    return checks.report_lines(_report(spark, sf_dir))


@query("manifest_truth", QUERIES["business_truth"].sql)
def manifest_truth(spark, sf_dir):
    """The manifest written to the landing folder and read back through its declared schema."""
    from starproof.catalogue.quality import _expected
    from starproof.plans.truth import business_truth
    from starproof.sources import readers
    from starproof.sources.store import run_dir

    s = star(spark, sf_dir)
    figures = business_truth(s["fact_order"], s["fact_line"], s["dim_product"], DELIVERED)
    anomalies = s["fact_line"].agg(F.count_if(F.col("order_id") % 250 == 0).alias("unreadable_prices"))
    origin = spark.range(1).select(F.lit("derived").alias("version_generateur"))
    manifest = publish.manifest_json(figures, anomalies, _expected(spark, sf_dir), origin)
    folder = f"{run_dir(spark)}/manifest-{uuid.uuid4().hex}"
    publish.write_manifest(manifest, f"{folder}/{specs.MANIFEST_NAME}")
    return readers.manifest_truth(readers.read_manifest(spark, folder))
