"""Finance views as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from starproof.catalogue.registry import QUERIES, BASE, BUDGET, RATE, SHARE, dbl, query, ratio
from starproof.functions import measures as m
from starproof.operators import facts, ranking
from starproof.plans import reporting, views
from starproof.sources.warehouse import DELIVERED, star


def _lines(spark, sf_dir, axes, filters=facts.NO_FILTERS, cost=True):
    return facts.delivered_lines(star(spark, sf_dir), axes, filters, DELIVERED, cost)


_AMOUNTS = f"{dbl('sum(revenue)')} AS revenue, {dbl('sum(margin)')} AS margin, {RATE} AS margin_rate_pct"
MONTHLY = f"SELECT month, {_AMOUNTS} FROM base GROUP BY month"


@query("monthly", f"WITH {BASE} {MONTHLY} ORDER BY month")
def monthly(spark, sf_dir):
    return views.monthly(_lines(spark, sf_dir, ["month"]))


@query("by_year", f"""WITH {BASE}
SELECT year, {_AMOUNTS}, count(DISTINCT customer_code) AS active_customers FROM base GROUP BY year ORDER BY year""")
def by_year(spark, sf_dir):
    return views.by_year(_lines(spark, sf_dir, ["year", "customer_code"]))


@query("by_category", f"""WITH {BASE}
SELECT category, {_AMOUNTS}, {SHARE} AS revenue_share_pct FROM base GROUP BY category ORDER BY revenue DESC""")
def by_category(spark, sf_dir):
    return views.by_category(_lines(spark, sf_dir, ["category"]))


@query("by_salesperson", f"""WITH {BASE}
SELECT salesperson, {_AMOUNTS}, {SHARE} AS revenue_share_pct FROM base GROUP BY salesperson ORDER BY revenue DESC""")
def by_salesperson(spark, sf_dir):
    return views.by_salesperson(_lines(spark, sf_dir, ["salesperson"]))


@query("by_segment", f"""WITH {BASE}
SELECT segment, {_AMOUNTS}, count(DISTINCT customer_code) AS customers, {SHARE} AS revenue_share_pct
FROM base GROUP BY segment ORDER BY revenue DESC""")
def by_segment(spark, sf_dir):
    return views.by_segment(_lines(spark, sf_dir, ["segment", "customer_code"]))


_BAND = ("CASE WHEN discount = 0 THEN '0 %' WHEN discount <= 0.05 THEN '1-5 %'"
         " WHEN discount <= 0.10 THEN '6-10 %' ELSE '> 10 %' END")


@query("by_discount_band", f"""WITH {BASE}
SELECT {_BAND} AS discount_band, count(*) AS line_count, {dbl('sum(revenue)')} AS revenue,
       {RATE} AS margin_rate_pct, {SHARE} AS revenue_share_pct
FROM base GROUP BY 1 ORDER BY min(discount)""")
def by_discount_band(spark, sf_dir):
    return views.by_discount_band(_lines(spark, sf_dir, ["discount_band"]))


def _budget_sql(axis: str, bud_filter: str = "", act_filter: str = "", extra: str = "") -> str:
    key = "b.period" if axis == "month" else "r.r_name"

    def block(what: str) -> str:
        a, b = f"a.{what}", f"b.{what}"
        return (
            f"{dbl(f'COALESCE({a}, 0)')} AS actual_{what}, {dbl(b)} AS budget_{what}, "
            f"{dbl(f'COALESCE({a}, 0) - {b}')} AS variance_{what}, "
            f"{ratio(f'COALESCE({a}, 0) - {b}', b)} AS variance_{what}_pct"
        )

    return f"""act AS (SELECT {axis}, sum(revenue) AS revenue, sum(margin) AS margin FROM base {act_filter} GROUP BY 1),
bud AS (SELECT {key} AS {axis}, sum(budget_revenue) AS revenue, sum(budget_margin) AS margin
        FROM budget b JOIN region r ON b.region_code = r.r_regionkey {bud_filter} GROUP BY 1),
plan AS (SELECT COALESCE(b.{axis}, a.{axis}) AS {axis}, {block('revenue')}, {block('margin')}{extra}
        FROM bud b FULL OUTER JOIN act a ON a.{axis} = b.{axis})"""


@query("budget_monthly", f"WITH {BASE}, {BUDGET}, {_budget_sql('month')} SELECT * FROM plan ORDER BY month")
def budget_monthly(spark, sf_dir):
    s = star(spark, sf_dir)
    return views.budget_monthly(facts.delivered_lines(s, ["month"], delivered=DELIVERED), s)


@query("budget_by_region", f"WITH {BASE}, {BUDGET}, {_budget_sql('region')} SELECT * FROM plan ORDER BY actual_revenue DESC")
def budget_by_region(spark, sf_dir):
    s = star(spark, sf_dir)
    return views.budget_by_region(facts.delivered_lines(s, ["region"], delivered=DELIVERED), s)


_YEARS = [str(y) for y in range(1995, 2002)]
_MIX = f"""shares AS (
  SELECT category, year, {ratio('sum(revenue)', 'sum(sum(revenue)) OVER (PARTITION BY year)')} AS share
  FROM base GROUP BY category, year)
SELECT category, {', '.join(f"max(CASE WHEN year = '{y}' THEN share END) AS part_{y}" for y in _YEARS)}
FROM shares GROUP BY category"""


@query("category_mix", f"WITH {BASE}, {_MIX} ORDER BY category")
def category_mix(spark, sf_dir):
    return views.category_mix(_lines(spark, sf_dir, ["category", "year"], cost=False))


@query("category_mix_filled", f"""WITH {BASE}, mix AS (WITH {_MIX})
SELECT category, {', '.join(f"COALESCE(part_{y}, 0) AS part_{y}" for y in _YEARS)} FROM mix""")
def category_mix_filled(spark, sf_dir):
    return category_mix(spark, sf_dir).fillna(0)


PARETO = f"""per_customer AS (SELECT customer_code, sum(revenue) AS revenue FROM base GROUP BY 1),
pareto AS (SELECT customer_code, row_number() OVER w AS rank, {dbl('revenue')} AS revenue,
  {ratio('sum(revenue) OVER (w ROWS UNBOUNDED PRECEDING)', 'sum(revenue) OVER ()')} AS cumulative_pct
  FROM per_customer WINDOW w AS (ORDER BY revenue DESC, customer_code))"""


@query("client_pareto", f"WITH {BASE}, {PARETO} SELECT rank, revenue, cumulative_pct FROM pareto ORDER BY rank")
def client_pareto(spark, sf_dir):
    return views.client_pareto(_lines(spark, sf_dir, ["customer_code"], cost=False))


@query("client_pareto_labelled", f"WITH {BASE}, {PARETO} SELECT * FROM pareto ORDER BY rank")
def client_pareto_labelled(spark, sf_dir):
    return views.client_pareto(_lines(spark, sf_dir, ["customer_code"], cost=False), with_code=True)


@query("pareto_80", f"""WITH {BASE}, {PARETO}
SELECT greatest(count(*) FILTER (WHERE cumulative_pct <= 80), 1) AS customers_for_share, count(*) AS customers,
       100.0 * CAST(greatest(count(*) FILTER (WHERE cumulative_pct <= 80), 1) AS DOUBLE) / count(*) AS customers_pct
FROM pareto""")
def pareto_80(spark, sf_dir):
    """By narrowing the range that holds the mark; the customers are not ranked."""
    return reporting.customers_for_mark(_lines(spark, sf_dir, ["customer_code"], cost=False))


def _top_sql(n: int) -> str:
    return f"""WITH {BASE}
SELECT company_name, segment, {dbl('sum(revenue)')} AS revenue, {SHARE} AS revenue_share_pct, {RATE} AS margin_rate_pct
FROM base GROUP BY company_name, segment ORDER BY sum(revenue) DESC, company_name, segment LIMIT {n}"""


@query("client_top", _top_sql(15))
def client_top(spark, sf_dir):
    return views.client_top(_lines(spark, sf_dir, ["company_name", "segment"]))


@query("client_top10", _top_sql(10))
def client_top10(spark, sf_dir):
    return views.client_top(_lines(spark, sf_dir, ["company_name", "segment"]), n=10)


SUMMARY = f"""mon AS ({MONTHLY}),
yr AS (SELECT year, sum(revenue) AS revenue, {RATE} AS rate, count(DISTINCT customer_code) AS customers FROM base GROUP BY year),
tot AS (SELECT sum(revenue) AS revenue, sum(margin) AS margin FROM base),
bud_tot AS (SELECT sum(budget_revenue) AS revenue, sum(budget_margin) AS margin FROM budget),
ends AS (SELECT min_by({dbl('revenue')}, year) AS first_revenue, max_by({dbl('revenue')}, year) AS last_revenue,
                min_by(rate, year) AS first_rate, max_by(rate, year) AS last_rate, max(customers) AS customers FROM yr),
summary AS (SELECT {dbl('t.revenue')} AS revenue, {dbl('t.margin')} AS margin, {ratio('t.margin', 't.revenue')} AS margin_rate_pct,
       {dbl('b.revenue')} AS budget_revenue, {dbl('b.margin')} AS budget_margin,
       {dbl('t.revenue - b.revenue')} AS variance_revenue, {ratio('t.revenue - b.revenue', 'b.revenue')} AS variance_revenue_pct,
       {dbl('t.margin - b.margin')} AS variance_margin, {ratio('t.margin - b.margin', 'b.margin')} AS variance_margin_pct,
       100.0 * (last_revenue - first_revenue) / first_revenue AS revenue_yoy_pct,
       last_rate - first_rate AS margin_rate_delta_pts, e.customers AS active_customers
  FROM tot t, bud_tot b, ends e)"""


def summary_of(spark, sf_dir):
    s = star(spark, sf_dir)
    years = views.by_year(facts.delivered_lines(s, ["year", "customer_code"], delivered=DELIVERED))
    return views.summary(years, views.budget_totals(s))


@query("summary", f"WITH {BASE}, {BUDGET}, {SUMMARY} SELECT * FROM summary")
def summary(spark, sf_dir):
    return summary_of(spark, sf_dir)


_FILTERS = facts.Filters(
    months=[f"1996-{i:02d}" for i in range(1, 13)], regions=["ASIA", "EUROPE"], segments=["BUILDING", "MACHINERY"]
)
_WHERE = "WHERE month BETWEEN '1996-01' AND '1996-12' AND region IN ('ASIA', 'EUROPE')"


@query("monthly_filtered", f"""WITH {BASE}
SELECT month, {_AMOUNTS} FROM base {_WHERE} AND segment IN ('BUILDING', 'MACHINERY') GROUP BY month ORDER BY month""")
def monthly_filtered(spark, sf_dir):
    return views.monthly(_lines(spark, sf_dir, ["month"], _FILTERS))


_BUDGET_FILTERS = facts.Filters(months=_FILTERS.months, regions=_FILTERS.regions)


@query("budget_filtered", f"""WITH {BASE}, {BUDGET}, {_budget_sql('month',
    "WHERE b.period BETWEEN '1996-01' AND '1996-12' AND r.r_name IN ('ASIA', 'EUROPE')", _WHERE)}
SELECT * FROM plan ORDER BY month""")
def budget_filtered(spark, sf_dir):
    s = star(spark, sf_dir)
    base = facts.delivered_lines(s, ["month"], _BUDGET_FILTERS, DELIVERED)
    return views.budget_monthly(base, s, _BUDGET_FILTERS)


@query("budget_not_comparable", f"""WITH {BASE}, {BUDGET}, {_budget_sql('region', '', "WHERE segment IN ('BUILDING')")}
SELECT region, actual_revenue, budget_revenue, CAST(NULL AS DOUBLE) AS variance_revenue,
       CAST(NULL AS DOUBLE) AS variance_revenue_pct, actual_margin, budget_margin, CAST(NULL AS DOUBLE) AS variance_margin,
       CAST(NULL AS DOUBLE) AS variance_margin_pct, false AS budget_comparable FROM plan""")
def budget_not_comparable(spark, sf_dir):
    s = star(spark, sf_dir)
    filters = facts.Filters(segments=["BUILDING"])
    base = facts.delivered_lines(s, ["region"], filters, DELIVERED)
    return views.without_incomparable_variance(views.budget_by_region(base, s, filters), filters)


@query("filter_options", f"""WITH {BASE}
SELECT DISTINCT 'month' AS axis, month AS choice FROM base
UNION ALL SELECT DISTINCT 'region', r_name FROM region
UNION ALL SELECT DISTINCT 'segment', c_mktsegment FROM customer
UNION ALL SELECT DISTINCT 'salesperson', s_name FROM supplier""")
def filter_options(spark, sf_dir):
    options = views.filter_options(star(spark, sf_dir), DELIVERED)
    parts = [df.select(F.lit(axis).alias("axis"), F.col(axis).alias("choice")) for axis, df in options.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("active_customers_period", f"WITH {BASE} SELECT count(DISTINCT customer_code) AS active_customers_period FROM base")
def active_customers_period(spark, sf_dir):
    return views.active_customers_period(_lines(spark, sf_dir, ["customer_code"], cost=False))


@query("below_average_flag", f"""WITH {BASE},
cat AS (SELECT category, {RATE} AS margin_rate_pct FROM base GROUP BY category),
avg_rate AS (SELECT {RATE} AS r FROM base)
SELECT category, margin_rate_pct, margin_rate_pct < r AS below_average FROM cat, avg_rate""")
def below_average_flag(spark, sf_dir):
    from starproof.functions.text import below_average

    cube = facts.rollup_sum(_lines(spark, sf_dir, ["category"]), ["category"])
    overall = cube.select(m.pct(F.sum("margin"), F.sum("revenue"))).scalar()
    ranked = views.by_category(cube).select("category", "margin_rate_pct")
    return ranked.withColumn("below_average", below_average(F.col("margin_rate_pct"), overall)).orderBy("margin_rate_pct")


@query("leading_segment", f"""WITH {BASE}
SELECT segment, {_AMOUNTS}, count(DISTINCT customer_code) AS customers, {SHARE} AS revenue_share_pct
FROM base GROUP BY segment ORDER BY revenue DESC, segment LIMIT 1""")
def leading_segment(spark, sf_dir):
    return by_segment(spark, sf_dir).limit(1)


@query("line_metrics", f"""WITH {BASE}
SELECT month, year, category, CAST(count(*) AS BIGINT) AS line_count, {dbl('sum(revenue)')} AS revenue,
       {dbl('sum(revenue - margin)')} AS cost, {dbl('sum(margin)')} AS margin, {RATE} AS margin_rate_pct
FROM base GROUP BY ALL""")
def line_metrics(spark, sf_dir):
    base = _lines(spark, sf_dir, ["month", "year", "category"])
    return base.groupBy("month", "year", "category").agg(
        F.count(F.lit(1)).alias("line_count"), m.as_double(F.sum("revenue")).alias("revenue"),
        m.as_double(F.sum(F.col("revenue") - F.col("margin"))).alias("cost"),
        m.as_double(F.sum("margin")).alias("margin"),
        m.pct(F.sum("margin"), F.sum("revenue")).alias("margin_rate_pct"),
    )


@query("share_of_total_by_brand", f"""SELECT p.p_brand AS subcategory, {dbl(f"sum(rev)")} AS revenue,
       100.0 * {dbl('sum(rev)')} / NULLIF({dbl('sum(sum(rev)) OVER ()')}, 0) AS revenue_share_pct
FROM (SELECT l_partkey, CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS rev
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F') x
JOIN part p ON x.l_partkey = p.p_partkey GROUP BY 1""")
def share_of_total_by_brand(spark, sf_dir):
    s = star(spark, sf_dir)
    s["dim_product"] = s["dim_product"].withColumn("category", F.col("subcategory"))
    totals = facts.rollup_sum(facts.delivered_lines(s, ["category"], delivered=DELIVERED, cost=False), ["category"])
    shares = ranking.with_share(totals).withColumnRenamed("category", "subcategory")
    return shares.select("subcategory", m.as_double(F.col("revenue")).alias("revenue"), "revenue_share_pct")


@query("region_variance_flag", f"""WITH {BASE}, {BUDGET}, {_budget_sql('region')}
SELECT region, variance_revenue_pct, CASE WHEN variance_revenue_pct IS NULL THEN 'neutral'
       WHEN variance_revenue_pct >= 0 THEN 'favourable' ELSE 'unfavourable' END AS flag FROM plan ORDER BY 2""")
def region_variance_flag(spark, sf_dir):
    from starproof.functions.text import favourable

    view = budget_by_region(spark, sf_dir).select("region", "variance_revenue_pct")
    return view.withColumn("flag", favourable(F.col("variance_revenue_pct"))).orderBy("variance_revenue_pct", "region")


@query("segment_weight", f"""WITH {BASE} SELECT segment, {SHARE} AS revenue_share_pct FROM base GROUP BY segment ORDER BY 2""")
def segment_weight(spark, sf_dir):
    return by_segment(spark, sf_dir).select("segment", "revenue_share_pct").orderBy("revenue_share_pct", "segment")


@query("concentration_headline", f"""WITH {BASE}, {PARETO},
seg AS (SELECT segment, {SHARE} AS share, count(DISTINCT customer_code) AS n FROM base GROUP BY 1 ORDER BY sum(revenue) DESC LIMIT 1),
core AS (SELECT greatest(count(*) FILTER (WHERE cumulative_pct <= 80), 1) AS k, count(*) AS total FROM pareto)
SELECT segment || ' : ' || format('{{:.0f}}', share) || ' % du CA pour ' || n || ' clients   |   base diversifiée : ' || k || ' clients ('
       || format('{{:.0f}}', 100.0 * CAST(k AS DOUBLE) / total) || ' %) pour 80 % du CA' AS headline FROM seg, core""")
def concentration_headline(spark, sf_dir):
    from starproof.functions.text import concentration

    core = pareto_80(spark, sf_dir).select(F.struct("*")).scalar()
    return leading_segment(spark, sf_dir).withColumn("core", core).select(
        concentration(
            F.col("segment"), F.col("revenue_share_pct"), F.col("customers"),
            F.col("core.customers_for_share"), F.col("core.customers_pct"),
        ).alias("headline")
    )


_COUNTS = {
    "summary": "1", "by_year": "count(DISTINCT year)", "monthly": "count(DISTINCT month)", "by_category": "count(DISTINCT category)",
    "budget_monthly": "count(DISTINCT month)", "budget_by_region": "count(DISTINCT region)", "category_mix": "count(DISTINCT category)",
    "by_salesperson": "count(DISTINCT salesperson)", "by_segment": "count(DISTINCT segment)",
    "client_pareto": "count(DISTINCT customer_code)", "client_top": "least(count(DISTINCT company_name || segment), 15)",
    "by_discount_band": f"count(DISTINCT {_BAND})",
}


@query("all_views", f"WITH {BASE} " + " UNION ALL ".join(f"SELECT '{v}' AS view, {n} AS rows FROM base" for v, n in _COUNTS.items())
       .replace("SELECT 'summary' AS view, 1 AS rows FROM base", "SELECT 'summary' AS view, CAST(1 AS BIGINT) AS rows"))
def all_views(spark, sf_dir):
    """The twelve views together, from one pass over the facts."""
    out = None
    for name, view in views.build_views(star(spark, sf_dir), delivered=DELIVERED).items():
        row = view.agg(F.lit(name).alias("view"), F.count(F.lit(1)).alias("rows"))
        out = row if out is None else out.unionByName(row)
    return out


_RESULT = ("revenue", "margin", "margin_rate_pct")
_PLAN = ("actual_revenue", "budget_revenue", "variance_revenue", "variance_revenue_pct",
         "actual_margin", "budget_margin", "variance_margin", "variance_margin_pct")
#: Keys and measures of each view with a fixed layout; category_mix has a column per year and a query of its own.
_LAYOUT = {
    "summary": ((), (*_RESULT, "budget_revenue", "budget_margin", "variance_revenue", "variance_revenue_pct", "variance_margin",
                     "variance_margin_pct", "revenue_yoy_pct", "margin_rate_delta_pts", "active_customers")),
    "by_year": (("year",), (*_RESULT, "active_customers")), "monthly": (("month",), _RESULT),
    "by_category": (("category",), (*_RESULT, "revenue_share_pct")),
    "budget_monthly": (("month",), _PLAN), "budget_by_region": (("region",), _PLAN),
    "by_salesperson": (("salesperson",), (*_RESULT, "revenue_share_pct")),
    "by_segment": (("segment",), (*_RESULT, "customers", "revenue_share_pct")),
    "client_pareto": (("rank",), ("revenue", "cumulative_pct")),
    "client_top": (("company_name", "segment"), ("revenue", "revenue_share_pct", "margin_rate_pct")),
    "by_discount_band": (("discount_band",), ("line_count", "revenue", "margin_rate_pct", "revenue_share_pct")),
}


def _values_sql(view: str) -> str:
    keys, measures = _LAYOUT[view]
    key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys) or "''"
    names, values = ", ".join(f"'{x}'" for x in measures), ", ".join(dbl(x) for x in measures)
    return f"SELECT '{view}' AS view, {key} AS key, unnest([{names}]) AS measure, unnest([{values}]) AS value FROM ({QUERIES[view].sql})"


@query("all_views_values", " UNION ALL ".join(_values_sql(v) for v in _LAYOUT))
def all_views_values(spark, sf_dir):
    """Every value of the views that one pass over the facts gives, as (view, key, measure, value)."""
    out = None
    built = views.build_views(star(spark, sf_dir), delivered=DELIVERED)
    for view, (keys, measures) in _LAYOUT.items():
        long = F.explode(F.array(*[F.struct(F.lit(x).alias("measure"), F.col(x).cast("double").alias("value")) for x in measures]))
        part = built[view].select(
            F.lit(view).alias("view"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"), long.alias("v")
        ).select("view", "key", "v.measure", "v.value")
        out = part if out is None else out.unionByName(part)
    return out
