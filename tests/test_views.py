import random
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starproof.operators import facts, ranking
from starproof.operators.facts import Filters
from starproof.plans import reporting, views
import stars


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def shop_views(spark):
    built = views.build_views(stars.shop(spark))
    return {k: rows(v) for k, v in built.items()}


def test_twelve_views(shop_views):
    assert set(shop_views) == {
        "summary", "by_year", "monthly", "by_category", "budget_monthly", "budget_by_region", "category_mix",
        "by_salesperson", "by_segment", "client_pareto", "client_top", "by_discount_band",
    }


def near(x):
    return pytest.approx(x, rel=1e-9)


def test_values_follow_from_the_lines(shop_views):
    revenue, margin = stars.SHOP_REVENUE, stars.SHOP_MARGIN
    s = shop_views["summary"][0]
    assert (s["revenue"], s["margin"], s["margin_rate_pct"]) == (near(revenue), near(margin), near(100 * margin / revenue))
    assert (s["variance_revenue"], s["variance_margin"]) == (near(revenue - 1800), near(margin - 650))
    assert s["revenue_yoy_pct"] is None and s["margin_rate_delta_pts"] is None and s["active_customers"] == 1
    by_category = {r["category"]: r for r in shop_views["by_category"]}
    for line in stars.SHOP_SOLD:
        r, m = stars.revenue(line), stars.margin(line)
        got = by_category.pop(stars.CATEGORIES[line[2]])
        assert got == {"category": got["category"], "revenue": near(r), "margin": near(m), "margin_rate_pct": near(100 * m / r),
                       "revenue_share_pct": near(100 * r / revenue)}
    assert not by_category
    assert shop_views["client_pareto"] == [{"rank": 1, "revenue": near(revenue), "cumulative_pct": 100.0}]
    assert sorted((r["discount_band"], r["line_count"]) for r in shop_views["by_discount_band"]) == [("0 %", 2), ("1-5 %", 1)]
    assert {r["category"]: r["part_2023"] for r in shop_views["category_mix"]} == {
        stars.CATEGORIES[x[2]]: near(100 * stars.revenue(x) / revenue) for x in stars.SHOP_SOLD}
    assert sum(r["variance_revenue"] or 0 for r in shop_views["budget_monthly"]) == near(revenue - 1800)


def test_revenue_equals_the_reconciled_figure(spark, shop_views):
    star = stars.shop(spark)
    assert reporting.delivered_revenue(star["fact_line"], star["fact_order"]).first()[0] == shop_views["summary"][0]["revenue"]


@pytest.mark.parametrize("filters, line, budget", [
    (Filters(months=["2022-11"]), stars.NORTH, 260.0), (Filters(regions=["Ouest"]), stars.WEST, 170.0),
    (Filters(segments=["Indépendants"]), stars.NORTH, 430.0), (Filters(salespeople=["Marius"]), stars.WEST, 430.0),
])
def test_each_filter_leaves_one_part(spark, filters, line, budget):
    built = views.build_views(stars.two_regions(spark), filters)
    s = rows(built["summary"])[0]
    assert s["revenue"] == near(stars.revenue(line)) and s["revenue_yoy_pct"] is None
    assert sum(r["revenue_share_pct"] for r in rows(built["by_category"])) == near(100.0)
    assert s["budget_revenue"] == budget


def test_filters_on_a_stored_base_give_the_same(spark):
    star = stars.two_regions(spark)
    base = views.stored_base(star)
    for filters in (Filters(), Filters(months=["2023-11"], segments=["PME"]), Filters(regions=["Ouest"], salespeople=["Odile"])):
        a, b = views.build_views(star, filters), views.build_views(star, filters, base=base)
        for name in ("summary", "by_category", "budget_by_region", "client_pareto", "by_salesperson"):
            assert rows(a[name]) == rows(b[name])


def test_no_filter_and_empty_selection_are_the_same(spark):
    star = stars.two_regions(spark)
    before, after = stars.revenue(stars.NORTH), stars.revenue(stars.WEST)
    delta = 100 * stars.margin(stars.WEST) / after - 100 * stars.margin(stars.NORTH) / before
    for filters in (Filters(), Filters(months=[], regions=[])):
        built = views.build_views(star, filters)
        s = rows(built["summary"])[0]
        assert s["revenue"] == near(before + after) and s["revenue_yoy_pct"] == near(100 * (after - before) / before)
        assert s["margin_rate_delta_pts"] == near(delta)


def test_filter_without_match(spark):
    built = views.build_views(stars.two_regions(spark), Filters(months=["1987-02"]))
    s = rows(built["summary"])[0]
    assert s["revenue"] == 0.0 and s["margin_rate_pct"] is None and s["active_customers"] == 0
    assert rows(built["monthly"]) == [] and rows(built["client_pareto"]) == []


def test_selection_rules():
    assert facts.selection([], ["a", "b"]) is None and facts.selection(["a", "b"], ["a", "b"]) is None
    assert facts.selection(["a"], ["a", "b"]) == ["a"]
    assert facts.month_range("2024-01", "2024-02", ["2024-01", "2024-02", "2024-03"]) == ["2024-01", "2024-02"]
    assert Filters(months=["2024-01"]).budget_comparable and not Filters(segments=["PME"]).budget_comparable


def test_unknown_dimension_stays_visible(spark):
    star = stars.shop(spark, dim_customer=[], dim_product=[stars.product("cup")])
    got = facts.delivered_lines(star, ["segment", "category"]).collect()
    want = [(stars.CATEGORIES["cup"] if x[2] == "cup" else "", None, near(stars.revenue(x)), x[2] != "cup") for x in stars.SHOP_SOLD]
    key = lambda r: (r[0], float(r[2]) if isinstance(r[2], float) else r[2].expected)
    assert sorted(((r.category or "", r.segment, float(r.revenue), r.margin is None) for r in got), key=key) == sorted(want, key=key)


def test_order_multiplicity_and_null_discount(spark):
    lines = [(*stars.SHOP_LINES[0][:5], None), stars.SHOP_LINES[2]]
    star = stars.shop(spark, fact_line=lines)
    bands = {r["discount_band"]: r for r in rows(views.by_discount_band(facts.delivered_lines(star, ["discount_band"])))}
    assert bands["> 10 %"]["line_count"] == 1 and bands["> 10 %"]["revenue"] is None


# --- reporting bridge -----------------------------------------------------------

D = date(2023, 8, 9)


def sold(*lines, order="o", day=D, person="V7", status="Livrée"):
    return [(order, day, "K1", person, status)], [(str(i), order, "cup", q, p, d) for i, (q, p, d) in enumerate(lines)]


def test_discount_applies(spark):
    _, by_month, by_rep = reporting.reporting_views(stars.journal(spark, *sold((6, 45.0, 0.15))))
    amount = near(6 * 45.0 * 0.85)
    assert rows(by_month) == [{"month": "2023-08", "revenue": amount}] and rows(by_rep) == [{"salesperson": "Odile", "revenue": amount}]


def test_missing_price_keeps_the_line(spark):
    lines, by_month, _ = reporting.reporting_views(stars.journal(spark, *sold((2, 31.5, 0.0), (4, None, 0.0))))
    assert lines.count() == 2 and lines.filter("amount IS NULL").count() == 1
    assert rows(by_month)[0]["revenue"] == 63.0
    k = reporting.dashboard_kpis(lines).first()
    assert (k.total_revenue, k.valid_line_count, k.active_months, k.last_mom_growth_pct) == (63.0, 1, 1, None)


def test_missing_date_has_no_month(spark):
    lines, by_month, _ = reporting.reporting_views(stars.journal(spark, *sold((3, 8.0, 0.0), day=None)))
    assert lines.first().month is None and by_month.count() == 0
    k = reporting.dashboard_kpis(lines).first()
    assert (k.total_revenue, k.active_months, k.best_month, k.monthly_avg_revenue) == (24.0, 0, None, 0.0)


def test_unknown_salesperson_is_kept(spark):
    lines, _, by_rep = reporting.reporting_views(stars.journal(spark, *sold((5, 12.0, 0.0), person="nobody")))
    assert float(lines.first().amount) == 60.0 and lines.first().salesperson is None and by_rep.count() == 0


def test_only_delivered_counts(spark):
    parts = [sold((1, price, 0.0), order=status, status=status) for status, price in (("Livrée", 14.0), ("Retour", 70.0), ("Annulée", 88.0))]
    got, _, _ = reporting.reporting_views(stars.journal(spark, sum((o for o, _ in parts), []), sum((x for _, x in parts), [])))
    assert [float(r.amount) for r in got.collect()] == [14.0]


def test_kpis_and_series(spark):
    prices = [24.0, 90.0, 0.0, 45.0, 45.0]
    people = ("V7", "V7", "V8", "V8", "V8")
    parts = [sold((1, p, 0.0), order=f"o{i}", day=date(2023, i, 5), person=v) for i, (p, v) in enumerate(zip(prices, people), start=1)]
    star = stars.journal(spark, sum((o for o, _ in parts), []), sum((x for _, x in parts), []), people=(("V7", "Odile"), ("V8", "Marius")))
    got, by_month, _ = reporting.reporting_views(star)
    k = reporting.dashboard_kpis(got).first()
    assert (k.best_month, k.worst_month, k.top_salesperson, k.top_salesperson_revenue, k.active_salespeople) == (
        "2023-02", "2023-03", "Odile", prices[0] + prices[1], 2)
    assert (k.last_mom_growth_pct, k.average_basket, k.monthly_avg_revenue) == (0.0, near(sum(prices) / 5), near(sum(prices) / 5))
    assert [r["cumulative_revenue"] for r in rows(reporting.cumulative_revenue(by_month))] == [sum(prices[: i + 1]) for i in range(5)]
    change = [(f"2023-{i + 1:02d}", 100 * (b - a) / a if a else None) for i, (a, b) in enumerate(zip(prices, prices[1:]), start=1)]
    got = [(r["month"], r["variation_pct"]) for r in rows(reporting.month_over_month(by_month))]
    assert got in ([(m, near(v) if v is not None else None) for m, v in change], [(m, near(v)) for m, v in change if v is not None])


# --- ranking ---------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["decimal(18,4)", "decimal(38,8)", "double"])
def test_share_mark_equals_the_ranked_curve(spark, monkeypatch, kind):
    """Ties at the mark, nulls, zeros and negative values, ranges narrowed many times, totals of nothing or less."""
    monkeypatch.setattr(ranking, "FEW", 2)
    monkeypatch.setattr(ranking, "BUCKETS", 4)
    rng = random.Random(5)
    cases = [[rng.choice([1, 2, 2, 5, 100, 1000]) for _ in range(300)], [rng.random() * 10 ** rng.randrange(6) for _ in range(400)],
             [7] * 50, [0.0001 * i for i in range(100)], [5, -1, -1, None, 0, 0], [None, None], [], [-3, -4], [3, -3], [10], [8, 2], [4, 4, 2]]
    for values in cases:
        frame = spark.createDataFrame([(f"k{i}", None if v is None else float(v)) for i, v in enumerate(values)], "k string, v double")
        frame = frame.select("k", F.col("v").cast(kind).alias("v"))
        got = ranking.rows_within_share(frame, "v", 80.0)
        curve = ranking.running_share(frame, "k", "v", partitions=3)
        assert got == (curve.filter("cumulative_pct <= 80").count(), len(values)), values


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_running_share_equals_one_global_window(spark, partitions):
    # a third of all customers share one value, two values are missing
    df = spark.range(3000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") < 2, None).when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") * 7919 % 1000).cast("decimal(28,6)").alias("revenue"),
    )
    got = ranking.running_share(df, "k", partitions=partitions)
    w = Window.orderBy(F.col("revenue").desc_nulls_last(), "k").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", F.row_number().over(Window.orderBy(F.col("revenue").desc_nulls_last(), "k")).alias("rank"), F.sum("revenue").over(w).alias("cumulative"))
    assert sorted(map(tuple, got.select("k", "rank", "cumulative").collect())) == sorted(map(tuple, want.collect()))
    sizes = [r["count"] for r in got.groupBy(F.floor(F.col("rank") / 400)).count().collect()]
    assert sum(sizes) == 3000


def test_results_do_not_depend_on_partitions(spark):
    star = stars.two_regions(spark)
    base = facts.delivered_lines(star, ["month", "segment", "customer_code"])
    one = rows(views.by_segment(base.coalesce(1)))
    assert one == rows(views.by_segment(base.repartition(7)))
