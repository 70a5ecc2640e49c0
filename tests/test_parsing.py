from datetime import date
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from starproof import specs
from starproof.functions import measures as m
from starproof.functions import parsing, text
from starproof.operators import schema


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw, want", [
    ("3\u00a0000,52", 3000.52), ("3 000,52", 3000.52), ("17,75", 17.75), ("11.73", 11.73), ("5", 5.0), ("100022", 100022.0),
    ("-4,5", -4.5), ("abc", None), ("N/A", None), (None, None), ("", None), ("12d", None), ("NaN", None), ("Infinity", None),
    ("1,2,3", None),
])
def test_french_amount(spark, raw, want):
    got = one(spark, raw, parsing.french_amount)
    assert (None if got is None else float(got)) == want


@pytest.mark.parametrize("raw, want", [
    ("20/01/2024", date(2024, 1, 20)), ("2019-06-12", date(2019, 6, 12)), ("1/2/2024", date(2024, 2, 1)),
    ("32/13/2024", None), ("31/02/2024", None), ("01/01/20245", None), ("", None), (None, None), ("2024/01/20", None),
])
def test_strict_date(spark, raw, want):
    assert one(spark, raw, parsing.strict_date) == want


def test_single_format_refuses_the_other(spark):
    assert one(spark, "2019-06-12", lambda c: parsing.strict_date(c, (parsing.FRENCH_DATE,))) is None


@pytest.mark.parametrize("raw, want", [("12", 12), ("12.0", 12), ("12.5", None), ("x", None), (None, None), (" 7 ", 7)])
def test_whole_number(spark, raw, want):
    assert one(spark, raw, parsing.whole_number) == want


@pytest.mark.parametrize("raw, want", [("6.1", "0.061"), ("5", "0.05"), ("0.0", "0"), ("6,1", None), ("x", None)])
def test_points_to_rate(spark, raw, want):
    got = one(spark, raw, parsing.points_to_rate)
    assert got == (None if want is None else Decimal(want))


@pytest.mark.parametrize("raw, want", [
    ("consommables", "Consommables"), ("Conso.", "Consommables"), (" CONSO. ", "Consommables"),
    ("hygiene et entretien", "Hygiène & Entretien"), ("Mobilier", "Mobilier"), (" Autre ", "Autre"), (None, None),
])
def test_category(spark, raw, want):
    assert one(spark, raw, parsing.canonical_category) == want


@pytest.mark.parametrize("raw, want", [
    ("pme", "PME"), ("PME ", "PME"), ("INDÉPENDANTS", "Indépendants"), ("grands comptes", "Grands Comptes"),
    (" Pme", "PME"), ("Autre", "Autre"), (None, None),
])
def test_segment(spark, raw, want):
    assert one(spark, raw, parsing.canonical_segment) == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.decimals(min_value=-10**9, max_value=10**9, places=2), min_size=1, max_size=50))
def test_amount_text_round_trip(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    back = df.select("v", parsing.french_amount(text.raw_amount(F.col("v"))).cast("double").alias("b")).collect()
    assert all(abs(r.v - r.b) < 1e-6 for r in back)


def test_headers_and_required_columns(spark):
    raw = spark.createDataFrame(
        [("01/01/2024", "O1", "1", "C", "P", "2", "3,5", "0", "S", "Livrée", "z")],
        ["Date Commande", "N° Commande", "N° Ligne", "Code Client", "Code Produit", "Quantité ", "PU Vente HT ",
         "Remise %", "Code Commercial", " STATUT", "Libre "],
    )
    named = schema.normalise_headers(raw, specs.SALES)
    assert named.columns == [
        "order_date", "order_id", "line_id", "customer_code", "product_code", "quantity", "unit_price",
        "discount_rate", "salesperson_code", "status", "libre",
    ]
    schema.require_columns(named, specs.SALES)
    with pytest.raises(ValueError, match="unit_price"):
        schema.require_columns(named.drop("unit_price"), specs.SALES)


def test_columns_with_one_meaning_are_merged(spark):
    raw = spark.createDataFrame([("P1", None, "b"), ("P2", "a", "b")], "code_produit string, libelle string, `Libellé ` string")
    merged = schema.normalise_headers(raw, specs.PRODUCTS)
    assert merged.columns == ["product_code", "label"]
    assert [r.label for r in merged.orderBy("product_code").collect()] == ["b", "a"]


def test_coerce_types_and_empty_frames(spark):
    raw = spark.createDataFrame([(" P1 ", "11,73", "erreur")], "product_code string, unit_cost string, list_price string")
    row = schema.coerce(raw, specs.PRODUCTS).first()
    assert (row.product_code, float(row.unit_cost), row.list_price) == ("P1", 11.73, None)
    empty = schema.coerce(raw.limit(0), specs.PRODUCTS)
    assert empty.count() == 0 and dict(empty.dtypes)["unit_cost"] == "decimal(28,8)"


@pytest.mark.parametrize("rate, band", [(0.0, "0 %"), (0.05, "1-5 %"), (0.07, "6-10 %"), (0.10, "6-10 %"), (0.2, "> 10 %"), (None, "> 10 %")])
def test_discount_band(spark, rate, band):
    assert one(spark, rate, m.discount_band, "double") == band
    exact = None if rate is None else Decimal(str(rate))
    assert one(spark, exact, m.discount_band, "decimal(12,8)") == band


def test_line_amounts(spark):
    df = spark.createDataFrame([(10, 100.0, 0.2, 60.0), (1, None, 0.0, 1.0)], "q bigint, p double, d double, c double")
    rows = df.select(m.line_revenue(F.col("q"), F.col("p"), F.col("d")), m.line_cost(F.col("q"), F.col("c"))).collect()
    assert [None if v is None else float(v) for r in rows for v in r] == [800.0, 600.0, None, 1.0]


@pytest.mark.parametrize("fn, value, want", [
    (text.money, 1234567.89, "1 234 567,89 €"), (lambda c: text.money(c, 0), 1234567.0, "1 234 567 €"), (text.money, None, "—"),
    (text.integer, 57219.9, "57 219"), (text.percent, 16.94, "16,9 %"), (lambda c: text.percent(c, True), 16.94, "+16,9 %"),
    (text.percent, None, "—"), (text.signed_percent, None, "n/a"), (text.signed_percent, -3.0, "-3,0 %"),
    (text.signed_points, -2.12, "-2,1 pts"), (text.compact_money, 2_300_000.0, "2.3M €"), (text.compact_money, 1_250_000.0, "1.2M €"),
    (text.compact_money, 12_500.0, "12k €"), (text.compact_money, 850.0, "850 €"), (text.axis_percent, 0.0, "0 %"),
    (text.axis_percent, 2.5, "+2.5 %"), (lambda c: text.axis_percent(c, False), 33.4, "33 %"),
    (text.favourable, None, "neutral"), (text.favourable, 0.0, "favourable"), (lambda c: text.favourable(c, False), 1.0, "unfavourable"),
])
def test_display_text(spark, fn, value, want):
    assert one(spark, value, fn, "double") == want


NARRATIVE = "revenue double, revenue_yoy_pct double, margin_rate_pct double, margin_rate_delta_pts double, variance_revenue_pct double, variance_margin_pct double"


@pytest.mark.parametrize("row, present, absent", [
    ((1e6, 16.9, 26.6, -2.1, -3.8, -3.5), ["hausse de 16,9 %", "recul de 2,1 pts", "sous le budget de 3,8 %", "Point d'attention", "érosion"], []),
    ((1e6, None, 26.6, None, -3.8, -3.5), ["1 000 000 € sur la période"], ["Point d'attention", "N-1"]),
    ((1e6, 5.0, 30.0, 1.5, 2.0, 3.0), ["progression de 1,5 pts", "au-dessus du budget"], ["Point d'attention"]),
])
def test_narrative(spark, row, present, absent):
    got = spark.createDataFrame([row], NARRATIVE).select(text.narrative()).first()[0]
    assert all(p in got for p in present) and not any(a in got for a in absent)


@pytest.mark.parametrize("value, want", [(-0.0, "0,00 €"), (-0.001, "0,00 €"), (-0.01, "-0,01 €"), (-100.0, "-100,00 €"), (0.0, "0,00 €")])
def test_zero_money_has_no_sign(spark, value, want):
    assert one(spark, value, text.money, "double") == want
    assert one(spark, value, text.raw_amount, "double") == want.removesuffix(" €")
