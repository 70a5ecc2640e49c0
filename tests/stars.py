"""Small invented stars; expectations are computed from their rows, not written down."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

SCHEMAS = {
    "dim_region": "region_code string, region_name string",
    "dim_salesperson": "salesperson_code string, name string, region_code string, hire_date date",
    "dim_product": "product_code string, label string, category string, subcategory string,"
                   " unit_cost decimal(28,8), list_price decimal(28,8), supplier string",
    "dim_customer": "customer_code string, company_name string, segment string, venue_type string,"
                    " region_code string, city string, salesperson_code string, first_order_date date",
    "fact_order": "order_id string, order_date date, customer_code string, salesperson_code string, status string",
    "fact_line": "line_id string, order_id string, product_code string, quantity bigint, unit_price double, discount_rate double",
    "fact_budget": "period string, region_code string, category string, budget_revenue double, budget_margin double",
}

COSTS = {"cup": 1.25, "oven": 310.0, "apron": 7.5}
CATEGORIES = {"cup": "Consommables", "oven": "Gros équipement", "apron": "Mobilier"}


def make(spark, **rows):
    return {t: spark.createDataFrame(rows.get(t, []), schema) for t, schema in SCHEMAS.items()}


def product(code):
    return (code, code, CATEGORIES[code], None, Decimal(str(COSTS[code])), None, None)


def customer(code, segment, region):
    return (code, f"Maison {code}", segment, None, region, None, None, date(2018, 6, 30))


#: One delivered order of three lines in spring, one returned order.
SHOP_LINES = [("l1", "spring", "cup", 240, 2.75, 0.0), ("l2", "spring", "oven", 3, 499.0, 0.04), ("l3", "spring", "apron", 11, 16.0, 0.0),
              ("l1", "back", "oven", 1, 520.0, 0.0)]


def shop(spark, **changes):
    rows = dict(
        dim_region=[("R03", "Est")],
        dim_salesperson=[("V7", "Odile", "R03", date(2017, 9, 4))],
        dim_product=[product(p) for p in COSTS],
        dim_customer=[customer("K1", "Grands Comptes", "R03")],
        fact_order=[("spring", date(2023, 4, 18), "K1", "V7", "Livrée"), ("back", date(2023, 4, 25), "K1", "V7", "Retour")],
        fact_line=SHOP_LINES,
        fact_budget=[("2023-04", "R03", "Gros équipement", 1800.0, 650.0)],
    )
    return make(spark, **{**rows, **changes})


def revenue(line):
    return line[3] * line[4] * (1 - line[5])


def margin(line):
    return revenue(line) - line[3] * COSTS[line[2]]


SHOP_SOLD = [x for x in SHOP_LINES if x[1] == "spring"]
SHOP_REVENUE = sum(map(revenue, SHOP_SOLD))
SHOP_MARGIN = sum(map(margin, SHOP_SOLD))


def shop_reports(spark):
    one = lambda schema, row: spark.createDataFrame([row], schema)
    return {
        "sales": one("rows_after_dedup bigint, invalid_dates bigint, invalid_amounts bigint", (len(SHOP_LINES), 2, 5)),
        "products": one("categories_canonical bigint", (len(COSTS),)),
        "customers": one("invalid_segments bigint, distinct_segments bigint", (0, 1)),
        "budget": one(
            "rows bigint, regions bigint, categories bigint, periods bigint, leaked_subtotals bigint,"
            " missing_amounts bigint, duplicate_keys bigint", (1, 1, 1, 1, 0, 0, 0)),
    }


def shop_expected(spark, **changes):
    row = dict(ca_reconcilie_attendu_eur=SHOP_REVENUE, nb_lignes_apres_dedup=len(SHOP_LINES), nb_dates_invalides_attendu=2,
               nb_montants_invalides_attendu=5, nb_categories_apres_normalisation=len(COSTS))
    row.update(changes)
    schema = ", ".join(f"{k} {'double' if k.startswith('ca') else 'bigint'}" for k in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def journal(spark, orders, lines, people=(("V7", "Odile"),)):
    """Facts and salespeople only."""
    return make(
        spark, fact_order=orders, fact_line=lines,
        dim_salesperson=[(c, n, "R03", None) for c, n in people],
    )


#: Every axis splits these facts in two parts of different size: 2022 in the north, 2023 in the west.
NORTH, WEST = ("l1", "n", "cup", 70, 3.5, 0.1), ("l1", "w", "apron", 9, 21.0, 0.0)


def two_regions(spark):
    return make(
        spark,
        dim_region=[("R02", "Nord"), ("R05", "Ouest")],
        dim_salesperson=[("V7", "Odile", "R02", None), ("V8", "Marius", "R05", None)],
        dim_product=[product("cup"), product("apron")],
        dim_customer=[customer("K1", "Indépendants", "R02"), customer("K2", "PME", "R05")],
        fact_order=[("n", date(2022, 11, 3), "K1", "V7", "Livrée"), ("w", date(2023, 11, 7), "K2", "V8", "Livrée")],
        fact_line=[NORTH, WEST],
        fact_budget=[("2022-11", "R02", "Consommables", 260.0, 130.0), ("2023-11", "R05", "Mobilier", 170.0, 95.0)],
    )
