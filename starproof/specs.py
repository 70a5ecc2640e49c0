"""Declared schemas and business reference data.

Everything the cleaning code needs to know about a source is stated here once;
the operators derive header mapping, required-column checks and type
expressions from these declarations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Wide enough for any price as exported: 20 digits before the comma, 8 behind it.
MONEY = T.DecimalType(28, 8)
RATE = T.DecimalType(12, 8)
LINE_MONEY = T.DecimalType(28, 6)

DATE, AMOUNT, INTEGER, TEXT = "date", "amount", "integer", "text"

_SPARK_TYPES = {DATE: T.DateType(), AMOUNT: MONEY, INTEGER: T.LongType(), TEXT: T.StringType()}


@dataclass(frozen=True)
class Field:
    """One canonical column: its kind, its raw header spellings, its policy."""

    name: str
    kind: str
    headers: tuple[str, ...] = ()
    required: bool = True
    nullable: bool = False


@dataclass(frozen=True)
class Source:
    """One family of input files."""

    name: str
    file_glob: str
    fields: tuple[Field, ...]
    encoding: str | None = None
    separator: str = ";"

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def header_map(self) -> dict[str, str]:
        """Normalised raw header -> canonical column."""
        return {h: f.name for f in self.fields for h in (f.name, *f.headers)}

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, _SPARK_TYPES[f.kind]) for f in self.fields])

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


@dataclass(frozen=True)
class BudgetLayout:
    """Geometry of a wide budget sheet (row numbers start at 1)."""

    header_row: int
    region_header: str
    category_header: str
    subtotal_marker: str
    month_labels: tuple[str, ...]
    sheet_metrics: tuple[tuple[str, str], ...]


# ---------------------------------------------------------------------------
# Fixed values. File names, raw headers, labels and codes below are the ones
# found in the exports; they must be spelled exactly like this.
# ---------------------------------------------------------------------------

SALES = Source(
    name="sales",
    file_glob="export_ventes_*",
    fields=(
        Field("order_date", DATE, ("date_commande", "date commande")),
        Field("order_id", TEXT, ("commande_id", "n° commande", "n commande")),
        Field("line_id", TEXT, ("ligne_id", "n° ligne", "n ligne")),
        Field("customer_code", TEXT, ("code_client", "code client")),
        Field("product_code", TEXT, ("code_produit", "code produit")),
        Field("quantity", INTEGER, ("quantité", "quantite")),
        Field("unit_price", AMOUNT, ("prix_unitaire_vente", "pu vente ht", "pu vente", "prix unitaire")),
        Field("discount_rate", AMOUNT, ("remise_pct", "remise %", "remise")),
        Field("salesperson_code", TEXT, ("code_commercial", "code commercial")),
        Field("status", TEXT, ("statut",)),
    ),
)

CUSTOMERS = Source(
    name="customers",
    file_glob="export_clients_crm*",
    encoding="cp1252",
    fields=(
        Field("customer_code", TEXT, ("code_client",)),
        Field("company_name", TEXT, ("raison_sociale",), required=False),
        Field("segment", TEXT),
        Field("venue_type", TEXT, ("type_etablissement",), required=False),
        Field("region_code", TEXT, ("code_region",)),
        Field("city", TEXT, ("ville",), required=False),
        Field("salesperson_code", TEXT, ("code_commercial",), required=False),
        Field("first_order_date", DATE, ("date_premiere_commande",), nullable=True),
    ),
)

PRODUCTS = Source(
    name="products",
    file_glob="catalogue_produits*",
    fields=(
        Field("product_code", TEXT, ("code_produit",)),
        Field("label", TEXT, ("libelle", "libellé"), required=False),
        Field("category", TEXT, ("categorie", "catégorie")),
        Field("subcategory", TEXT, ("sous_categorie", "sous_catégorie"), required=False),
        Field("unit_cost", AMOUNT, ("cout_unitaire", "coût_unitaire")),
        Field("list_price", AMOUNT, ("prix_catalogue",)),
        Field("supplier", TEXT, ("fournisseur",), required=False),
    ),
)

SALESPEOPLE = Source(
    name="salespeople",
    file_glob="commerciaux*",
    encoding="utf-8",
    fields=(
        Field("salesperson_code", TEXT, ("code_commercial",)),
        Field("name", TEXT, ("nom",)),
        Field("region_code", TEXT, ("code_region",)),
        Field("hire_date", DATE, ("date_embauche",)),
    ),
)

BUDGET = Source(
    name="budget",
    file_glob="budget_*",
    fields=(
        Field("period", TEXT, ("periode",)),
        Field("region_name", TEXT, ("nom_region",)),
        Field("category", TEXT, ("categorie",)),
        Field("budget_revenue", AMOUNT, ("ca_budgete",)),
        Field("budget_margin", AMOUNT, ("marge_budgetee",)),
    ),
)

BUDGET_LAYOUT = BudgetLayout(
    header_row=3,
    region_header="Région",
    category_header="Catégorie",
    subtotal_marker="Sous-total",
    month_labels=(
        "Janv", "Févr", "Mars", "Avr", "Mai", "Juin",
        "Juil", "Août", "Sept", "Oct", "Nov", "Déc",
    ),
    sheet_metrics=(("CA", "budget_revenue"), ("Marge", "budget_margin")),
)

MANIFEST_NAME = "_manifest_anomalies.json"

DELIVERED = ("Livrée",)
STATUSES = ("Livrée", "Retour", "Annulée")
SEGMENTS = ("Grands Comptes", "PME", "Indépendants")
CATEGORIES = (
    "Consommables", "Ingrédients secs", "Hygiène & Entretien",
    "Petit équipement", "Gros équipement", "Mobilier",
)
CATEGORY_VARIANTS = {
    "consommables": "Consommables",
    "conso.": "Consommables",
    "hygiene et entretien": "Hygiène & Entretien",
}
REGIONS = {
    "R01": "Île-de-France",
    "R02": "Nord",
    "R03": "Est",
    "R04": "Sud",
    "R05": "Ouest",
}
DISCOUNT_BANDS = ("0 %", "1-5 %", "6-10 %", "> 10 %")

# Texts a spreadsheet or CSV reader takes as "no value" (pandas' documented list).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
ENCODING_CHAIN = ("utf-8-sig", "utf-8", "cp1252", "latin-1")
RECONCILIATION_TOLERANCE = 0.001

STAR_COLUMNS: dict[str, tuple[str, ...]] = {
    "dim_region": ("region_code", "region_name"),
    "dim_salesperson": ("salesperson_code", "name", "region_code", "hire_date"),
    "dim_product": (
        "product_code", "label", "category", "subcategory",
        "unit_cost", "list_price", "supplier",
    ),
    "dim_customer": (
        "customer_code", "company_name", "segment", "venue_type",
        "region_code", "city", "salesperson_code", "first_order_date",
    ),
    "fact_order": ("order_id", "order_date", "customer_code", "salesperson_code", "status"),
    "fact_line": ("line_id", "order_id", "product_code", "quantity", "unit_price", "discount_rate"),
    "fact_budget": ("period", "region_code", "category", "budget_revenue", "budget_margin"),
}

MANIFEST_SCHEMA = (
    "generation struct<seed:bigint,generated_at:string,periode:string,version_generateur:string>,"
    "verite_financiere struct<ca_total_livre_eur:double,marge_total_livree_eur:double,"
    "taux_marge_global_pct:double,nb_commandes:bigint,nb_lignes_total:bigint,"
    "nb_lignes_livrees:bigint,nb_categories_canoniques:bigint>,"
    "anomalies_injectees struct<ventes:struct<lignes_manuelles_montant_invalide:struct<nb:bigint,"
    "ca_perdue_livree_eur:double>,lignes_manuelles_date_invalide:struct<nb:bigint>,"
    "doublons_export:struct<nb_lignes:bigint>>>,"
    "attendus_apres_nettoyage struct<ca_reconcilie_attendu_eur:double,nb_lignes_apres_dedup:bigint,"
    "nb_dates_invalides_attendu:bigint,nb_montants_invalides_attendu:bigint,"
    "nb_categories_apres_normalisation:bigint>"
)

# The manifest's names of the true figures, and ours: one mapping for the writer and its readers.
TRUTH_FIELDS = {
    "ca_total_livre_eur": "delivered_revenue", "marge_total_livree_eur": "delivered_margin", "taux_marge_global_pct": "margin_rate_pct",
    "nb_commandes": "orders", "nb_lignes_total": "lines", "nb_lignes_livrees": "delivered_lines", "nb_categories_canoniques": "categories",
}

# ---------------------------------------------------------------------------

SOURCES = {s.name: s for s in (SALES, CUSTOMERS, PRODUCTS, SALESPEOPLE, BUDGET)}
