"""Raw exports derived from the warehouse tables, and the same in SQL.

Every line is written out as text the way a sales export would hold it, with
the usual defects: French amounts, unreadable prices, impossible dates,
category and segment spellings, repeated (order, line) keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starproof.functions.text import raw_amount
from starproof.sources.warehouse import table

# position columns standing in for file order
ROW_ORDER = ["_o1", "_o2", "_o3", "_o4", "_o5"]

BAD_PRICE_EVERY, BAD_DATE_EVERY, UNKNOWN_EVERY = 250, 500, 97
BAD_QUANTITY_EVERY, BAD_DISCOUNT_EVERY, HUGE_PRICE_EVERY = 300, 350, 770


def _every(key: Column, n: int) -> Column:
    return key % n == 0


def raw_sales(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """Lines and orders meet by the order number as the export spells it, so a later step by that text needs no second
    shuffle. ``together``: all lines of an order in one task, however the orders are joined."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    number = F.col("l_orderkey").cast("string")
    flat = (lines.repartition(number) if together else lines).join(orders, number == F.col("o_orderkey").cast("string"))
    price = F.when(_every(F.col("l_orderkey"), BAD_PRICE_EVERY), "N/A").otherwise(raw_amount(F.col("l_extendedprice")))
    date = F.when(
        _every(F.col("l_orderkey"), BAD_DATE_EVERY), F.concat(F.lit("32/13/"), F.date_format("o_orderdate", "yyyy"))
    ).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return flat.select(
        date.alias("Date Commande"),
        F.col("l_orderkey").cast("string").alias("N° Commande"),
        F.col("l_linenumber").cast("string").alias("N° Ligne"),
        F.col("o_custkey").cast("string").alias("Code Client"),
        F.col("l_partkey").cast("string").alias("Code Produit"),
        F.col("l_quantity").cast("bigint").cast("string").alias("Quantité "),
        price.alias("PU Vente HT "),
        F.round(F.col("l_discount") * 100, 1).cast("string").alias("Remise %"),
        (F.col("o_custkey") % 10).cast("string").alias("Code Commercial"),
        F.when(F.col("o_orderstatus") == "F", "Livrée").when(F.col("o_orderstatus") == "O", "Retour")
        .otherwise("Annulée").alias("Statut"),
        F.col("l_partkey").alias("_o1"), F.col("l_suppkey").alias("_o2"), F.col("l_quantity").alias("_o3"),
        F.col("l_extendedprice").alias("_o4"), F.col("l_discount").alias("_o5"),
    )


def spoiled_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exports with the defects that no revenue query expects: unreadable quantities and discounts, amounts of too many digits."""
    key = F.col("`N° Commande`").cast("bigint")
    huge = F.lit("99999999999999999999")
    return raw_sales(spark, sf_dir).withColumns({
        "Quantité ": F.when(_every(key, BAD_QUANTITY_EVERY), "x").when(_every(key, HUGE_PRICE_EVERY), "9000000000000000000").otherwise(F.col("Quantité ")),
        "Remise %": F.when(_every(key, BAD_DISCOUNT_EVERY), "?").otherwise(F.col("Remise %")),
        "PU Vente HT ": F.when(_every(key, HUGE_PRICE_EVERY), huge).otherwise(F.col("`PU Vente HT `")),
    })


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    entered = (
        F.when(key % 8 == 1, F.lower(segment)).when(key % 8 == 2, F.concat(segment, F.lit(" ")))
        .when(key % 8 == 3, F.initcap(segment)).when(key % 8 == 4, F.concat(F.lit(" "), F.lower(segment)))
        .otherwise(segment)
    )
    first = F.date_add(F.lit("1995-01-01").cast("date"), (key % 2000).cast("int"))
    date = (
        F.when(key % 66 == 0, "00/00/0000").when(key % 2 == 0, F.date_format(first, "yyyy-MM-dd"))
        .otherwise(F.date_format(first, "dd/MM/yyyy"))
    )
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("code_client"), F.col("c_name").alias("raison_sociale"), entered.alias("segment"),
        F.lit("Restaurant").alias("type_etablissement"),
        F.col("c_nationkey").cast("string").alias("code_region"), F.lit(None).cast("string").alias("ville"),
        (key % 10).cast("string").alias("code_commercial"), date.alias("date_premiere_commande"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    entered = (
        F.when(key % 5 == 1, "consommables").when(key % 5 == 2, "Conso.")
        .when(key % 5 == 3, " Hygiene et Entretien ").otherwise(F.initcap("p_type"))
    )
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("code_produit"), F.col("p_name").alias("libelle"), entered.alias("categorie"),
        F.col("p_brand").alias("sous_categorie"), raw_amount(F.col("p_retailprice")).alias("cout_unitaire"),
        F.col("p_retailprice").cast("string").alias("prix_catalogue"), F.lit(None).cast("string").alias("fournisseur"),
    )


def raw_salespeople(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    hired = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (key % 3000).cast("int")), "yyyy-MM-dd")
    return table(spark, sf_dir, "supplier").select(
        (key - F.when(key % 10 == 0, 1).otherwise(0)).cast("string").alias("code_commercial"),
        F.col("s_name").alias("nom"), F.col("s_nationkey").cast("string").alias("code_region"),
        F.when(key % 7 == 0, "2024-13-01").otherwise(hired).alias("date_embauche"),
    )


# ---------------------------------------------------------------------------
# The same in SQL
# ---------------------------------------------------------------------------


def fr_amount_sql(x: str) -> str:
    cents = f"CAST(round({x} * 100) AS BIGINT)"
    return f"replace(format('{{:,}}', {cents} // 100), ',', chr(160)) || ',' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"


NUMBER_SQL = r"'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def parse_amount_sql(x: str) -> str:
    clean = f"replace(replace(replace({x}, chr(160), ''), ' ', ''), ',', '.')"
    return f"(CASE WHEN regexp_full_match({clean}, {NUMBER_SQL}) THEN TRY_CAST({clean} AS DECIMAL(28,8)) END)"


def parse_date_sql(x: str, iso: bool = True) -> str:
    french = f"try_strptime({x}, '%d/%m/%Y')"
    return f"CAST(COALESCE({french}, try_strptime({x}, '%Y-%m-%d')) AS DATE)" if iso else f"CAST({french} AS DATE)"


RAW_SALES = f"""raw_sales AS (
  SELECT CASE WHEN l_orderkey % {BAD_DATE_EVERY} = 0 THEN '32/13/' || strftime(o_orderdate, '%Y')
              ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_text,
         l_orderkey AS order_id, l_linenumber AS line_id, o_custkey AS customer_code, l_partkey AS product_code,
         CAST(l_quantity AS BIGINT) AS quantity,
         CASE WHEN l_orderkey % {BAD_PRICE_EVERY} = 0 THEN 'N/A' ELSE {fr_amount_sql('l_extendedprice')} END AS price_text,
         CAST(round(l_discount * 100) AS BIGINT) AS points, l_extendedprice, l_discount,
         CASE o_orderstatus WHEN 'F' THEN 'Livrée' WHEN 'O' THEN 'Retour' ELSE 'Annulée' END AS status,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount) AS copy_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sales AS (SELECT *, {parse_date_sql('date_text', iso=False)} AS order_date, {parse_amount_sql('price_text')} AS unit_price
          FROM raw_sales WHERE copy_no = 1)"""

RAW_CUSTOMERS = f"""raw_customers AS (
  SELECT c_custkey, c_mktsegment AS true_segment,
         CASE c_custkey % 8 WHEN 1 THEN lower(c_mktsegment) WHEN 2 THEN c_mktsegment || ' '
              WHEN 3 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) WHEN 4 THEN ' ' || lower(c_mktsegment)
              ELSE c_mktsegment END AS entered,
         DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS first_order,
         CASE WHEN c_custkey % 66 = 0 THEN '00/00/0000'
              WHEN c_custkey % 2 = 0 THEN strftime(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER), '%Y-%m-%d')
              ELSE strftime(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER), '%d/%m/%Y') END AS date_text
  FROM customer),
customers AS (SELECT *, upper(trim(entered)) AS segment, {parse_date_sql('date_text')} AS first_order_date FROM raw_customers)"""

_INITCAP = "upper(p_type[1]) || lower(p_type[2:])"
RAW_PRODUCTS = f"""raw_products AS (
  SELECT p_partkey, p_retailprice,
         trim(CASE p_partkey % 5 WHEN 1 THEN 'consommables' WHEN 2 THEN 'Conso.' WHEN 3 THEN ' Hygiene et Entretien '
              ELSE {_INITCAP} END) AS raw_category
  FROM part),
products AS (SELECT *, CASE lower(raw_category) WHEN 'consommables' THEN 'Consommables' WHEN 'conso.' THEN 'Consommables'
    WHEN 'hygiene et entretien' THEN 'Hygiène & Entretien' ELSE raw_category END AS category FROM raw_products)"""

RAW_SALESPEOPLE = f"""people AS (
  SELECT s_suppkey - CASE WHEN s_suppkey % 10 = 0 THEN 1 ELSE 0 END AS code,
         {parse_date_sql("CASE WHEN s_suppkey % 7 = 0 THEN '2024-13-01' ELSE strftime(DATE '1990-01-01' + CAST(s_suppkey % 3000 AS INTEGER), '%Y-%m-%d') END")} AS hire_date
  FROM supplier)"""
