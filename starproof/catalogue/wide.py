"""Budget reshaping, file scans and publication as queries."""

from __future__ import annotations

import contextlib
from functools import reduce

from pyspark.sql import functions as F

from starproof import specs
from starproof.catalogue import exports as x
from starproof.catalogue.registry import BASE, BUDGET, REVENUE, dbl, query
from starproof.functions import measures as m
from starproof.functions import parsing
from starproof.operators import cleaning, counters, facts, reshape
from starproof.operators.cleaning import prepare
from starproof.operators.schema import union_by_name
from starproof.plans import incremental, publish, views
from starproof.sources import files, pointer, readers
from starproof.sources.store import fixed, materialise, run_dir
from starproof.sources.warehouse import DELIVERED, star, table

_LABELS = specs.BUDGET_LAYOUT.month_labels
_NAMED = "named AS (SELECT period, r_name AS region_name, category, budget_revenue, budget_margin FROM budget JOIN region ON region_code = r_regionkey)"


def _budget(spark, sf_dir):
    s = star(spark, sf_dir)
    return s["fact_budget"].join(s["dim_region"], "region_code").drop("region_code")


def _wide_sql(metric: str) -> str:
    months = ", ".join(
        f"CAST(round(COALESCE(sum(CASE WHEN CAST(period[6:7] AS INTEGER) = {i} THEN {metric} END), 0)) AS DOUBLE) AS \"{m}\""
        for i, m in enumerate(_LABELS, start=1)
    )
    return f"""SELECT CAST(period[:4] AS INTEGER) AS year, region_name,
  CASE WHEN grouping(category) = 1 THEN 'Sous-total' ELSE category END AS category,
  CAST(grouping(category) AS INTEGER) AS is_subtotal, {months}
FROM named GROUP BY GROUPING SETS ((year, region_name, category), (year, region_name))"""


@query("budget_wide_subtotals", f"WITH {BUDGET}, {_NAMED} {_wide_sql('budget_revenue')}")
def budget_wide_subtotals(spark, sf_dir):
    return reshape.budget_to_wide(_budget(spark, sf_dir), "budget_revenue")


def _grid(spark, sf_dir, budget=None):
    """Both metrics as landed sheets: title, empty row, header, then region blocks
    whose region is written on the first row only, each closed by a subtotal."""
    budget = materialise(_budget(spark, sf_dir) if budget is None else budget, "budget")
    sheets = []
    for sheet, metric in specs.BUDGET_LAYOUT.sheet_metrics:
        wide = reshape.budget_to_wide(budget, metric).withColumn("sheet", F.lit(sheet))
        sheets.append(wide)
    wide = union_by_name(sheets)
    from pyspark.sql import Window

    # region x category is the size of one sheet: a budget grid, not a fact table
    order = Window.partitionBy("year", "sheet").orderBy("region_name", "is_subtotal", "category")
    block = Window.partitionBy("year", "sheet", "region_name").orderBy("is_subtotal", "category")
    amounts = [F.col(m).cast("decimal(18,0)").cast("string") for m in _LABELS]
    region = F.when(F.row_number().over(block) == 1, F.col("region_name"))
    body = wide.select(
        "year", "sheet", (F.row_number().over(order) + 3).cast("bigint").alias("row"),
        F.array(region, F.col("category"), *amounts).alias("cells"),
    )
    texts = [F.lit(specs.BUDGET_LAYOUT.region_header), F.lit(specs.BUDGET_LAYOUT.category_header), *[F.lit(m) for m in _LABELS]]
    top = wide.select("year", "sheet").distinct().select(
        "year", "sheet", F.explode(F.array(
            F.struct(F.lit(1).cast("bigint").alias("row"), F.array(F.concat(F.lit("Budget "), F.col("year").cast("string"))).alias("cells")),
            F.struct(F.lit(3).cast("bigint").alias("row"), F.array(*texts).alias("cells")),
        )).alias("r"),
    ).select("year", "sheet", "r.row", "r.cells")
    grid = top.unionByName(body).select(
        F.format_string("file:/landing/budget_%d.parquet", "year").alias("file"), "sheet", "row", "cells"
    )
    return materialise(grid, "budget-grid")


_LONG = f"""SELECT period, region_name, category, {dbl('round(budget_revenue)')} AS budget_revenue, {dbl('round(budget_margin)')} AS budget_margin
FROM grid"""
_GRID_SQL = """years AS (SELECT DISTINCT period[:4] AS y FROM named), cells AS (SELECT DISTINCT region_name, category, period[:4] AS y FROM named),
grid AS (SELECT c.y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS period, c.region_name, c.category,
   COALESCE(n.budget_revenue, 0) AS budget_revenue, COALESCE(n.budget_margin, 0) AS budget_margin
 FROM cells c CROSS JOIN range(1, 13) t(m)
 LEFT JOIN named n ON n.region_name = c.region_name AND n.category = c.category AND n.period = c.y || '-' || lpad(CAST(m AS VARCHAR), 2, '0'))"""


@query("budget_unpivot", f"WITH {BUDGET}, {_NAMED}, {_GRID_SQL} {_LONG}")
def budget_unpivot(spark, sf_dir):
    """Landed wide sheets -> long table: header promotion, fill-down, subtotals out, unpivot, merge."""
    long, _ = reshape.reshape_budget(_grid(spark, sf_dir))
    return long.withColumns({c: F.col(c).cast("double") for c in ("budget_revenue", "budget_margin")})


@query("budget_counters", f"""WITH {BUDGET}, {_NAMED}, {_GRID_SQL}
SELECT (SELECT count(*) FROM years) AS files_read, count(*) AS rows, count(DISTINCT region_name) AS regions,
       count(DISTINCT category) AS categories, count(DISTINCT period) AS periods,
       (SELECT count(*) * 2 FROM (SELECT DISTINCT region_name, y FROM cells)) AS subtotal_rows_dropped,
       count(*) FILTER (WHERE category = 'Sous-total') AS leaked_subtotals,
       count(*) FILTER (WHERE category LIKE 'P%' AND period LIKE '%-03') AS missing_amounts,
       count(*) - count(DISTINCT (period, region_name, category)) AS duplicate_keys FROM grid""")
def budget_counters(spark, sf_dir):
    """With the March margins of some categories left empty."""
    empty = (F.col("sheet") == "Marge") & F.coalesce(F.get("cells", 1).startswith("P"), F.lit(False))
    march = F.transform("cells", lambda c, i: F.when(i != 4, c))
    grid = _grid(spark, sf_dir).withColumn("cells", F.when(empty, march).otherwise(F.col("cells")))
    long, rows = reshape.reshape_budget(grid)
    return counters.budget_counters(long, rows)


@query("budget_duplicate_keys", f"""WITH {BUDGET}, {_NAMED}, {_GRID_SQL}
SELECT count(*) + count(*) FILTER (WHERE y % 2 = 0) AS rows, count(*) FILTER (WHERE y % 2 = 0) AS duplicate_keys,
       {dbl('sum(round(budget_revenue) * CASE WHEN y % 2 = 0 THEN 2 ELSE 1 END)')} AS budget_revenue
FROM (SELECT *, CAST(period[:4] AS INTEGER) AS y FROM grid)""")
def budget_duplicate_keys(spark, sf_dir):
    """Every even year lands in two files: both are kept, and each second row counts as a duplicate key."""
    grid = _grid(spark, sf_dir)
    again = grid.filter(parsing.year_in_file_name(F.col("file")) % 2 == 0).withColumn(
        "file", F.replace("file", F.lit(".parquet"), F.lit("_v2.parquet")))
    long, rows = reshape.reshape_budget(grid.unionByName(again))
    total = long.agg(F.sum("budget_revenue").cast("double").alias("t")).scalar()
    return counters.budget_counters(long, rows).select("rows", "duplicate_keys", total.alias("budget_revenue"))


@query("forward_fill", """SELECT o_custkey AS customer_code, o_orderkey AS order_id,
       last_value(CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END IGNORE NULLS)
         OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS priority FROM orders""")
def forward_fill(spark, sf_dir):
    sparse = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_code"), F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderpriority")).alias("priority"),
    )
    return reshape.fill_down(sparse, "priority", ["customer_code"], "order_id", block_rows=1024)


@query("metrics_outer_merge", f"""WITH {BUDGET},
a AS (SELECT period, region_code, category, budget_revenue FROM budget WHERE region_code <> 1),
b AS (SELECT period, region_code, category, budget_margin FROM budget WHERE region_code <> 2)
SELECT period, region_code, category, {dbl('budget_revenue')} AS budget_revenue, {dbl('budget_margin')} AS budget_margin
FROM a FULL OUTER JOIN b USING (period, region_code, category)""")
def metrics_outer_merge(spark, sf_dir):
    budget, keys = star(spark, sf_dir)["fact_budget"], ["period", "region_code", "category"]
    revenue = budget.filter("region_code <> 1").select(*keys, F.col("budget_revenue").cast("double").alias("budget_revenue"))
    margin = budget.filter("region_code <> 2").select(*keys, F.col("budget_margin").cast("double").alias("budget_margin"))
    return reshape.merge_metrics([revenue, margin], keys)


@query("period_from_label", f"""SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m') AS period,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""")
def period_from_label(spark, sf_dir):
    labels = F.array(*[F.lit(m) for m in _LABELS])
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.year("o_orderdate").alias("y"),
        F.element_at(labels, F.month("o_orderdate")).alias("label"),
    )
    period = parsing.period_of_label(F.col("y"), F.col("label"))
    return o.select("order_id", period.alias("period"), parsing.period_year(period).alias("year"), parsing.period_month(period).alias("month"))


# --- scans and sinks over files the query writes itself ---------------------------


def _scratch(spark, name: str) -> str:
    import uuid

    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _parts(spark, directory: str, suffix: str) -> list[str]:
    return files.list_files(spark, directory, f"*{suffix}")


@query("sales_csv_scan", f"""WITH {x.RAW_SALES}
SELECT status, count(*) AS lines, sum(quantity)::BIGINT AS quantity, count(DISTINCT order_id) AS orders FROM raw_sales GROUP BY status""")
def sales_csv_scan(spark, sf_dir):
    """Two exports whose columns are in a different order, read back by header name."""
    raw = x.raw_sales(spark, sf_dir)
    texts = raw.select(*[c for c in raw.columns if not c.startswith("_")])
    paths = []
    for tag, half in (("a", F.col("Statut") == "Livrée"), ("b", F.col("Statut") != "Livrée")):
        part = texts.filter(half)
        target = _scratch(spark, f"export_ventes_{tag}")
        part.select(*(part.columns if tag == "a" else part.columns[::-1])).write.csv(
            target, sep=";", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
        paths += _parts(spark, target, ".csv")
    scanned = prepare(readers.read_csv(spark, paths, ";", "utf-8", specs.SALES), specs.SALES)
    return scanned.groupBy("status").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.countDistinct("order_id").alias("orders"),
    )


@query("sales_mixed_exports", f"""WITH {x.RAW_SALES}
SELECT CASE l % 3 WHEN 0 THEN 'Livrée' WHEN 1 THEN 'Livrée à midi' ELSE 'Livrée' || chr(10) || 'le soir' END AS status,
       count(*) AS lines, sum(quantity)::BIGINT AS quantity, count(DISTINCT order_id) AS orders
FROM (SELECT *, order_id % 3 AS l FROM raw_sales) GROUP BY ALL""")
def sales_mixed_exports(spark, sf_dir):
    """One UTF-8 export, one single-byte export and one with line breaks in quoted cells, read as one source."""
    raw = x.raw_sales(spark, sf_dir)
    texts = raw.select(*[c for c in raw.columns if not c.startswith("_")])
    share = F.col("N° Commande").cast("bigint") % 3
    paths = []
    for i, (charset, status) in enumerate((("UTF-8", "Livrée"), ("ISO-8859-1", "Livrée à midi"), ("UTF-8", "Livrée\nle soir"))):
        target = _scratch(spark, f"export_ventes_{i}")
        texts.filter(share == i).withColumn("Statut", F.lit(status)).write.csv(
            target, sep=";", header=True, encoding=charset, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        paths += _parts(spark, target, ".csv")
    scanned = prepare(readers.read_csv(spark, paths, ";", specs.SALES.encoding, specs.SALES), specs.SALES)
    return scanned.groupBy("status").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.countDistinct("order_id").alias("orders"),
    )


@query("customer_csv_latin", """SELECT c_custkey AS customer_code, c_name || ' Hôtel' AS company_name, c_mktsegment AS segment FROM customer""")
def customer_csv_latin(spark, sf_dir):
    """A single-byte customer export: encoding found from the bytes, then decoded."""
    raw = x.raw_customers(spark, sf_dir).withColumn("raison_sociale", F.concat("raison_sociale", F.lit(" Hôtel")))
    target = _scratch(spark, "export_clients_crm")
    raw.write.csv(target, sep=";", header=True, encoding="ISO-8859-1")
    paths = _parts(spark, target, ".csv")
    scanned = readers.read_csv(spark, paths, ";", specs.CUSTOMERS.encoding, specs.CUSTOMERS)
    return scanned.select(
        F.col("customer_code").cast("bigint").alias("customer_code"), "company_name",
        F.upper(parsing.trimmed(F.col("segment"))).alias("segment"),
    )


@query("export_by_month", f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1""")
def export_by_month(spark, sf_dir):
    from starproof.plans.reporting import reporting_lines

    target = _scratch(spark, "annex")
    publish.write_by_month(reporting_lines(star(spark, sf_dir), DELIVERED), target)
    written = spark.read.parquet(target)
    return written.groupBy(F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("lines"))


@query("export_delimited", "SELECT c_custkey AS customer_code, c_name AS company_name, c_mktsegment AS segment FROM customer")
def export_delimited(spark, sf_dir):
    target = _scratch(spark, "customers")
    publish.export_delimited(star(spark, sf_dir)["dim_customer"], target)
    back = readers.read_csv(spark, _parts(spark, target, ".csv"), ";", "utf-8", specs.CUSTOMERS)
    return back.select(F.col("customer_code").cast("bigint").alias("customer_code"), "company_name", "segment")


@query("staged_publish", f"""WITH {BASE} SELECT category, {dbl('sum(revenue)')} AS revenue FROM base GROUP BY 1""")
def staged_publish(spark, sf_dir):
    """Written under the staging name, renamed once complete, read from the final name."""
    base = facts.delivered_lines(star(spark, sf_dir), ["category"], delivered=DELIVERED)
    root = _scratch(spark, "publish")
    staging, final = f"{root}/{publish.STAGING}/run", f"{root}/final/run"
    publish.write_set({"by_category": views.by_category(base)}, staging)
    publish.commit(spark, staging, final)
    return spark.read.parquet(f"{final}/by_category").select("category", "revenue")


@query("source_fingerprints", "SELECT sha256(n_name || chr(10)) AS sha256 FROM nation")
def source_fingerprints(spark, sf_dir):
    """One text file per nation, written by this query; the digest is that of its bytes."""
    target = _scratch(spark, "nations")
    named = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.col("n_name")).alias("value"))
    named.repartition("n_nationkey").write.partitionBy("n_nationkey").text(target)
    return files.fingerprints(spark, target).filter(F.col("file_name").startswith("part-")).select("sha256")


@query("landing_fingerprints", """WITH l AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d')) AS value FROM lineitem)
SELECT sha256(string_agg(value || chr(10), '' ORDER BY value)) AS sha256 FROM l GROUP BY month""")
def landing_fingerprints(spark, sf_dir):
    """One text file of lines per month, in a fixed order, written by this query; the digest is that of its bytes."""
    target = _scratch(spark, "months")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    lines = table(spark, sf_dir, "lineitem").select(F.substring(day, 1, 7).alias("month"), F.concat_ws(
        "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", day).alias("value"))
    lines.repartition("month").sortWithinPartitions("month", "value").write.partitionBy("month").text(target)
    return files.fingerprints(spark, target).filter(F.col("file_name").startswith("part-")).select("sha256")


@query("source_status", "SELECT count(DISTINCT year(o_orderdate)) AS sales_files, true AS manifest_present, true AS ready FROM orders")
def source_status(spark, sf_dir):
    """A landing folder with one export per year of orders, and a manifest."""
    target = _scratch(spark, "landing")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("export_ventes_"))
    orders.write.partitionBy("export_ventes_").parquet(target)
    publish.write_manifest(spark.range(1).select(F.lit("{}").alias("value")), f"{target}/{specs.MANIFEST_NAME}")
    return files.source_status(spark, target)


# --- from files on storage to the check table -------------------------------------


def _landing(spark, sf_dir, budget=None) -> str:
    """A raw folder of all five sources and the manifest, in the formats that exports land in."""
    from starproof.catalogue.quality import _expected
    from starproof.plans.truth import business_truth

    folder = _scratch(spark, "raw")
    csv = {"sep": ";", "header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    # Copies of a line lie in one file, in the order in which the first one is the true one.
    ordered = x.raw_sales(spark, sf_dir, together=True).sortWithinPartitions("N° Commande", "N° Ligne", *x.ROW_ORDER)
    ordered.drop(*x.ROW_ORDER).write.csv(f"{folder}/export_ventes_all.csv", **csv)
    x.raw_customers(spark, sf_dir).write.csv(f"{folder}/export_clients_crm.csv", encoding="ISO-8859-1", **csv)
    x.raw_products(spark, sf_dir).write.parquet(f"{folder}/catalogue_produits.parquet")
    x.raw_salespeople(spark, sf_dir).write.csv(f"{folder}/commerciaux.csv", **csv)
    names = table(spark, sf_dir, "region").orderBy("r_regionkey").limit(len(specs.REGIONS)).collect()
    french = F.create_map(*[F.lit(v) for r, v in zip(names, specs.REGIONS.values()) for v in (r.r_name, v)])
    sheets = _grid(spark, sf_dir, budget).withColumn("cells", F.transform("cells", lambda c: F.coalesce(F.try_element_at(french, c), c)))
    sheets.withColumn("budget_", parsing.year_in_file_name(F.col("file"))).drop("file").write.partitionBy("budget_").parquet(f"{folder}/years")
    for part in files.list_files(spark, f"{folder}/years", "budget_*"):
        files.rename(spark, part, f"{folder}/{part.rsplit('/', 1)[-1]}")
    s = star(spark, sf_dir)
    none = spark.range(1).select(F.lit("derived").alias("version_generateur"))
    figures = business_truth(s["fact_order"], s["fact_line"], s["dim_product"], DELIVERED)
    publish.write_manifest(publish.manifest_json(figures, none, _expected(spark, sf_dir), none), f"{folder}/{specs.MANIFEST_NAME}")
    return folder


def _ingested_sql() -> str:
    from starproof.catalogue.quality import _EXPECTED_SQL, _RECONCILED

    counts = (
        ("Rows after de-duplication", "(SELECT count(*) FROM sales)", "n"),
        ("Invalid dates", "(SELECT count(*) FROM sales WHERE order_date IS NULL)", "dates"),
        ("Invalid amounts", "(SELECT count(*) FROM sales WHERE unit_price IS NULL)", "amounts"),
        ("Canonical categories", "(SELECT count(DISTINCT category) FROM products)", "categories"),
        ("Reconciled revenue (€)", f"(SELECT round({_RECONCILED}, 2) FROM sales)", "round(revenue, 2)"),
        ("Canonical customer segments", "(SELECT count(*) FROM customers)", "0"),  # none of these is a segment of the exports
        ("Complete budget grid", "(SELECT count(*) FROM grid)",
         "(SELECT count(DISTINCT region_name) * count(DISTINCT category) * count(DISTINCT period) FROM grid)"),
        ("FK lines -> products", "(SELECT count(*) FROM sales WHERE order_date IS NOT NULL AND product_code NOT IN (SELECT p_partkey FROM part))", "0"),
        ("FK lines -> orders", "(SELECT count(*) FROM sales s WHERE order_date IS NOT NULL AND order_id NOT IN (SELECT order_id FROM sales WHERE order_date IS NOT NULL))", "0"),
        ("FK orders -> customers", "(SELECT count(DISTINCT order_id) FROM sales WHERE order_date IS NOT NULL AND customer_code NOT IN (SELECT c_custkey FROM customer))", "0"),
        ("FK orders -> salespeople", "(SELECT count(DISTINCT order_id) FROM sales WHERE order_date IS NOT NULL AND customer_code % 10 NOT IN (SELECT code FROM people))", "0"),
        ("FK budget -> regions", "(SELECT count(*) FROM grid WHERE region_name NOT IN (SELECT r_name FROM region))", "0"),
    )
    rows = " UNION ALL ".join(
        f"SELECT {i} AS check_no, '{label}' AS label, CAST({got} AS DOUBLE) AS obtained, CAST({want} AS DOUBLE) AS expected FROM expected"
        for i, (label, got, want) in enumerate(counts, start=1))
    return (f"WITH {x.RAW_SALES}, {x.RAW_PRODUCTS}, {x.RAW_CUSTOMERS}, {x.RAW_SALESPEOPLE}, {BUDGET}, {_NAMED}, {_GRID_SQL}, {_EXPECTED_SQL}, c AS ({rows}) "
            "SELECT *, abs(obtained - expected) <= 0.001 * abs(expected) * CAST(check_no = 5 AS INTEGER) AS ok FROM c")


@query("ingested_report", _ingested_sql())
def ingested_report(spark, sf_dir):
    """Raw folder -> ingestion -> the twelve checks, all through files; the folder is written by this query."""
    from starproof.plans import checks, ingest

    folder = _landing(spark, sf_dir)
    loaded = ingest.run_ingestion(spark, folder)
    expected = readers.read_manifest(spark, folder).select("attendus_apres_nettoyage.*")
    return checks.reconcile(loaded.star, loaded.reports, expected).drop("detail")


# --- publication, gate, selections, names, incremental runs --------------------------


_SALES_TOTALS = f"""sold AS (SELECT strftime(order_date, '%Y-%m') AS month, quantity * unit_price * (1 - CAST(l_discount AS DECIMAL(4,2))) AS revenue
  FROM sales WHERE status = 'Livrée' AND order_date IS NOT NULL)"""


def _complete_budget(spark, sf_dir):
    """A plan for every month, region and category, whatever was sold."""
    years = table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("z")).first()
    listed = lambda name, column: F.array(*[F.lit(r[0]) for r in table(spark, sf_dir, name).select(column).distinct().collect()])
    months = spark.range(12 * years.a, 12 * (years.z + 1)).select(F.format_string("%d-%02d", F.floor(F.col("id") / 12), F.col("id") % 12 + 1).alias("period"))
    cells = months.withColumn("region_name", F.explode(listed("region", "r_name"))).withColumn("category", F.explode(listed("part", "p_type")))
    amount = lambda n: F.lit(n).cast("decimal(18,4)")
    return cells.withColumn("budget_revenue", amount(5000)).withColumn("budget_margin", amount(1500))


def _proved_landing(spark, sf_dir) -> str:
    """A landing that passes every check: a complete budget, all customers in known segments, all salespeople known and named once."""
    folder = _landing(spark, sf_dir, _complete_budget(spark, sf_dir))
    options = {"sep": ";", "header": True, "mode": "overwrite"}
    segment = F.element_at(F.array(*[F.lit(v) for v in specs.SEGMENTS]), (F.col("code_client").cast("bigint") % len(specs.SEGMENTS) + 1).cast("int"))
    x.raw_customers(spark, sf_dir).withColumn("segment", segment).write.csv(f"{folder}/export_clients_crm.csv", encoding="ISO-8859-1", **options)
    people = spark.range(10).select(F.col("id").cast("string").alias("code_commercial"), F.concat(F.lit("P"), "id").alias("nom"),
                                    F.lit("R01").alias("code_region"), F.lit("2020-01-01").alias("date_embauche"))
    people.write.csv(f"{folder}/commerciaux.csv", **options)
    return folder


@query("published_set", f"""WITH {x.RAW_SALES}, {_SALES_TOTALS}, months AS (SELECT month, sum(revenue) AS revenue FROM sold GROUP BY 1)
SELECT 'annex_lines' AS table_name, count(*)::DOUBLE AS rows, {dbl('sum(revenue)')} AS revenue FROM sold
UNION ALL SELECT 'by_month', count(*), {dbl('sum(revenue)')} FROM months
UNION ALL SELECT 'summary', 1, {dbl('sum(revenue)')} FROM sold
UNION ALL SELECT 'dashboard', 1, {dbl('sum(revenue)')} FROM sold
UNION ALL SELECT 'by_salesperson', (SELECT count(DISTINCT customer_code % 10) FROM sales WHERE status = 'Livrée' AND order_date IS NOT NULL), {dbl('sum(revenue)')} FROM sold
UNION ALL SELECT 'customers_and_segments', (SELECT count(DISTINCT customer_code % {len(specs.SEGMENTS)}) FROM sales WHERE status = 'Livrée' AND order_date IS NOT NULL), {dbl('sum(revenue)')} FROM sold
UNION ALL SELECT 'margin_by_category', (SELECT count(DISTINCT category) FROM sales JOIN (WITH {x.RAW_PRODUCTS} SELECT p_partkey, category FROM products) ON product_code = p_partkey
  WHERE status = 'Livrée' AND order_date IS NOT NULL), {dbl('sum(revenue)')} FROM sold
UNION ALL SELECT 'reconciliation', 12, NULL""")
def published_set(spark, sf_dir):
    """Landing -> proof -> publication; every table is read from the set that the pointer names."""
    out = _scratch(spark, "published")
    publish.run(spark, _proved_landing(spark, sf_dir), out)
    tables = publish.published(spark, out)
    money = {"annex_lines": "amount", "by_month": "revenue_eur", "dashboard": "total_revenue", "reconciliation": None}
    rows = []
    for name in publish.OUTPUT_ORDER:
        if name != "budget_monthly":
            column = money.get(name, "revenue")
            total = F.sum(column).cast("double") if column else F.lit(None).cast("double")
            rows.append(tables[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).cast("double").alias("rows"), total.alias("revenue")))
    return reduce(lambda a, b: a.unionByName(b), rows)


@query("gate_exit_codes", """WITH n AS (SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS lines FROM lineitem)
SELECT 'sound' AS landing, CASE WHEN lines > 0 THEN 0 ELSE 2 END AS exit_code, 1 AS version FROM n
UNION ALL SELECT 'line lost', CASE WHEN lines - 1 = lines THEN 0 ELSE 2 END, 1 FROM n
UNION ALL SELECT 'no manifest', 2, 1 UNION ALL SELECT 'column missing', 2, 1 UNION ALL SELECT 'no sales', 0, 1
UNION ALL SELECT 'sound again', CASE WHEN lines > 0 THEN 0 ELSE 2 END, 2 FROM n""")
def gate_exit_codes(spark, sf_dir):
    """One folder, spoiled in several ways one after the other; a refused landing leaves the published version as it is."""
    folder, out = _proved_landing(spark, sf_dir), _scratch(spark, "gated")
    manifest, sales = f"{folder}/{specs.MANIFEST_NAME}", f"{folder}/export_ventes_all.csv"
    seen = []

    def run(landing):
        code = publish.attempt(spark, folder, out)
        seen.append((landing, code, pointer.current(spark, out)[0]))

    run("sound")
    wanted = readers.read_manifest(spark, folder)
    wrong = wanted.withColumn("attendus_apres_nettoyage", F.col("attendus_apres_nettoyage").withField(
        "nb_lignes_apres_dedup", F.col("attendus_apres_nettoyage.nb_lignes_apres_dedup") + 1))
    wrong = fixed(wrong.select(F.to_json(F.struct("*")).alias("value")))
    files.rename(spark, manifest, f"{folder}/kept_manifest")
    run("no manifest")
    publish.write_manifest(wrong, manifest)
    run("line lost")
    files.delete(spark, manifest)
    files.rename(spark, f"{folder}/kept_manifest", manifest)
    files.rename(spark, sales, f"{folder}/kept_sales.csv")
    run("no sales")
    spark.read.csv(f"{folder}/kept_sales.csv", sep=";", header=True).drop("Statut").write.csv(sales, sep=";", header=True)
    run("column missing")
    files.delete(spark, sales)
    files.rename(spark, f"{folder}/kept_sales.csv", sales)
    run("sound again")
    return spark.createDataFrame(seen, "landing string, exit_code int, version int")


_SELECTIONS = (
    ("nothing chosen", "true"), ("all regions", "true"), ("two regions", "region IN (SELECT r_name FROM region WHERE r_regionkey < 2)"),
    ("months of 1996 and 1997", "month BETWEEN '1996-01' AND '1997-12'"), ("all months", "true"),
    ("one segment in one month", "segment = 'BUILDING' AND month = '1996-03'"),
)


@query("selection_filters", f"WITH {BASE} " + " UNION ALL ".join(
    f"SELECT '{name}' AS selection, count(*) AS lines, {dbl('coalesce(sum(revenue), 0)')} AS revenue FROM base WHERE {where}" for name, where in _SELECTIONS))
def selection_filters(spark, sf_dir):
    """What a user picks in lists and month ranges, turned into filters; the choices come from the data."""
    base = materialise(facts.delivered_lines(star(spark, sf_dir), ["month", "region", "segment"], delivered=DELIVERED, cost=False), "selections")
    offered = {a: [r[0] for r in base.select(a).filter(F.col(a).isNotNull()).distinct().orderBy(a).collect()] for a in ("month", "region", "segment")}
    two = [r.r_name for r in table(spark, sf_dir, "region").filter("r_regionkey < 2").collect()]
    months, regions = offered["month"], offered["region"]
    chosen = (
        facts.Filters(regions=facts.selection([], regions)), facts.Filters(regions=facts.selection(regions, regions)),
        facts.Filters(regions=facts.selection(two, regions)), facts.Filters(months=facts.month_range("1996-01", "1997-12", months)),
        facts.Filters(months=facts.month_range(months[0], months[-1], months)),
        facts.Filters(months=facts.selection(["1996-03"], months), segments=facts.selection(["BUILDING"], offered["segment"])),
    )
    rows = [f.on(base).agg(F.lit(name).alias("selection"), F.count(F.lit(1)).alias("lines"), m.as_double(m.sum_or_zero(F.col("revenue"))).alias("revenue"))
            for (name, _), f in zip(_SELECTIONS, chosen)]
    return reduce(lambda a, b: a.unionByName(b), rows)


@query("star_by_name", f"""SELECT r_name AS region, count(DISTINCT c_custkey) AS customers, count(*) AS lines, {dbl(f'sum({REVENUE})')} AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'F' GROUP BY 1""")
def star_by_name(spark, sf_dir):
    """The star under its table names, asked in SQL."""
    s = star(spark, sf_dir)
    readers.register({t: s[t] for t in ("fact_line", "fact_order", "dim_customer", "dim_region")})
    return spark.sql("""
        SELECT region_name AS region, count(DISTINCT c.customer_code) AS customers, count(*) AS lines,
               CAST(sum(CAST(quantity * unit_price AS DECIMAL(18, 2)) * (1 - CAST(discount_rate AS DECIMAL(4, 2)))) AS DOUBLE) AS revenue
        FROM fact_line l JOIN fact_order o ON l.order_id = o.order_id JOIN dim_customer c ON o.customer_code = c.customer_code
        JOIN dim_region r ON c.region_code = r.region_code WHERE status = 'F' GROUP BY region_name""")


def _write_exports(spark, rows, folder: str) -> None:
    """One export per year of orders, copies of a line in one part and in the order in which the first is the true one; replaces
    what is there. ``rows`` hold all lines of an order in one task; a year has as many parts as tasks, not one task."""
    rows = rows.withColumn("year", F.substring(F.col("Date Commande"), 7, 4))
    rows = rows.sortWithinPartitions("year", "N° Commande", "N° Ligne", *x.ROW_ORDER)
    written = _scratch(spark, "years")
    rows.drop(*x.ROW_ORDER).write.partitionBy("year").parquet(written)
    for part in files.list_files(spark, written, "year=*"):
        entry = f"{folder}/export_ventes_{part.rsplit('=', 1)[-1]}.parquet"
        files.delete(spark, entry)
        files.rename(spark, part, entry)


def _yearly_exports(spark, sf_dir) -> str:
    folder = _scratch(spark, "exports")
    _write_exports(spark, x.raw_sales(spark, sf_dir, together=True), folder)
    return folder


def _corrected(spark, sf_dir, folder: str) -> None:
    """The export of one year lands again, every quantity one higher."""
    again = x.raw_sales(spark, sf_dir, together=True).filter(F.substring(F.col("Date Commande"), 7, 4) == str(_CORRECTED))
    _write_exports(spark, again.withColumn("Quantité ", (F.col("`Quantité `").cast("bigint") + 1).cast("string")), folder)


_CORRECTED = 1998
_INCREMENTAL = f"""corrected AS (SELECT *, substr(date_text, 7, 4) = '{_CORRECTED}' AS again,
    quantity + CASE WHEN substr(date_text, 7, 4) = '{_CORRECTED}' THEN 1 ELSE 0 END AS now FROM sales)"""


@query("incremental_ingestion", f"""WITH {x.RAW_SALES}, {_INCREMENTAL}
SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS lines, sum(now)::BIGINT AS quantity,
       {dbl('sum(now * unit_price * (1 - CAST(l_discount AS DECIMAL(4,2))))')} AS revenue
FROM corrected WHERE order_date IS NOT NULL GROUP BY 1""")
def incremental_ingestion(spark, sf_dir):
    """All exports are read once, then one of them changes and only that one is read again."""
    folder, state = _yearly_exports(spark, sf_dir), _scratch(spark, "state")
    incremental.update(spark, folder, state)
    _corrected(spark, sf_dir, folder)
    lines = cleaning.dated_sales(incremental.update(spark, folder, state).lines)
    revenue = m.line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_rate"))
    return lines.groupBy(m.month_key(F.col("order_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"), m.as_double(F.sum(revenue)).alias("revenue"))


@query("incremental_reads", f"""WITH {x.RAW_SALES}, y AS (SELECT DISTINCT substr(date_text, 7, 4) AS year FROM raw_sales)
SELECT run, year, run = 1 OR (run = 3 AND year = '{_CORRECTED}') AS opened FROM y, (SELECT unnest([1, 2, 3])::INT AS run)""")
def incremental_reads(spark, sf_dir):
    """Which exports three runs open: all of them, none, the corrected one."""
    folder, state = _yearly_exports(spark, sf_dir), _scratch(spark, "state")
    rows = []
    for run in (1, 2, 3):
        if run == 3:
            _corrected(spark, sf_dir, folder)
        done = incremental.update(spark, folder, state)
        rows += [(run, p[-len("1995.parquet"):][:4], p in done.read) for p in (*done.read, *done.kept)]
    return spark.createDataFrame(rows, "run int, year string, opened boolean")


@query("pointer_commits", f"""WITH {BASE}, t AS (SELECT {dbl('sum(revenue)')} AS revenue FROM base)
SELECT 'first writer' AS event, 1 AS version, revenue FROM t UNION ALL SELECT 'second writer, overtaken', 1, revenue FROM t
UNION ALL SELECT 'lost between tables', 1, revenue FROM t UNION ALL SELECT 'restart', 2, 2 * revenue FROM t
UNION ALL SELECT 'leftovers deleted', 2, 2 * revenue FROM t""")
def pointer_commits(spark, sf_dir):
    """Two writers that began together, one that is lost, a restart, a sweep: what a reader finds after each."""
    root = _scratch(spark, "pointer")
    total = facts.delivered_lines(star(spark, sf_dir), [], delivered=DELIVERED, cost=False).agg(m.as_double(F.sum("revenue")).alias("revenue"))
    total = materialise(total, "total")
    seen = []

    def write(name, factor=1.0):
        publish.write_set({"total": total.select((F.col("revenue") * factor).alias("revenue"))}, publish.set_path(root, {"set": name}))

    def found(event):
        version, content = pointer.current(spark, root)
        seen.append((event, version, spark.read.parquet(f"{publish.set_path(root, content)}/total").first().revenue))

    began, _ = pointer.current(spark, root)
    write("a")
    write("b", 5.0)
    pointer.advance(spark, root, began, {"set": "a"})
    found("first writer")
    with contextlib.suppress(pointer.Conflict):
        pointer.advance(spark, root, began, {"set": "b"})
    found("second writer, overtaken")
    write("c", 7.0)  # and no pointer
    found("lost between tables")
    write("d", 2.0)
    pointer.advance(spark, root, pointer.current(spark, root)[0], {"set": "d"})
    found("restart")
    if pointer.leftovers(spark, root, older_than=-1) == ["b", "c"]:
        found("leftovers deleted")
    return spark.createDataFrame(seen, "event string, version int, revenue double")
