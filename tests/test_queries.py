"""Every registered query against its SQL twin, and rules every plan must keep."""

import re

import pytest

import __spark_entry__ as entry
import oracle
from starproof import catalogue

SF = "/root/testdata/sf0.001"
# The corpus operators have tests of their own, and may be absent.
QUERIES = {n: q.run for n, q in catalogue.QUERIES.items()}
SQL = {n: q.sql for n, q in catalogue.QUERIES.items() if q.sql}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "BatchEvalPython" not in plan
    assert not [f for f in df.schema if f.dataType.typeName() == "decimal"]
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert oracle.rows(df.columns, got) == oracle.rows(columns, cursor.fetchall())


def test_catalogue_is_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_is_stable(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "revenue", "margin", "margin_rate_pct"] and df.count() > 0


def test_scan_reads_only_what_the_view_needs(spark):
    query = QUERIES["monthly"](spark, SF)._jdf.queryExecution()
    plan = spark._jvm.PythonSQLUtils.explainString(query, "formatted")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double>" in plan
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "customer.parquet" not in plan and "supplier.parquet" not in plan


@pytest.mark.parametrize("name", ["by_segment", "by_salesperson", "reporting_lines"])
def test_unused_left_join_is_dropped(spark, name):
    query = QUERIES[name](spark, SF)._jdf.queryExecution()
    assert "nation.parquet" not in spark._jvm.PythonSQLUtils.explainString(query, "formatted")


def test_month_filter_reaches_the_scan(spark):
    query = QUERIES["monthly_filtered"](spark, SF)._jdf.queryExecution()
    plan = spark._jvm.PythonSQLUtils.explainString(query, "formatted")
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00), LessThan(o_orderdate,1997-01-01T00:00)" in plan
    assert "In(r_name, [ASIA,EUROPE])" in plan


@pytest.mark.parametrize("name", ["by_category", "by_salesperson", "by_segment", "by_discount_band", "client_top"])
def test_share_views_scan_the_facts_once(spark, name):
    df = QUERIES[name](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan()
    text = final.toString()
    assert "ReusedExchange" in text
    # the subquery's own final plan starts from the reused shuffle, not from a scan
    sub = text[text.index("Subquery"):]
    executed = sub[sub.index("== Final Plan =="):sub.index("== Initial Plan ==")]
    assert "FileScan" not in executed


def test_joins_survive_without_broadcast(spark):
    """With every dimension too large to broadcast the plan is shuffle joins only."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["by_segment"](spark, SF)
        rows = df.collect()
        assert len(rows) == 5 and not re.search(r"Broadcast(Hash|NestedLoop)Join", plan_of(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_key_spread(spark):
    """One order holding a third of the lines, one customer holding them too: same totals."""
    from datetime import date

    from pyspark.sql import functions as F

    from starproof.operators import facts
    from starproof.plans import views
    import stars

    star = stars.two_regions(spark)
    star["fact_line"] = spark.range(30000).select(
        F.col("id").cast("string").alias("line_id"), F.when(F.col("id") % 3 == 0, "n").otherwise(F.concat(F.lit("X"), F.col("id") % 500)).alias("order_id"),
        F.lit("cup").alias("product_code"), F.lit(1).cast("bigint").alias("quantity"), F.lit(2.0).alias("unit_price"), F.lit(0.0).alias("discount_rate"),
    )
    star["fact_order"] = star["fact_order"].unionByName(spark.range(500).select(
        F.concat(F.lit("X"), "id").alias("order_id"), F.lit(date(2023, 2, 1)).alias("order_date"), F.lit("K2").alias("customer_code"),
        F.lit("V8").alias("salesperson_code"), F.lit("Livrée").alias("status"),
    ))
    got = {r.segment: r.revenue for r in views.by_segment(facts.delivered_lines(star, ["segment", "customer_code"])).collect()}
    assert got == {"Indépendants": 20000.0, "PME": 40000.0}


def test_fingerprinted_bytes_grow_with_the_data(spark, monkeypatch):
    from starproof.catalogue import wide

    sizes, hashed = [], wide.files.fingerprints
    monkeypatch.setattr(wide.files, "fingerprints", lambda s, folder: (
        sizes.append(wide.files.file_inventory(s, folder).agg({"length": "sum"}).first()[0]), hashed(s, folder))[1])
    for sf in ("sf0.001", "sf0.01"):
        QUERIES["landing_fingerprints"](spark, f"/root/testdata/{sf}")
    assert sizes[1] > 5 * sizes[0]


@pytest.fixture
def no_broadcast(spark):
    """Every table too large to broadcast, as at scale."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def _initial_exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_first_of_keys_reads_and_shuffles_once(spark):
    df = QUERIES["dedup_natural_key"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and _initial_exchanges(df) == 1


def test_lines_are_first_of_their_keys_where_they_met_their_orders(spark, no_broadcast):
    """One shuffle of the lines, one of the orders; neither copies nor headers need another."""
    assert _initial_exchanges(QUERIES["order_header_distinct"](spark, SF)) == 2


def test_a_year_of_exports_is_written_by_many_tasks(spark, no_broadcast):
    from starproof.catalogue import wide
    from starproof.sources import files

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = wide._yearly_exports(spark, SF)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    entries = files.list_files(spark, folder, "export_ventes_*")
    assert len(entries) == 7 and all(len(files.list_files(spark, e, "part-*")) > 1 for e in entries)
    rows = spark.read.parquet(*entries).selectExpr("`N° Commande` as o", "_metadata.file_path as f")
    assert rows.groupBy("o").agg({"f": "min"}).count() == rows.distinct().count()  # an order lies in one part
