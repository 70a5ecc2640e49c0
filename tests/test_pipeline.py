import hashlib
import os

import pytest
from pyspark.sql import functions as F

from starproof import specs
from starproof.operators import counters, reshape
from starproof.plans import checks, incremental, ingest, publish, truth
from starproof.sources import files, pointer, readers, spreadsheet, store
import rawfolder
import stars
import workbooks


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = rawfolder.write(tmp_path_factory.mktemp("raw"))
    return folder, ingest.run_ingestion(spark, folder)


def first(df):
    return df.first().asDict()


def test_cleaning_reports(loaded):
    _, got = loaded
    assert first(got.reports["sales"]) == dict(
        files_read=2, rows_raw=6, rows_after_dedup=5, duplicates_removed=1, invalid_dates=1, invalid_amounts=1,
        rows_kept=4, invalid_quantities=0, invalid_discounts=0, overflowing_lines=0)
    assert first(got.reports["products"]) == dict(rows=2, categories_raw=2, categories_canonical=2, products_recategorised=1)
    # the trailing space alone is trimmed before the comparison, the case is not
    assert first(got.reports["customers"]) == dict(
        rows=2, invalid_first_order_dates=1, segments_normalised=2, invalid_segments=0, distinct_segments=2)
    assert first(got.reports["salespeople"]) == dict(rows=1, invalid_hire_dates=0, duplicate_codes=0)
    assert first(got.reports["budget"]) == dict(
        files_read=1, rows=120, regions=5, categories=2, periods=12, subtotal_rows_dropped=10, leaked_subtotals=0,
        missing_amounts=0, duplicate_keys=0)


def test_star_shape_and_values(loaded):
    _, got = loaded
    assert {t: tuple(df.columns) for t, df in got.star.items()} == specs.STAR_COLUMNS
    names = {r.customer_code: (r.company_name, r.segment, r.city) for r in got.star["dim_customer"].collect()}
    assert names == {"C1": ("Hôtel de l’Étoile €", "PME", "Paris"), "C2": ("Café Œuvre", "Indépendants", "Nîmes")}
    lines = {(r.order_id, r.line_id): r for r in got.star["fact_line"].collect()}
    assert float(lines["O1", "1"].unit_price) == 1000.5 and float(lines["O1", "1"].discount_rate) == 0.1
    assert lines["O1", "2"].unit_price is None and ("O4", "1") not in lines
    march = got.star["fact_budget"].filter("period = '2024-03' AND region_code = 'R04' AND category = 'Mobilier'").first()
    assert (float(march.budget_revenue), float(march.budget_margin)) == (300.0, 120.0)
    assert got.unknown_budget_regions.count() == 0


def test_twelve_checks_pass_and_extras_too(spark, loaded):
    folder, got = loaded
    expected = readers.read_manifest(spark, folder).select("attendus_apres_nettoyage.*")
    report = checks.reconcile(got.star, got.reports, expected)
    assert [r.ok for r in checks.gate(report)] == [True] * 12
    assert first(checks.verdict(report)) == dict(passed=12, total=12, integrity_ok=True)
    assert checks.structural_checks(got.star, got.unknown_budget_regions).filter("NOT ok").count() == 0
    text = checks.report_lines(report).first().report
    assert text.count("\n") == 12 and text.endswith("=> INTEGRITY OK")
    table = checks.report_table(report).collect()
    assert table[4].obtained == "1 860,90 €" and table[0].obtained == "5" and {r.status for r in table} == {"OK"}


def test_second_path_agrees(spark, loaded):
    folder, _ = loaded
    expected = readers.read_manifest(spark, folder).select("attendus_apres_nettoyage.*")
    got = truth.round_trip(readers.scan(spark, folder, specs.SALES), readers.scan(spark, folder, specs.PRODUCTS), expected)
    assert got.filter("ok").count() == 5


def test_lazy_ingestion_gives_the_same(spark, loaded):
    folder, got = loaded
    lazy = ingest.run_ingestion(spark, folder, stored=False)
    for table in ("fact_line", "fact_order", "fact_budget"):
        assert sorted(map(str, lazy.star[table].collect())) == sorted(map(str, got.star[table].collect()))


def test_sales_from_workbooks(spark, tmp_path):
    folder = rawfolder.write(tmp_path / "raw", xlsx_sales=True)
    got = ingest.run_ingestion(spark, folder)
    assert first(got.reports["sales"])["rows_kept"] == 4 and first(got.reports["sales"])["invalid_dates"] == 1


SHOP = stars.SHOP_LINES


@pytest.mark.parametrize("change, failing", [
    (dict(fact_line=SHOP[1:]), "Reconciled revenue (€)"),
    (dict(fact_line=[SHOP[0], SHOP[1], (*SHOP[2][:2], "unlisted", *SHOP[2][3:]), SHOP[3]]), "FK lines -> products"),
    (dict(fact_line=[*SHOP, ("l9", "lost", "cup", 1, 1.0, 0.0)]), "FK lines -> orders"),
    (dict(dim_customer=[]), "FK orders -> customers"),
    (dict(dim_salesperson=[]), "FK orders -> salespeople"),
    (dict(dim_region=[]), "FK budget -> regions"),
])
def test_star_mutations_fail_one_check(spark, change, failing):
    star = stars.shop(spark, **change)
    report = checks.reconcile(star, stars.shop_reports(spark), stars.shop_expected(spark))
    assert [r.label for r in report.filter("NOT ok").collect()] == [failing]
    with pytest.raises(checks.IntegrityError, match="1 of 12"):
        checks.gate(report)


@pytest.mark.parametrize("key, value, failing", [
    ("nb_lignes_apres_dedup", 41, "Rows after de-duplication"), ("nb_dates_invalides_attendu", 0, "Invalid dates"),
    ("nb_montants_invalides_attendu", 3, "Invalid amounts"), ("nb_categories_apres_normalisation", 8, "Canonical categories"),
    ("ca_reconcilie_attendu_eur", stars.SHOP_REVENUE * 1.01, "Reconciled revenue (€)"),
    ("ca_reconcilie_attendu_eur", 0.0, "Reconciled revenue (€)"), ("ca_reconcilie_attendu_eur", -stars.SHOP_REVENUE, "Reconciled revenue (€)"),
])
def test_manifest_mutations_fail(spark, key, value, failing):
    report = checks.reconcile(stars.shop(spark), stars.shop_reports(spark), stars.shop_expected(spark, **{key: value}))
    assert [r.label for r in report.filter("NOT ok").collect()] == [failing]


@pytest.mark.parametrize("source, column, value, failing", [
    ("customers", "invalid_segments", 2, "Canonical customer segments"), ("budget", "rows", 2, "Complete budget grid"),
    ("budget", "leaked_subtotals", 1, "Complete budget grid"), ("budget", "duplicate_keys", 1, "Complete budget grid"),
])
def test_report_mutations_fail(spark, source, column, value, failing):
    reports = stars.shop_reports(spark)
    reports[source] = reports[source].withColumn(column, F.lit(value).cast("bigint"))
    report = checks.reconcile(stars.shop(spark), reports, stars.shop_expected(spark))
    assert [r.label for r in report.filter("NOT ok").collect()] == [failing]


def test_duplicate_keys_and_unknown_regions_are_reported(spark):
    star = stars.shop(spark, dim_customer=[stars.customer("K1", "PME", "R03")] * 2)
    strays = spark.createDataFrame([("2023-04", "Atlantide")], "period string, region_name string")
    bad = {r.label: r.obtained for r in checks.structural_checks(star, strays).filter("NOT ok").collect()}
    assert bad == {"PK dim_customer unique": 1.0, "Budget rows with an unknown region": 1.0}


def test_orphans_ignore_null_keys(spark):
    from starproof.operators.keys import orphan_count, orphan_counts

    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",)], "k string")
    assert orphan_count(child, "k", parent, "k").first()[0] == 2
    both = child.withColumn("other", F.lit(7))
    sevens = spark.createDataFrame([(7,)], "n bigint")
    assert tuple(orphan_counts([(both, "k", parent, "k"), (both, "other", sevens, "n"), (parent, "k", child, "k"), (both, "other", parent, "k")]).first()) == (2, 0, 0, 4)


def test_counters_are_observed_while_the_lines_are_written(spark, tmp_path):
    from starproof.operators.cleaning import audit_sales

    folder = rawfolder.write(tmp_path / "raw")
    audited = audit_sales(readers.scan(spark, folder, specs.SALES), list(readers.ORDER_COLUMNS))
    lines, report = ingest.counted_sales(audited, 2)
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation") == report._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation")
    assert first(report) == first(counters.sales_counters(lines, 2))
    none, empty = ingest.counted_sales(audited.filter("1 = 0"), 0)
    assert none.count() == 0 and set(first(empty).values()) == {0}


@pytest.mark.parametrize("most", [0, 10])
def test_first_of_repeated_keys(spark, monkeypatch, most):
    """A key that a third of the rows have, keys that occur once, null keys, ties."""
    from starproof.operators import cleaning

    monkeypatch.setattr(cleaning, "MOST_BROADCAST_KEYS", most)
    rows = [("hot", i % 3, 1000 - i, f"v{i}") for i in range(300)] + [(f"k{i}", 1, i, "x") for i in range(300)] + [(None, 1, 5, "b"), (None, 1, 5, "a"), ("n", None, 1, None)]
    got = {(r.k, r.j): (r.o, r.v, r.copies) for r in cleaning.keep_first(spark.createDataFrame(rows, "k string, j int, o int, v string"), ["k", "j"], ["o"], "copies").collect()}
    want = {}
    for k, j, o, v in rows:
        best, n = want.get((k, j), ((o, v), 0))
        want[k, j] = (min(best, (o, v)) if v else best, n + 1)
    assert got == {key: (*best, n) for key, (best, n) in want.items()}


# --- publication ---------------------------------------------------------------


def test_publication_end_to_end(spark, tmp_path):
    folder, out = rawfolder.write(tmp_path / "raw"), str(tmp_path / "out")
    assert publish.main([folder, out]) == 0
    version, content = pointer.current(spark, out)
    assert version == 1 and content["name"].startswith("2024_2024/reporting_2024-01_to_2024-02_")
    tables = publish.published(spark, out)
    assert set(publish.OUTPUT_ORDER) <= set(tables) and len(tables) == len(publish.OUTPUT_ORDER) + 7
    assert tables["summary"].first().revenue == pytest.approx(rawfolder.REVENUE)
    assert tables["annex_lines"].count() == 3 and tables["reconciliation"].count() == 12


def test_a_failed_or_overtaken_run_leaves_nothing(spark, tmp_path, monkeypatch):
    folder, out = rawfolder.write(tmp_path / "raw"), str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        publish.published(spark, out)
    write = publish.write_set

    def overtaken(tables, target):
        write(tables, target)
        if "summary" in tables:
            assert pointer.advance(spark, out, 0, {"set": "theirs", "tables": []}) == 1

    monkeypatch.setattr(publish, "write_set", overtaken)
    assert publish.attempt(spark, folder, out) == 2
    assert pointer.current(spark, out) == (1, {"set": "theirs", "tables": []})
    assert os.listdir(os.path.join(out, pointer.SETS)) == []


def test_pointer_of_a_lost_writer(spark, tmp_path):
    root = str(tmp_path)
    assert pointer.current(spark, root) == (0, None)
    assert pointer.advance(spark, root, 0, {"set": "a"}) == 1
    open(os.path.join(root, pointer.FOLDER, "0000000002.json"), "w").close()  # created, never written
    assert pointer.current(spark, root) == (1, {"set": "a"})
    with pytest.raises(pointer.Conflict):
        pointer.advance(spark, root, 0, {"set": "b"})
    assert pointer.advance(spark, root, 1, {"set": "c"}) == 2
    for name in ("a", "b", "c"):
        os.makedirs(os.path.join(root, pointer.SETS, name))
    assert pointer.leftovers(spark, root) == [] and pointer.leftovers(spark, root, older_than=-1) == ["b"]


def test_a_repeated_dimension_key_stops_publication(spark, tmp_path):
    folder = rawfolder.write(tmp_path / "raw")
    with open(os.path.join(folder, "commerciaux.csv"), "a", encoding="utf-8") as f:
        f.write("S1;Autre;R01;2020-03-01\n")
    assert publish.attempt(spark, folder, str(tmp_path / "out")) == 2


# --- incremental ingestion ---------------------------------------------------------


def _state(update):
    return sorted(map(str, update.lines.collect())), first(update.report)


def _full(spark, folder):
    from starproof.operators.cleaning import audit_sales

    lines = audit_sales(readers.scan(spark, folder, specs.SALES), list(readers.ORDER_COLUMNS))
    return sorted(map(str, lines.collect())), first(counters.sales_counters(lines, len(files.list_files(spark, folder, specs.SALES.file_glob))))


def test_incremental_runs_equal_full_ones(spark, tmp_path):
    folder, state = rawfolder.write(tmp_path / "raw"), str(tmp_path / "state")
    at = lambda month: os.path.join(folder, f"export_ventes_2024-{month}.csv")
    names = lambda paths: [p.rsplit("-", 1)[-1][:2] for p in paths]
    one = incremental.update(spark, folder, state)
    assert names(one.read) == ["01", "02"] and _state(one) == _full(spark, folder)
    os.utime(at("01"), (1, 1))  # another time, equal bytes: hashed, not read
    two = incremental.update(spark, folder, state)
    assert (two.read, names(two.kept)) == ((), ["01", "02"]) and _state(two) == _state(one)
    with open(at("02"), "a", encoding="utf-8") as f:  # a copy of a January line, and a new one
        f.write(";".join(rawfolder.JANUARY[0][::-1]) + "\n" + ";".join(["11/02/2024", "O9", "1", "C1", "P1", "1", "7,00", "0.0", "S1", "Livrée"][::-1]) + "\n")
    three = incremental.update(spark, folder, state)
    assert names(three.read) == ["02"] and _state(three) == _full(spark, folder) and _state(three) != _state(one)
    assert first(three.report)["duplicates_removed"] == 2
    rawfolder._csv(at("03"), rawfolder.HEADERS, [["01/03/2024", "O7", "1", "C1", "P1", "2", "9,00", "0.0", "S1", "Livrée"]])
    os.remove(at("01"))
    four = incremental.update(spark, folder, state)
    assert names(four.read) == ["03"] and names(four.gone) == ["01"] and _state(four) == _full(spark, folder)
    swept = incremental.sweep(spark, state, older_than=-1)
    assert len(swept) == 2 and _state(incremental.update(spark, folder, state)) == _full(spark, folder)


def test_a_run_that_was_overtaken_changes_no_state(spark, tmp_path, monkeypatch):
    folder, state = rawfolder.write(tmp_path / "raw"), str(tmp_path / "state")
    one = incremental.update(spark, folder, state)
    with open(os.path.join(folder, "export_ventes_2024-01.csv"), "a", encoding="utf-8") as f:
        f.write(";".join(["11/01/2024", "O9", "1", "C1", "P1", "1", "7,00", "0.0", "S1", "Livrée"]) + "\n")
    partials = incremental._partials

    def slow(*args):
        partials(*args)
        _, content = pointer.current(spark, state)
        pointer.advance(spark, state, one.version, content)

    monkeypatch.setattr(incremental, "_partials", slow)
    with pytest.raises(pointer.Conflict):
        incremental.update(spark, folder, state)
    monkeypatch.setattr(incremental, "_partials", partials)
    assert _state(incremental.update(spark, folder, state)) == _full(spark, folder)
    with pytest.raises(FileNotFoundError):
        incremental.update(spark, str(tmp_path / "none"), state)


def test_exit_codes(spark, tmp_path):
    out = str(tmp_path / "out")
    assert publish.main([str(tmp_path / "nowhere"), out]) == 0
    assert publish.main([rawfolder.write(tmp_path / "a", manifest=False), out]) == 2
    assert publish.main([rawfolder.write(tmp_path / "b", nb_lignes_apres_dedup=4), out]) == 2
    assert not os.path.exists(out)


def test_commit_needs_a_complete_staging(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        publish.commit(spark, str(tmp_path / "none"), str(tmp_path / "final"))
    df = spark.range(3)
    publish.write_set({"t": df}, str(tmp_path / "s1"))
    publish.commit(spark, str(tmp_path / "s1"), str(tmp_path / "x" / "final"))
    publish.write_set({"t": df}, str(tmp_path / "s2"))
    with pytest.raises(FileExistsError):
        publish.commit(spark, str(tmp_path / "s2"), str(tmp_path / "x" / "final"))


def test_period_without_month(spark):
    empty = spark.createDataFrame([], "month string, revenue double")
    row = publish.period_bounds(empty).first()
    assert row.stem == "reporting" and row.folder == "" and row.period_label is None


def test_manifest_round_trip(spark, tmp_path):
    one = lambda **kw: spark.range(1).select(*[F.lit(v).alias(k) for k, v in kw.items()])
    star = stars.shop(spark)
    figures = truth.business_truth(star["fact_order"], star["fact_line"], star["dim_product"])
    manifest = publish.manifest_json(figures, one(n=1), one(nb_lignes_apres_dedup=3), one(seed=7))
    publish.write_manifest(manifest, str(tmp_path / "m" / specs.MANIFEST_NAME))
    back = readers.read_manifest(spark, str(tmp_path / "m"))
    assert first(readers.manifest_truth(back)) == first(figures)
    assert None not in first(back)["verite_financiere"].asDict().values()
    assert back.first().attendus_apres_nettoyage.nb_lignes_apres_dedup == 3
    with pytest.raises(FileNotFoundError):
        readers.read_manifest(spark, str(tmp_path))


# --- sources ---------------------------------------------------------------------


def test_no_sales_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="export_ventes"):
        readers.scan(spark, str(tmp_path), specs.SALES)


@pytest.mark.parametrize("declared, payload, want", [
    ("cp1252", "é€".encode("cp1252"), "cp1252"), ("utf-8", "é".encode(), "utf-8"), ("utf-8", "é".encode("cp1252"), "cp1252"),
    ("cp1252", "Í".encode(), "utf-8-sig"), ("utf-8", b"\x81\xe9", "latin-1"), (None, b"abc", "utf-8-sig"),
])
def test_encoding_choice(spark, tmp_path, declared, payload, want):
    path = tmp_path / "f.csv"
    path.write_bytes(b"a;b\n" + payload + b";x\n")
    assert readers.choose_encoding(spark, [str(path)], declared) == want


def test_missing_tokens_are_null(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a;b\nNA;1\nx;n/a\n", encoding="utf-8")
    got = readers.read_csv(spark, [str(tmp_path / "f.csv")], ";").select("a", "b").collect()
    assert [tuple(r) for r in got] == [(None, "1"), ("x", None)]


def test_quotes_and_directory_landing(spark, tmp_path):
    folder = tmp_path / "commerciaux.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text('code_commercial;nom;code_region;date_embauche\nS1;"Zoé ""Z""; chef";R01;2020-03-01\n', encoding="utf-8")
    (folder / "part-1.csv").write_text("nom;date_embauche;code_region;code_commercial\nBob;2021-03-01;R02;S2\n", encoding="utf-8")
    got = readers.scan(spark, str(tmp_path), specs.SALESPEOPLE).orderBy("salesperson_code").collect()
    assert [(r.salesperson_code, r["name"]) for r in got] == [("S1", 'Zoé "Z"; chef'), ("S2", "Bob")]


def test_first_copy_in_file_order_wins(spark, tmp_path):
    row = ["05/01/2024", "O1", "1", "C1", "P1", "2", "7,00", "0.0", "S1", "Livrée"]
    for month, prices in (("01", ("5,00", "6,00")), ("02", ("4,00",))):
        body = [";".join(rawfolder.HEADERS)] + [";".join([*row[:6], p, *row[7:]]) for p in prices]
        (tmp_path / f"export_ventes_2024-{month}.csv").write_text("\n".join(body) + "\n", encoding="utf-8")
    from starproof.operators.cleaning import audit_sales

    kept = audit_sales(readers.scan(spark, str(tmp_path), specs.SALES), list(readers.ORDER_COLUMNS)).collect()
    assert [(float(r.unit_price), r._copies) for r in kept] == [(5.0, 3)]


def test_parquet_landing(spark, tmp_path):
    raw = spark.createDataFrame([rawfolder.JANUARY[0]], rawfolder.HEADERS)
    raw.write.parquet(str(tmp_path / "export_ventes_2024.parquet"))
    assert readers.scan(spark, str(tmp_path), specs.SALES).first().order_id == "O1"


def test_fingerprints_of_any_name(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 10)
    (tmp_path / "b é %20+#.csv.gz").write_bytes(b"y" * 3_000_000)
    (tmp_path / "_c d.json").write_bytes(b"{}")
    want = {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in os.listdir(tmp_path)}
    assert {r.file_name: r.sha256 for r in files.fingerprints(spark, str(tmp_path)).collect()} == want


def test_each_file_has_its_own_encoding(spark, tmp_path):
    row = ["05/01/2024", "O1", "1", "C1", "P1", "2", "7,00", "0.0", "S1", "Livrée"]
    for name, encoding, order in (("a b", "utf-8", "A"), ("é", "cp1252", "B"), ("c", "utf-8-sig", "C")):
        lines = [";".join(rawfolder.HEADERS), ";".join([row[0], order, *row[2:]])]
        (tmp_path / f"export_ventes_{name}.csv").write_bytes("\r\n".join(lines).encode(encoding))
    got = readers.scan(spark, str(tmp_path), specs.SALES).orderBy("order_id").collect()
    assert [(r.order_id, r.status) for r in got] == [("A", "Livrée"), ("B", "Livrée"), ("C", "Livrée")]


def test_every_file_must_hold_the_required_columns(spark, tmp_path):
    good = [";".join(rawfolder.HEADERS), "05/01/2024;O1;1;C1;P1;2;7,00;0.0;S1;Livrée"]
    (tmp_path / "export_ventes_1.csv").write_text("\n".join(good), encoding="utf-8")
    (tmp_path / "export_ventes_2.csv").write_text("\n".join(x.rsplit(";", 1)[0] for x in good), encoding="utf-8")
    with pytest.raises(ValueError, match="status"):
        readers.scan(spark, str(tmp_path), specs.SALES)


def test_a_header_of_any_length_and_quoted_line_breaks(spark, tmp_path):
    extra = [f"colonne_{i}" * 3 for i in range(6000)]
    head = ["code_client", "raison_sociale", "segment", *extra, "code_region", "date_premiere_commande"]
    assert len(";".join(head)) > 200_000
    body = ["C1", '"Hôtel\ndu ""Nord"""', "PME", *["x"] * len(extra), "R01", "01/02/2019"]
    (tmp_path / "export_clients_crm.csv").write_bytes((";".join(head) + "\n" + ";".join(body) + "\n").encode("cp1252"))
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "true")
    rows = readers.scan(spark, str(tmp_path), specs.CUSTOMERS).select("customer_code", "company_name", "region_code", "first_order_date").collect()
    assert [tuple(r) for r in rows] == [("C1", 'Hôtel\ndu "Nord"', "R01", "01/02/2019")]


def test_amounts_keep_their_digits(spark):
    from starproof.functions.parsing import french_amount

    texts = ["0,00345", "123 456 789 012 345,67", "1e3", "12345678901234567890123"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(french_amount(F.col("t")).alias("v")).collect()
    assert [None if r.v is None else format(r.v.normalize(), "f") for r in got] == ["0.00345", "123456789012345.67", "1000", None]


def test_absurd_lines_are_null_and_counted(spark):
    lines = spark.sql("SELECT 9000000000000000000 AS quantity, cast('99999999999999999999' AS decimal(28,8)) AS unit_price, cast(0 AS decimal(12,8)) AS discount_rate "
                      "UNION ALL SELECT 2, 3, 0 UNION ALL SELECT NULL, 3, 0")
    assert counters.overflowing_lines(lines).first().overflowing_lines == 1


def test_a_missing_folder_is_not_ready(spark, tmp_path):
    assert first(files.source_status(spark, str(tmp_path / "none"))) == dict(sales_files=0, manifest_present=False, ready=False)


def test_source_status(spark, tmp_path):
    folder = rawfolder.write(tmp_path / "raw")
    assert first(files.source_status(spark, folder)) == dict(sales_files=2, manifest_present=True, ready=True)


def test_workbook_grid(spark, tmp_path):
    workbooks.write(str(tmp_path / "w.xlsx"), {"A": [["x", None, 3], [], ["=é"]], "B": [[1.5]]})
    got = {(r.sheet, r.row): r.cells for r in spreadsheet.read_grid(spark, [str(tmp_path / "w.xlsx")]).collect()}
    assert got == {("A", 1): ["x", None, "3"], ("A", 3): ["é"], ("B", 1): ["1.5"]}


def test_a_workbook_without_any_row_is_an_error(spark, tmp_path):
    workbooks.write(str(tmp_path / "export_ventes_2024.xlsx"), {"A": [], "B": [rawfolder.HEADERS]})
    with pytest.raises(Exception, match="not even a header"):
        readers.scan(spark, str(tmp_path), specs.SALES).collect()


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        assert store.shared_dir(spark) == configured
    else:
        assert os.path.isdir(store.shared_dir(spark))


# --- reshape ---------------------------------------------------------------------


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_fill_down_across_blocks(spark, block):
    rows = [("s", i, "r%d" % i if i % 7 == 2 else None) for i in range(40)] + [("t", 5, None), ("t", 9, "z"), ("t", 30, None)]
    got = reshape.fill_down(spark.createDataFrame(rows, "sheet string, row bigint, v string"), "v", ["sheet"], "row", block)
    want, last = {}, {}
    for sheet, row, v in rows:
        last[sheet] = v or last.get(sheet)
        want[sheet, row] = last[sheet]
    assert {(r.sheet, r.row): r.v for r in got.collect()} == want


GRID = "file string, sheet string, row bigint, cells array<string>"
HEAD = ["Région", "Catégorie", *rawfolder.MONTHS]


def budget_file(name, amount, sheets=("CA", "Marge"), head=HEAD, rows=1):
    body = [("file:/x/" + name, s, 4 + i, ["Sud", "Mobilier", *[str(amount)] * 12]) for s in sheets for i in range(rows)]
    return [("file:/x/" + name, s, 3, head) for s in sheets] + body


def test_budget_file_without_year_fails(spark):
    with pytest.raises(Exception, match="no year"):
        reshape.reshape_budget(spark.createDataFrame(budget_file("budget_x.xlsx", 1), GRID))[0].collect()


def test_repeated_budget_rows_stay_and_are_counted(spark):
    rows = budget_file("budget_2031.xlsx", 100) + budget_file("budget_2031_v2.xlsx", 900, rows=2)
    long, sheet_rows = reshape.reshape_budget(spark.createDataFrame(rows, GRID))
    got = first(counters.budget_counters(long, sheet_rows))
    assert (got["rows"], got["duplicate_keys"], got["files_read"]) == (36, 24, 2)
    assert long.agg(F.sum("budget_revenue")).first()[0] == 12 * (100 + 900 + 900)


@pytest.mark.parametrize("rows, said", [
    (budget_file("budget_2031.xlsx", 1, sheets=("CA",)), "no sheet Marge"),
    (budget_file("budget_2031.xlsx", 1, sheets=("CA", "Marges")), "no sheet Marge"),
    (budget_file("budget_2031.xlsx", 1, head=HEAD[:-1]), "sheet CA lacks Déc"),
    (budget_file("budget_2031.xlsx", 1, head=["", *HEAD[1:]]), "sheet CA lacks Région"),
    ([r for r in budget_file("budget_2031.xlsx", 1) if r[1:3] != ("Marge", 3)], "no sheet Marge with a header"),
])
def test_incomplete_budget_files_are_an_error(spark, rows, said):
    good = budget_file("budget_2030.xlsx", 1)
    with pytest.raises(Exception, match=said):
        reshape.reshape_budget(spark.createDataFrame(good + rows, GRID))[0].collect()


def test_missing_budget_cells_are_counted(spark):
    file = "file:/x/budget_2024.xlsx"
    header = ["Région", "Catégorie", *rawfolder.MONTHS]
    grid = spark.createDataFrame(
        [(file, "CA", 3, header), (file, "CA", 4, ["Sud", "Mobilier", *["1"] * 12]), (file, "Marge", 3, header), (file, "Marge", 4, ["Sud", "Mobilier", *["1"] * 11])],
        "file string, sheet string, row bigint, cells array<string>")
    long, rows = reshape.reshape_budget(grid)
    got = first(counters.budget_counters(long, rows))
    assert got["rows"] == 12 and got["missing_amounts"] == 1 and got["duplicate_keys"] == 0


def test_wide_and_long_are_inverse(spark):
    budget = spark.createDataFrame([("2024-02", "Sud", "Mobilier", 5.4), ("2024-02", "Sud", "Autre", 1.0)], "period string, region_name string, category string, budget_revenue double")
    wide = {r.category: r for r in reshape.budget_to_wide(budget, "budget_revenue").collect()}
    assert wide["Sous-total"]["Févr"] == 6.0 and wide["Mobilier"]["Févr"] == 5.0 and wide["Mobilier"]["Janv"] == 0.0


def test_a_missing_manifest_is_refused_before_anything_is_ingested(spark, tmp_path, monkeypatch):
    folder = rawfolder.write(tmp_path / "raw")
    os.remove(os.path.join(folder, specs.MANIFEST_NAME))

    def ingested(*_):
        raise AssertionError("ingested without a manifest")

    monkeypatch.setattr(publish.ingest, "run_ingestion", ingested)
    assert publish.attempt(spark, folder, str(tmp_path / "out")) == 2


def test_lost_revenue_by_condition_on_lines_with_status(spark):
    star = stars.shop(spark)
    condition = F.col("line_id") == star["fact_line"].first().line_id
    keys = star["fact_line"].filter(condition)
    with_status = star["fact_line"].join(star["fact_order"].select("order_id", "status"), "order_id")
    assert first(truth.revenue_lost(with_status, star["fact_order"], condition)) == first(truth.revenue_lost(star["fact_line"], star["fact_order"], keys))
    assert first(truth.business_truth(star["fact_order"], with_status, star["dim_product"])) == first(truth.business_truth(star["fact_order"], star["fact_line"], star["dim_product"]))


@pytest.mark.parametrize("most", [0, 10])
def test_first_of_rarely_repeated_keys(spark, monkeypatch, most):
    """With weights: the same rows whether repeated keys are few enough to be broadcast or not."""
    from starproof.operators import cleaning

    monkeypatch.setattr(cleaning, "MOST_BROADCAST_KEYS", most)
    rows = spark.createDataFrame([("hot", i, i + 1) for i in range(50)] + [(f"k{i}", i, 2) for i in range(20)] + [(None, 2, 3), (None, 1, 4)], "k string, o int, w bigint")
    got = cleaning.keep_first(rows, ["k"], ["o"], "n", "w", rare=True)
    assert got.columns == ["k", "o", "n"]
    assert {(r.k, r.o, r.n) for r in got.collect()} == {("hot", 0, 1275), (None, 1, 7)} | {(f"k{i}", i, 2) for i in range(20)}


def test_an_export_without_a_column_is_refused_before_its_lines_are_read(spark, tmp_path, monkeypatch):
    """Whatever its encoding; a header that has all columns in one encoding only is not refused."""
    good = [";".join(rawfolder.HEADERS), "05/01/2024;O1;1;C1;P1;2;7,00;0.0;S1;Livrée"]
    (tmp_path / "export_ventes_1.csv").write_text("\n".join(good), encoding="cp1252")
    assert readers.scan(spark, str(tmp_path), specs.SALES).first().status == "Livrée"
    (tmp_path / "export_ventes_2.csv").write_text("\n".join(x.rsplit(";", 1)[0] for x in good), encoding="cp1252")

    def looked_into(*_):
        raise AssertionError("lines were read")

    monkeypatch.setattr(readers, "csv_groups", looked_into)
    with pytest.raises(ValueError, match="missing required columns .'status'."):
        readers.scan(spark, str(tmp_path), specs.SALES)


@pytest.mark.parametrize("declared, wanted", [
    (None, ["utf-8-sig", "utf-8-sig", "cp1252", "latin-1"]), ("cp1252", ["cp1252", "cp1252", "cp1252", "latin-1"]),
])
def test_groups_of_csv_files(spark, tmp_path, declared, wanted):
    """Ends of lines, a byte order mark, names with blanks and an empty file; headers come without a sort of the lines."""
    bodies = [b"a;b\r\n1;2\r\n", b"\xef\xbb\xbfa;b\n1;x\n", b"a;b\n1;\xe9\n", b"a;b\n1;\x81\xe9\n\"x\n\";1\n", b""]
    paths = []
    for i, body in enumerate(bodies):
        (tmp_path / f"f {i}+%.csv").write_bytes(body)
        paths.append(str(tmp_path / f"f {i}+%.csv"))
    groups = readers.csv_groups(spark, paths, declared)
    assert {g.header for g in groups} == {b"a;b"}
    got = {p.rsplit("/", 1)[-1]: (g.encoding, g.multiline) for g in groups for p in g.paths}
    assert got == {f"f {i}+%.csv": (e, i == 3) for i, e in enumerate(wanted)}


def test_only_delivered_lines_look_up_their_product(spark):
    from starproof.operators import facts

    plan = facts.delivered_lines(stars.shop(spark), ["month", "category"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert "LeftOuter" in joins[0] and "Inner" in joins[1]  # the outer join is the later one
