"""Publication: write a complete set in a place of its own, prove it, then move the pointer to it."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
import datetime as dt
import sys
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starproof import specs
from starproof.operators.reshape import budget_to_wide
from starproof.plans import checks, ingest, reporting, views
from starproof.sources import files, pointer, readers
from starproof.sources.store import materialise, release

STAGING = "_staging"

# the published set, in reading order
OUTPUT_ORDER = (
    "summary", "margin_by_category", "budget_monthly", "customers_and_segments", "dashboard",
    "by_month", "by_salesperson", "annex_lines", "reconciliation",
)


def period_bounds(by_month: DataFrame) -> DataFrame:
    """First and last month as one row; the label is NULL when there is no month."""
    return by_month.agg(F.min("month").alias("first_month"), F.max("month").alias("last_month")).withColumn(
        "period_label",
        F.concat("first_month", F.lit(" → "), "last_month"),
    ).withColumn(
        "stem",
        F.when(F.col("first_month").isNull(), "reporting")
        .when(F.col("first_month") == F.col("last_month"), F.concat(F.lit("reporting_"), "first_month"))
        .otherwise(F.concat(F.lit("reporting_"), "first_month", F.lit("_to_"), "last_month")),
    ).withColumn(
        "folder", F.concat_ws("_", F.substring("first_month", 1, 4), F.substring("last_month", 1, 4))
    )


def set_name(by_month: DataFrame, stamp: str) -> str:
    """What a run is published as, after the data's own period."""
    row = period_bounds(by_month).first()
    return f"{row.folder or str(dt.date.today().year)}/{row.stem}_{stamp}"


def published(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The tables of the current set, all of one run; a missing publication is an error."""
    _, content = pointer.current(spark, out_dir)
    if content is None:
        raise FileNotFoundError(f"nothing is published in {out_dir}")
    return {t: spark.read.parquet(f"{set_path(out_dir, content)}/{t}") for t in content["tables"]}


def set_path(out_dir: str, content: Mapping) -> str:
    return f"{out_dir.rstrip('/')}/{pointer.SETS}/{content['set']}"


def write_set(tables: Mapping[str, DataFrame], staging: str) -> None:
    """One Parquet directory per table; each carries its own _SUCCESS marker. Small tables share the cluster."""
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda t: t[1].write.mode("errorifexists").parquet(f"{staging}/{t[0]}"), tables.items()))


def commit(spark: SparkSession, staging: str, final: str) -> None:
    """Make a complete set visible under its final name in one rename."""
    files.rename(spark, staging, final)


def monthly_export(by_month: DataFrame) -> DataFrame:
    return by_month.withColumnRenamed("revenue", "revenue_eur")


def write_by_month(lines: DataFrame, path: str, month: str = "month") -> None:
    """One directory per month. Rows are brought together by month and adaptive execution evens that out by bytes: a month
    that holds most rows is split over many tasks, small ones share a task. Files per month follow its size, not tasks x months."""
    lines.hint("rebalance", month).write.partitionBy(month).parquet(path)


def export_delimited(df: DataFrame, path: str) -> None:
    """Semicolon-separated dimension export, dates as ISO text."""
    dates = {f.name for f in df.schema if f.dataType.typeName() == "date"}
    columns = [F.date_format(c, "yyyy-MM-dd").alias(c) if c in dates else F.col(c) for c in df.columns]
    df.select(*columns).write.csv(path, sep=";", header=True)


def export_budget_wide(budget: DataFrame, path: str) -> None:
    """Wide budget per metric and year, subtotals in place."""
    for metric in ("budget_revenue", "budget_margin"):
        budget_to_wide(budget, metric).write.partitionBy("year").parquet(f"{path}/{metric}")


def manifest_json(truth: DataFrame, anomalies: DataFrame, expected: DataFrame, generation: DataFrame) -> DataFrame:
    """One row of nested JSON: generation, true figures, injected anomalies, expectations.

    The true figures are those of ``truth.business_truth``, written under the manifest's own names.
    """
    truth = truth.select(*[F.col(ours).alias(name) for name, ours in specs.TRUTH_FIELDS.items()])

    def one(df: DataFrame):
        return df.select(F.struct("*")).scalar()

    return truth.sparkSession.range(1).select(
        F.to_json(
            F.struct(
                one(generation).alias("generation"), one(truth).alias("verite_financiere"),
                one(anomalies).alias("anomalies_injectees"), one(expected).alias("attendus_apres_nettoyage"),
            )
        ).alias("value")
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.text(path)


def published_tables(
    finance: Mapping[str, DataFrame], lines: DataFrame, by_month: DataFrame, report: DataFrame
) -> dict[str, DataFrame]:
    """The nine-table set, in reading order."""
    pareto = reporting.customers_for_share(finance["client_pareto"])
    tables = {
        "summary": finance["summary"],
        "margin_by_category": finance["by_category"],
        "budget_monthly": finance["budget_monthly"],
        "customers_and_segments": finance["by_segment"].select(
            "*", pareto.select("customers_for_share").scalar().alias("customers_for_80_pct")
        ),
        "dashboard": reporting.dashboard_kpis(lines),
        "by_month": monthly_export(by_month),
        "by_salesperson": finance["by_salesperson"],
        "annex_lines": lines,
        "reconciliation": checks.report_table(report),
    }
    return {name: tables[name] for name in OUTPUT_ORDER}


def run(spark: SparkSession, raw_dir: str, out_dir: str, stamp: str | None = None) -> str:
    """Ingest, prove, derive, publish; returns the path of the published set.

    Raises FileNotFoundError without sources or manifest, IntegrityError when a check fails, also one of key
    uniqueness or of budget regions; ``pointer.Conflict`` when another run has published since this one began. Nothing is
    published then, and what was written is deleted; what a lost driver leaves is for ``pointer.leftovers``.
    """
    stamp = stamp or dt.datetime.now().strftime("%Hh%M")
    seen, _ = pointer.current(spark, out_dir)
    expected = readers.read_manifest(spark, raw_dir).select("attendus_apres_nettoyage.*")  # absent: refused before anything is read
    loaded = ingest.run_ingestion(spark, raw_dir)
    proof = checks.reconcile(loaded.star, loaded.reports, expected)
    report = spark.createDataFrame(checks.gate(proof), proof.schema)
    checks.gate(checks.structural_checks(loaded.star, loaded.unknown_budget_regions))
    content = {"set": uuid.uuid4().hex}
    target = set_path(out_dir, content)
    try:
        write_set({"annex_lines": reporting.reporting_lines(loaded.star)}, target)  # once; the rest reads it from there
        lines = spark.read.parquet(f"{target}/annex_lines")
        by_month = materialise(reporting.revenue_by_month(lines), "by-month")
        finance = views.build_views(loaded.star)
        tables = {**published_tables(finance, lines, by_month, report), **_detail(finance)}
        write_set({name: df for name, df in tables.items() if name != "annex_lines"}, target)
        pointer.advance(spark, out_dir, seen, {**content, "name": set_name(by_month, stamp), "tables": list(tables)})
    except BaseException:
        files.delete(spark, target)
        raise
    return target


def _detail(finance: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The remaining finance views, published next to the nine tables."""
    names = ("by_year", "monthly", "budget_by_region", "category_mix", "client_pareto", "client_top", "by_discount_band")
    return {f"detail_{n}": finance[n] for n in names}


def _refused(problem: Exception) -> bool:
    """Whether the input is at fault: a check, an absent or incomplete source. Anything else is a failure of the run."""
    if isinstance(problem, (checks.IntegrityError, FileNotFoundError, ValueError, pointer.Conflict)):
        return True
    return isinstance(problem, PySparkException) and "USER_RAISED_EXCEPTION" in str(problem)


def attempt(spark: SparkSession, raw_dir: str, out_dir: str) -> int:
    """Exit codes: 0 published, or a source is absent; 2 manifest missing, input unfit or a check failed, or overtaken."""
    absent = [s.name for s in specs.SOURCES.values()
              if not files.exists(spark, raw_dir) or not files.list_files(spark, raw_dir, s.file_glob)]
    if absent:
        print(f"nothing to do in {raw_dir}: no files of {', '.join(absent)}")
        return 0
    try:
        print(f"published {run(spark, raw_dir, out_dir)}")
        return 0
    except Exception as problem:  # noqa: BLE001
        if not _refused(problem):
            raise
        print(f"not published: {problem}")
        return 2


def main(argv: list[str]) -> int:
    raw_dir, out_dir = argv
    spark = SparkSession.builder.appName("starproof").getOrCreate()
    try:
        return attempt(spark, raw_dir, out_dir)
    finally:
        release(spark)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
