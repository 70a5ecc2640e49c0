"""Wide <-> long budget reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starproof import specs
from starproof.functions import parsing
from starproof.functions.parsing import trimmed, without_missing_tokens
from starproof.operators.schema import coerce

KEYS = ("period", "region_name", "category")


def grid_to_rows(grid: DataFrame, layout: specs.BudgetLayout = specs.BUDGET_LAYOUT) -> DataFrame:
    """(file, sheet, row, cells) -> file, sheet, row, region, category, one column per month.

    The title rows go, the header row gives each sheet its own column positions.
    """
    wanted = (layout.region_header, layout.category_header, *layout.month_labels)
    header = grid.filter(F.col("row") == layout.header_row).select(
        "file", "sheet", F.transform("cells", lambda c: trimmed(c)).alias("header")
    )
    body = grid.filter(F.col("row") > layout.header_row).join(header, ["file", "sheet"])

    def cell(label: str):
        at = F.array_position("header", F.lit(label))
        return F.when(at > 0, without_missing_tokens(F.try_element_at("cells", at.cast("int"))))

    return body.select(
        "file", "sheet", "row",
        cell(wanted[0]).alias("region_name"), cell(wanted[1]).alias("category"),
        *[cell(m).alias(m) for m in layout.month_labels],
    )


def budget_problem(grid: DataFrame, layout: specs.BudgetLayout = specs.BUDGET_LAYOUT) -> DataFrame:
    """One row: what the first incomplete file lacks (a sheet's header row, or columns of it), else NULL.

    A single grouped pass over the grid; only header rows are looked into.
    """
    labels = F.array(*[F.lit(x) for x in (layout.region_header, layout.category_header, *layout.month_labels)])
    lacking = F.array_join(F.array_except(labels, F.transform("cells", lambda c: trimmed(c))), ", ")
    sheets = [s for s, _ in layout.sheet_metrics]

    def header_of(sheet: str):
        return F.when((F.col("sheet") == sheet) & (F.col("row") == layout.header_row), lacking)

    per_file = grid.groupBy("file").agg(*[F.max(header_of(s)).alias(f"_{i}") for i, s in enumerate(sheets)])
    said = F.concat_ws("; ", *[
        F.when(F.col(f"_{i}").isNull(), F.lit(f"no sheet {s} with a header in row {layout.header_row}"))
        .when(F.col(f"_{i}") != "", F.concat(F.lit(f"sheet {s} lacks "), F.col(f"_{i}"))) for i, s in enumerate(sheets)
    ])
    return per_file.select(F.when(said != "", F.concat("file", F.lit(": "), said)).alias("problem")).agg(
        F.min("problem").alias("problem"))


def require_budget(grid: DataFrame, layout: specs.BudgetLayout = specs.BUDGET_LAYOUT) -> DataFrame:
    """``grid``, failing when it is read if a file lacks a sheet, its header row or a column."""
    problem = budget_problem(grid, layout).scalar()
    return grid.filter(F.when(problem.isNotNull(), F.raise_error(
        F.concat(F.lit("incomplete budget file "), problem)).cast("boolean")).otherwise(True))


def fill_down(df: DataFrame, column: str, group: list[str], order: str, block_rows: int = 65536) -> DataFrame:
    """Carry the last non-null value downwards, inside each group, in row order.

    Rows are cut into blocks of consecutive row numbers, so one very long sheet
    is spread over many tasks: each block fills itself, and what it inherits
    comes from one summary row per block.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / block_rows))
    keys = [*group, "_block"]
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inherited = blocked.groupBy(*keys).agg(
        F.max_by(column, F.when(F.col(column).isNotNull(), F.col(order))).alias("_last")
    ).withColumn("_inherited", F.last("_last", ignorenulls=True).over(earlier)).drop("_last")
    return (
        blocked.join(inherited, keys)
        .withColumn(column, F.coalesce(F.last(column, ignorenulls=True).over(inside), F.col("_inherited")))
        .select(*df.columns)
    )


def is_subtotal(layout: specs.BudgetLayout = specs.BUDGET_LAYOUT):
    return F.col("category").eqNullSafe(F.lit(layout.subtotal_marker))


def drop_subtotals(df: DataFrame, layout: specs.BudgetLayout = specs.BUDGET_LAYOUT) -> DataFrame:
    return df.filter(~is_subtotal(layout))


def months_to_rows(
    df: DataFrame, ids: list[str], value: str, labels: tuple[str, ...] = specs.BUDGET_LAYOUT.month_labels
) -> DataFrame:
    """Twelve month columns -> (month_label, value) rows."""
    return df.unpivot(ids, list(labels), "month_label", value)


def merge_metrics(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer merge of one-metric tables on their common grid."""
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), frames)


def stack_metrics(long: DataFrame, keys: list[str], metric: str, value: str, metrics: list[str]) -> DataFrame:
    """The same merge as a single shuffle: metric rows -> one column per metric."""
    return long.groupBy(*keys).pivot(metric, metrics).agg(F.first(value, ignorenulls=True))


def reshape_budget(grid: DataFrame, layout: specs.BudgetLayout = specs.BUDGET_LAYOUT) -> tuple[DataFrame, DataFrame]:
    """Landed budget grid -> (long budget table, sheet rows before subtotals leave).

    Both metrics go through one unpivot and one pivot instead of one pass each. Sheets are merged per file and, for
    a key that a sheet holds more than once, occurrence by occurrence, so repeated rows stay and are counted.
    A file without one of the sheets, its header row or a column is an error when the result is read.
    """
    rows = fill_down(grid_to_rows(require_budget(grid, layout), layout), "region_name", ["file", "sheet"], "row")
    metric_of_sheet = F.create_map(*[F.lit(x) for pair in layout.sheet_metrics for x in pair])
    metrics = [m for _, m in layout.sheet_metrics]
    place = ["file", "sheet", "region_name", "category"]
    detail = drop_subtotals(rows, layout).withColumn(
        "occurrence", F.row_number().over(Window.partitionBy(*place).orderBy("row")))
    long = months_to_rows(detail, [*place, "occurrence"], "amount", layout.month_labels).withColumn(
        "period",
        parsing.period_of_label(parsing.year_in_file_name(F.col("file")), F.col("month_label"), layout.month_labels),
    ).withColumn("metric", F.try_element_at(metric_of_sheet, F.col("sheet"))).filter("metric IS NOT NULL")
    wide = stack_metrics(long, ["file", "occurrence", *KEYS], "metric", "amount", metrics).drop("file", "occurrence")
    return coerce(wide, specs.BUDGET), rows


def budget_to_wide(
    budget: DataFrame, value: str, labels: tuple[str, ...] = specs.BUDGET_LAYOUT.month_labels,
    marker: str = specs.BUDGET_LAYOUT.subtotal_marker,
) -> DataFrame:
    """Long budget -> year x region x category rows with 12 months and a subtotal per region.

    Grouping sets give the detail and the subtotal rows in one aggregation;
    missing months are 0, amounts are rounded to whole units.
    """
    base = budget.select(
        parsing.period_year(F.col("period")).alias("year"), parsing.period_month(F.col("period")).alias("month"),
        "region_name", "category", value,
    )
    months = [
        F.round(F.coalesce(F.sum(F.when(F.col("month") == i, F.col(value))), F.lit(0)), 0).cast("double").alias(label)
        for i, label in enumerate(labels, start=1)
    ]
    year, region, category = F.col("year"), F.col("region_name"), F.col("category")
    wide = base.groupingSets(
        [[year, region, category], [year, region]], year, region, category
    ).agg(F.grouping("category").alias("is_subtotal"), *months)
    return wide.select(
        "year", "region_name", F.when(F.col("is_subtotal") == 1, marker).otherwise(F.col("category")).alias("category"),
        F.col("is_subtotal").cast("int").alias("is_subtotal"), *labels,
    )
