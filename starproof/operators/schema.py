"""Header and type operators driven by the source declarations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starproof import specs
from starproof.functions.parsing import parse


def canonical_name(raw: str, source: specs.Source | None) -> str:
    name = str(raw).strip().lower()
    return source.header_map.get(name, name) if source else name


def normalise_headers(
    df: DataFrame, source: specs.Source | None, headers: list[str] | None = None
) -> DataFrame:
    """Trim, lower-case and alias the headers; unknown ones keep their clean form.

    Several raw columns that lead to one canonical name are merged: the first
    non-null value per row, from left to right, is kept. ``headers`` gives the
    raw headers by position when the frame's own names cannot carry them.
    """
    by_position = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    groups: dict[str, list[str]] = {}
    for i, header in enumerate(headers or df.columns):
        groups.setdefault(canonical_name(header, source), []).append(f"c{i}")
    return by_position.select(
        *[(F.coalesce(*cols) if len(cols) > 1 else F.col(cols[0])).alias(name) for name, cols in groups.items()]
    )


def require_names(columns: list[str], source: specs.Source) -> None:
    missing = [c for c in source.required if c not in columns]
    if missing:
        raise ValueError(
            f"source {source.name}: missing required columns {missing}; "
            f"expected {source.required}, present {columns}"
        )


def require_columns(df: DataFrame, source: specs.Source) -> DataFrame:
    require_names(df.columns, source)
    return df


def coerce(df: DataFrame, source: specs.Source) -> DataFrame:
    """Every declared column brought to its declared type, others untouched."""
    kinds = {f.name: f for f in source.fields}
    return df.select(
        *[parse(kinds[c], F.col(c)).alias(c) if c in kinds else F.col(c) for c in df.columns]
    )


def drop_or_keep_invalid(df: DataFrame, source: specs.Source, column: str) -> DataFrame:
    """Rows whose ``column`` could not be read stay only if the field is nullable."""
    return df if source.field(column).nullable else df.filter(F.col(column).isNotNull())


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def star_table(df: DataFrame, table: str) -> DataFrame:
    """Exactly the declared columns of a star table, in the declared order."""
    return df.select(*specs.STAR_COLUMNS[table])
