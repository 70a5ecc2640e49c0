"""Cleaning of the four tabular sources and the key-based de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starproof import specs
from starproof.functions import parsing
from starproof.operators.schema import coerce, drop_or_keep_invalid, normalise_headers, require_columns
from starproof.sources.store import materialise

SALES_KEY = ("order_id", "line_id")

#: Repeated keys, as 64-bit hashes, that are broadcast where they are expected to be rare: 8 MB at most.
MOST_BROADCAST_KEYS = 1_000_000


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hashes of the keys that more than one row has (and, rarely, of others with the same hash), stored.

    A hash aggregate on one long per row, combined in map tasks: nothing is sorted, no other column is read.
    """
    seen = df.select(F.xxhash64(*keys).alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    return materialise(seen.filter("n > 1").select("_key"), "repeated-keys")


def keep_first(
    df: DataFrame, keys: list[str], order: list[str], copies: str | None = None, weight: str | None = None, rare: bool = False
) -> DataFrame:
    """One row per key, the first in ``order`` (ties: the smallest row).

    An ordered minimum in one pass over ``df``, rather than a ranked window: copies collapse inside each map task, so a key
    that holds a third of the rows never reaches a single task whole. Rows are shuffled once, and not at all where ``df``
    comes partitioned by its keys or some of them. Nothing depends on how many keys repeat.
    ``copies`` adds the number of rows each survivor stands for, where each row counts as ``weight`` says (a column that goes).

    ``rare``: keys hardly repeat, and ``df`` is cheap to read again. Repeated keys are then counted first, in a job of its own;
    up to ``MOST_BROADCAST_KEYS`` of them only their rows are shuffled and all others pass by. More: the one pass as above.
    """
    names = [c for c in df.columns if c != weight]
    rest = [c for c in names if c not in keys and c not in order]
    survivor = F.min(F.struct(*order, *rest)).alias("_survivor")
    each = F.col(weight) if weight else F.lit(1).cast("bigint")
    columns: list[Column] = [F.col(c) if c in keys else F.col(f"_survivor.{c}").alias(c) for c in names]

    def first(rows: DataFrame) -> DataFrame:
        picked = rows.groupBy(*keys).agg(survivor, *([F.sum(each).alias(copies)] if copies else []))
        return picked.select(*columns, *([F.col(copies)] if copies else []))

    repeated = repeated_keys(df, keys) if rare else None
    if repeated is None or repeated.count() > MOST_BROADCAST_KEYS:
        return first(df)
    tagged = df.withColumn("_key", F.xxhash64(*keys))
    alone = tagged.join(F.broadcast(repeated), "_key", "left_anti").select(*names, *([each.alias(copies)] if copies else []))
    return alone.unionByName(first(tagged.join(F.broadcast(repeated), "_key", "left_semi").drop("_key")))


def prepare(raw: DataFrame, source: specs.Source) -> DataFrame:
    """Header normalisation and the required-column check."""
    return require_columns(normalise_headers(raw, source), source)


def audit_sales(raw: DataFrame, order: list[str]) -> DataFrame:
    """De-duplicated, typed sales lines, *before* any row is dropped.

    The order matters to the audit: copies go first, then values are read, then
    the counters are taken, and only afterwards undated lines leave. ``_copies``
    is the number of raw rows behind a line. Everything passed in travels through
    the shuffle, so pass only the columns that are needed.
    """
    return typed_sales(keep_first(raw, list(SALES_KEY), order, copies="_copies"))


def typed_sales(lines: DataFrame) -> DataFrame:
    """De-duplicated lines of text (with ``_copies``) brought to their types."""
    typed = {
        "order_date": parsing.strict_date(F.col("order_date"), (parsing.FRENCH_DATE,)),
        "unit_price": parsing.french_amount(F.col("unit_price")),
        "quantity": parsing.whole_number(F.col("quantity")),
        "discount_rate": parsing.points_to_rate(F.col("discount_rate")),
    }
    names = [f.name for f in specs.SALES.fields if f.name in lines.columns]
    return lines.select(*[typed.get(n, F.col(n)).alias(n) for n in names], "_copies")


def dated_sales(audited: DataFrame) -> DataFrame:
    """Lines that can be booked: a valid date is required, a valid price is not."""
    return drop_or_keep_invalid(audited, specs.SALES, "order_date").drop("_copies")


def clean_products(raw: DataFrame) -> DataFrame:
    """Typed catalogue; ``_raw_category`` keeps the spelling before unification."""
    typed = coerce(raw, specs.PRODUCTS)
    return typed.withColumn("_raw_category", F.col("category")).withColumn(
        "category", parsing.canonical_category(F.col("category"))
    )


def clean_customers(raw: DataFrame) -> DataFrame:
    """Typed customers, none dropped; ``_raw_segment`` keeps the entered segment."""
    typed = drop_or_keep_invalid(coerce(raw, specs.CUSTOMERS), specs.CUSTOMERS, "first_order_date")
    return typed.withColumn("_raw_segment", F.col("segment")).withColumn(
        "segment", parsing.canonical_segment(F.col("segment"))
    )


def clean_salespeople(raw: DataFrame) -> DataFrame:
    return coerce(raw, specs.SALESPEOPLE)
