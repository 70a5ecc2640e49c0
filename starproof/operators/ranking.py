"""Totals, shares and running totals that do not funnel rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starproof.functions.measures import pct
from starproof.sources.store import materialise


def grand_total(df: DataFrame, column: str) -> Column:
    """Total of ``column`` over the grouped frame ``df``, as a scalar subquery.

    The subquery asks for every measure of ``df``, so both uses of ``df`` keep the
    same partial aggregate and its shuffle runs once (a pruned copy would differ
    and scan the facts again). Pass a frame without unused measures.
    """
    measures = [c for c, kind in df.dtypes if c != column and kind.startswith(("decimal", "bigint", "double"))]
    whole = df.select(F.struct(F.sum(column).alias("total"), *[F.max(c) for c in measures]))
    return whole.scalar()["total"]


def with_share(df: DataFrame, column: str = "revenue", name: str = "revenue_share_pct") -> DataFrame:
    return df.withColumn(name, pct(F.col(column), grand_total(df, column)))


def running_share(totals: DataFrame, key: str, value: str = "revenue", partitions: int | None = None) -> DataFrame:
    """Rank by ``value`` descending with the running share of the grand total.

    Adds ``rank``, ``cumulative`` and ``cumulative_pct``. Rows are range
    partitioned on (value desc, key), which also splits a run of equal values;
    every row stores the partition it went to and the result is written once to
    shared storage, so a lost executor cannot move a row to another partition
    later. One small row per partition then gives the offsets, and the ordered
    window runs inside each partition.
    """
    spark = totals.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(value).desc_nulls_last(), F.col(key).asc_nulls_last()]
    placed = materialise(
        totals.select(key, value).repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()),
        "ranked",
    )
    per_part = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    # at most n rows: a window over all of them is safe
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = per_part.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rank0"),
        F.sum("_s").over(before).alias("_sum0"),
        F.sum("_s").over(everything).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.join(F.broadcast(offsets), "_part")
    running = F.sum(value).over(inside)
    # NULL only while every value up to this row is NULL, as in one global window
    cumulative = F.when(
        running.isNotNull() | F.col("_sum0").isNotNull(),
        F.coalesce(running, F.lit(0)) + F.coalesce(F.col("_sum0"), F.lit(0)),
    )
    return ranked.select(
        key, value,
        (F.count(F.lit(1)).over(inside) + F.col("_rank0")).alias("rank"),
        cumulative.alias("cumulative"),
        pct(cumulative, F.col("_total")).alias("cumulative_pct"),
    )


#: Buckets of one narrowing step, and values that are small enough to be finished in one list.
BUCKETS, FEW = 1024, 4096


def rows_within_share(totals: DataFrame, value: str, share: float) -> tuple[int, int]:
    """(rows, all rows): how many of the largest rows have a running share of the total of at most ``share`` per cent.

    The rows are never sorted or ranked. A histogram of the range that holds the mark, combined in map tasks, says
    in which bucket it lies; that bucket is the next range, until it is a single value or holds few. Equal values are
    interchangeable, so the place inside a run of them follows by arithmetic: the result is that of ``running_share``. Each
    step sends at most ``BUCKETS`` rows to the driver. A total that is not above zero has no such mark: then the curve decides.
    """
    values = materialise(totals.select(F.col(value).alias("v")), "shares")
    everything = values.agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.max("v").alias("high")).first()
    if everything.total is None or everything.total <= 0:
        curve = running_share(values.withColumn("k", F.monotonically_increasing_id()), "k", "v")
        return curve.filter(F.col("cumulative_pct") <= share).count(), everything.n
    total = float(everything.total)

    def within(cumulative) -> bool:
        return 100.0 * float(cumulative) / total <= share

    taken, reached = 0, 0 * everything.total
    low, high = 0 * everything.total, everything.high  # rows of nothing or less lie behind the mark: all above them make the total
    positive = values.filter(F.col("v") > 0)
    while True:
        # The difference is taken between the exact values: what is close together stays apart.
        depth = (F.lit(high) - F.col("v")).cast("double") * (BUCKETS / float(high - low))
        found = positive.filter((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high))).groupBy(
            F.least(F.floor(depth), F.lit(BUCKETS - 1)).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("b").collect()
        for bucket in found:
            if not within(reached + bucket.s):
                break
            taken, reached = taken + bucket.n, reached + bucket.s
        else:
            return taken, everything.n
        shrunk = (low, high) != (bucket.low, bucket.high)
        low, high = bucket.low, bucket.high
        if low == high or bucket.n <= FEW or not shrunk:
            break
    runs = [(high, bucket.n)] if low == high else positive.filter((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high))).groupBy(
        "v").count().orderBy(F.desc("v")).collect()
    for v, n in runs:
        first, last = 0, n  # of n equal rows, as many as stay within the share
        while first < last:
            middle = (first + last + 1) // 2
            first, last = (middle, last) if within(reached + middle * v) else (first, middle - 1)
        taken, reached = taken + first, reached + first * v
        if first < n:
            break
    return taken, everything.n
