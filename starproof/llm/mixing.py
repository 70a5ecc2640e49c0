"""Mixing sources to target weights by capped water-filling, in built-in expressions only.

Sources share a budget by weight; none gets more than ``MOST_EPOCHS`` times its own size, and what one
cannot take is shared by the others in proportion to weight until none is above its cap. A
source is then taken in whole repetitions, plus a seeded subset of its documents for the fraction.
The subset is the head of the documents in the order of a hash, cut as near as possible to the
words still wanted, so a source misses its target by half a document at most. Equal rows share their hash; where
the cut falls among them, they are numbered, and so many as are wanted are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starproof.llm.scratch import stored

MOST_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
_COARSE, _FINE = 2, 4  # hex digits: a source's documents lie in 256 buckets of 256 finer ones


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def _hash(seed: str, doc_id: Column, text: Column) -> Column:
    """Equal for rows that are equal in doc_id and text, and for no others."""
    own = F.md5(F.coalesce(text, F.lit("")))
    return F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), own))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def water_fill(sources: DataFrame, most_epochs: int = MOST_EPOCHS, weights: tuple = WEIGHTS) -> DataFrame:
    """Adds ``target`` to (key, source, source_size), one row per source; the targets add up to all sizes.

    Sorted by cap per weight, the capped sources are a prefix. Each row gets the water level that holds if all
    before it are capped; the first source above its level fixes the level for the rest.
    """
    by_name, by_cap = Window.orderBy(F.asc_nulls_last("source")), Window.orderBy("ratio", "key")
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1))
    s = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * float(most_epochs))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    left = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    free = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    s = s.withColumn("level", left / free)
    level = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "key", "level"))).over(everything)["level"]
    filled = F.when(level.isNull(), F.col("cap")).otherwise(F.least("cap", level * F.col("weight")))
    return s.withColumn("target", filled).select("key", "source_size", "target")


def _holding(sums: DataFrame, by: str) -> DataFrame:
    """Of each key's rows (key, by, size, before, want), in the order of ``by``, the one in which the wanted words end."""
    running = F.col("before") + F.sum("size").over(Window.partitionBy("key").orderBy(by)) - F.col("size")
    return sums.withColumn("before", running).filter((F.col("before") < F.col("want")) & (F.col("before") + F.col("size") >= F.col("want"))).groupBy(
        "key").agg(F.min(F.struct(by, "before", "want")).alias("e")).select("key", "e.*")


def plan(sized: DataFrame, most_epochs: int = MOST_EPOCHS, weights: tuple = WEIGHTS) -> DataFrame:
    """One row per source of ``sized`` (key, source, size, hash): key, source_size, target, whole, bucket, cut, some, alike.

    A document of the source is repeated ``whole`` times, and once more if its hash lies before ``bucket``, or in it and before
    ``cut``, or is ``cut`` and the row one of the ``some`` that are taken of the ``alike`` rows with this hash. The place of the
    cut is narrowed from coarse buckets to fine ones to hashes, so no window runs over more than 256 buckets of a source.
    """
    fine = stored(sized.groupBy("key", "source", F.substring("hash", 1, _FINE).alias("bucket")).agg(F.sum("size").alias("size")), "mix_buckets")
    sources = fine.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    sources = water_fill(sources, most_epochs, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    sources = stored(sources.withColumn("whole", whole).withColumn("want", F.col("target") - F.col("whole") * F.col("source_size")), "mix")
    coarse = fine.groupBy("key", F.substring("bucket", 1, _COARSE).alias("head")).agg(F.sum("size").alias("size"))
    head = _holding(coarse.join(sources.select("key", "want"), "key").withColumn("before", F.lit(0).cast("bigint")), "head")
    inner = fine.withColumn("head", F.substring("bucket", 1, _COARSE)).join(head, ["key", "head"])
    edges = _holding(inner.select("key", "bucket", "size", "before", "want"), "bucket")
    inside = sized.withColumn("bucket", F.substring("hash", 1, _FINE)).join(edges, ["key", "bucket"])
    folds = inside.groupBy("key", "hash", "before", "want").agg(F.count("*").alias("alike"), F.first("size").alias("size"))
    order = Window.partitionBy("key").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("alike")).over(order), F.lit(0))
    folds = folds.withColumn("at", at).withColumn("near", F.floor((F.col("want") - F.col("at")) / F.col("size") + F.lit(0.5)))

    def fits(copies: Column) -> Column:  # so many copies leave the target less than half a document behind
        return F.col("at") + (copies - 1) * F.col("size") + F.col("size") / 2 <= F.col("want")

    some = F.when(F.col("size") == 0, F.when(F.col("at") <= F.col("want"), F.col("alike")).otherwise(0)).when(
        fits(F.col("near") + 1), F.col("near") + 1).when(fits(F.col("near")), F.col("near")).otherwise(F.col("near") - 1)
    cuts = folds.withColumn("some", F.least(some, "alike").cast("bigint")).filter("some > 0").groupBy("key").agg(
        F.max(F.struct("hash", "some", "alike")).alias("c")).select("key", F.col("c.hash").alias("cut"), "c.some", "c.alike")
    return stored(sources.join(edges.select("key", "bucket"), "key", "left").join(cuts, "key", "left"), "mix_plan").drop("want")


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``nth`` to the rows of one key and hash: 1 to their number; counted per task first, so that equal rows need not meet."""
    parts = stored(rows.withColumn("_part", F.spark_partition_id()), "alike")
    own = [c for c in rows.columns if c not in ("key", "hash")]
    nth = F.row_number().over(Window.partitionBy("key", "hash", "_part").orderBy(F.xxhash64(*own)))
    counts = parts.groupBy("key", "hash", "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("key", "hash").orderBy("_part")) - F.col("_n")
    offsets = counts.select("key", "hash", "_part", before.alias("_before"))
    return parts.withColumn("_nth", nth).join(offsets, ["key", "hash", "_part"]).withColumn(
        "nth", F.col("_nth") + F.col("_before")).drop("_part", "_nth", "_before")


def _with_times(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``rows`` (key, hash, ...) with the columns of their source's plan and ``times``, how often each is taken."""
    both = rows.join(planned, "key")
    split = F.coalesce((F.col("hash") == F.col("cut")) & (F.col("some") < F.col("alike")), F.lit(False))
    more = F.coalesce(F.substring("hash", 1, _FINE) < F.col("bucket"), F.lit(False)) | F.coalesce(
        (F.substring("hash", 1, _FINE) == F.col("bucket")) & (F.col("hash") <= F.col("cut")), F.lit(False))
    plain = both.withColumn("times", F.col("whole") + more.cast("int"))
    if planned.filter("some < alike").isEmpty():
        return plain
    ties = planned.filter("some < alike").select("key", F.col("cut").alias("hash"))
    tied = _numbered(rows.join(ties, ["key", "hash"], "left_semi")).join(planned, "key")
    tied = tied.withColumn("times", F.col("whole") + (F.col("nth") <= F.col("some")).cast("int")).drop("nth")
    return plain.filter(~split).unionByName(tied)


def mixture(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken.

    Size is the number of words; null and empty texts have none and are taken without effect. Sources are
    weighted in code-point order, the null source last; an empty name is a source like any other. Repeated rows are
    taken one by one, rows of one doc_id with different texts each by their own hash, also under a null doc_id. Other
    columns are ignored; an empty table gives an empty result. Equal input gives equal output.
    """
    sized = stored(docs.select(
        "doc_id", "source", _key(F.col("source")).alias("key"), n_words(F.col("text")).alias("size"),
        _hash(seed, F.col("doc_id"), F.col("text")).alias("hash")), "sized")
    both = _with_times(sized.select("key", "hash", "doc_id", "size"), plan(sized))
    return both.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, all columns kept (also ones named as ours)."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own = {n: F.col(f"c{names.index(n)}") for n in ("doc_id", "source", "text")}
    rows = plain.withColumn("key", _key(own["source"])).withColumn("hash", _hash(seed, own["doc_id"], own["text"]))
    sized = stored(rows.select("key", own["source"].alias("source"), n_words(own["text"]).alias("size"), "hash"), "sized")
    taken = _with_times(rows, plan(sized)).filter("times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return taken.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
