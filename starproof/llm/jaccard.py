"""N-gram Jaccard join by MinHash banding, verified on the full n-gram sets.

1. One pass over the texts gives each document the fingerprint of its n-gram set and its band hashes.
2. Documents with equal sets form one class; only classes go on, so copies are never paired.
3. Band hashes are shuffled. Each class that shares a bucket gets a home tile, a bounded piece of
   its fullest bucket, and every bucket names the pairs of tiles that meet in it.
4. A tile is one row holding its members' full n-gram sets. A pair of tiles is verified inside a
   task by a count of common n-grams; what leaves the task is one row per member (its number of
   links and the root of its local component), never a row per pair.
5. Connected components of those rows give the near-duplicate groups.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starproof.llm.components import components
from starproof.llm.scratch import stored
from starproof.llm.words import Words, followed, in_slices, long_array, mixed

NGRAM = 5
THRESHOLD = "0.8"
TARGET_RECALL = 0.999999
MOST_HASHES = 128
TILE_MEMBERS = 512
TILE_NGRAMS = 400_000


def bands_for(threshold: float, recall: float, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective bands that still find a pair at ``threshold`` with probability ``recall``."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def ngram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all n-grams, and their offsets by text. A text of 1 to n-1 words is one n-gram."""
    h = words.hashes()
    counts = words.counts
    made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(made)])
    start = np.repeat(words.first[:-1] - first[:-1], made) + np.arange(first[-1])
    length = np.repeat(np.minimum(counts, n), made)
    padded = np.concatenate([h, np.zeros(n, np.uint64)])
    out = mixed(length.astype(np.uint64))
    for j in range(n):
        out = np.where(length > j, followed(out, padded[start + j]), out)
    return out, first


def sets_of(words: Words, n: int) -> list[np.ndarray]:
    grams, first = ngram_hashes(words, n)
    return [np.unique(grams[a:b]) for a, b in zip(first[:-1], first[1:])]


def _fingerprint(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def _signer(n: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(7)
        a = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        b = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
        factors = rng.integers(0, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        salt = mixed(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            for lo, hi, words in in_slices(batch.column("text")):
                sets = sets_of(words, n)
                size = np.array([len(s) for s in sets])
                full = np.flatnonzero(size)
                least = np.zeros((bands * rows, len(full)), np.uint32)
                if len(full):
                    flat = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
                    at = np.concatenate([[0], np.cumsum(size[full])[:-1]])
                    for j in range(bands * rows):
                        least[j] = np.minimum.reduceat(flat * a[j] + b[j], at)
                keys = np.zeros((len(full), bands), np.uint64)
                for k in range(rows):
                    keys += least[k::rows].T.astype(np.uint64) * factors[k]
                keys = mixed(keys + salt)
                lists: list = [[]] * len(sets)
                for row, i in enumerate(full):
                    lists[i] = keys[row].view(np.int64)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_key"), pa.array([_fingerprint(s) for s in sets], pa.binary()),
                     pa.array(size, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                    ["doc_id", "row_key", "fp", "n_grams", "bands"],
                )
    return sign


def row_key() -> Column:
    """16 bytes from doc_id and text: rows with equal keys are one document to this operator."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(doc_id, F.lit(":"), F.coalesce("text", F.lit("")))))


def _with_sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in in_slices(batch.column("text")):
                grams = [s.tobytes() for s in sets_of(words, n)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("bucket", "piece", "fp", "copies")]
                    + [pa.array(grams, pa.binary())],
                    ["bucket", "piece", "fp", "copies", "grams"],
                )
    return sets


class _Tile:
    def __init__(self, members: list[dict]):
        by_fp = {m["fp"]: m for m in members}
        self.fp = sorted(by_fp)
        self.copies = np.array([by_fp[f]["copies"] for f in self.fp], np.int64)
        self.sets = [np.frombuffer(by_fp[f]["grams"], np.uint64) for f in self.fp]
        self.size = np.array([len(s) for s in self.sets], np.int64)


def common_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, by blocks of n-grams that occur on both sides."""
    def shared(sets, ids):
        out = []
        for row, s in enumerate(sets):
            at = np.searchsorted(ids, s)
            at[at == len(ids)] = 0
            hit = at[ids[at] == s] if len(ids) else at[:0]
            out.append((np.full(len(hit), row), hit))
        rows, cols = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(cols, kind="stable")
        return rows[order], cols[order]

    ids = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    total = np.zeros((len(left), len(right)), np.float32)
    (lr, lc), (rr, rc) = shared(left, ids), shared(right, ids)
    for lo in range(0, len(ids), columns):
        a = np.zeros((len(left), columns), np.float32)
        b = np.zeros((len(right), columns), np.float32)
        for m, rows, cols in ((a, lr, lc), (b, rr, rc)):
            i, j = np.searchsorted(cols, [lo, lo + columns])
            m[rows[i:j], cols[i:j] - lo] = 1
        total += a @ b.T
    return total.astype(np.int64)


def linked(left: _Tile, right: _Tile, threshold: Fraction) -> np.ndarray:
    """Whether Jaccard similarity reaches the threshold, in whole numbers."""
    both = common_counts(left.sets, right.sets)
    union = left.size[:, None] + right.size[None, :] - both
    return both * threshold.denominator >= union * threshold.numerator


def _roots(links: np.ndarray) -> np.ndarray:
    """For a symmetric relation: the smallest index of each member's component."""
    root = np.arange(len(links))
    while True:
        reach = np.where(links, root[None, :], len(links)).min(axis=1)
        new = np.minimum(root, reach)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _verifier(threshold: Fraction):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a = _Tile(batch.column("a")[i].as_py())
                other = batch.column("b")[i].as_py()
                if other is None:
                    names, m = a.fp, linked(a, a, threshold)
                    np.fill_diagonal(m, False)
                    counts = m @ a.copies
                else:
                    b = _Tile(other)
                    names, part = a.fp + b.fp, linked(a, b, threshold)
                    counts = np.concatenate([part @ b.copies, part.T @ a.copies])
                    m = np.zeros((len(names), len(names)), bool)
                    m[: len(a.fp), len(a.fp) :] = part
                    m |= m.T
                root = _roots(m)
                keep = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[k] for k in keep], pa.binary()), pa.array([names[root[k]] for k in keep], pa.binary()),
                     pa.array(counts[keep], pa.int64())],
                    ["fp", "root", "links"],
                )
    return verify


TILE = "array<struct<fp: binary, copies: bigint, grams: binary>>"


def near_duplicates(
    docs: DataFrame, n: int = NGRAM, threshold: str = THRESHOLD, recall: float = TARGET_RECALL,
    tile_members: int = TILE_MEMBERS, tile_ngrams: int = TILE_NGRAMS,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, row_key, n_grams, class_id, n_links, keeper.

    Words are runs of non-white-space, unchanged; a document is the set of its n-word sequences.
    Two documents are linked if the Jaccard similarity of their sets is at least ``threshold``;
    ``n_links`` counts a document's links, copies included; ``class_id`` is the smallest doc_id
    of its connected component, and ``keeper`` is true for the component's smallest (doc_id, row_key).

    Null and empty texts have no n-grams: no link, a class of their own under their own doc_id,
    keeper true. A text of fewer than ``n`` words is one n-gram. Repeated rows are copies of each
    other with equal results. Null doc_ids sort last; a class of null ids alone has a null class_id.
    Other columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    limit = Fraction(threshold)
    bands, rows = bands_for(float(limit), recall)
    source = docs.select("doc_id", row_key().alias("row_key"), "text")
    signed = stored(
        source.mapInArrow(
            _signer(n, bands, rows), "doc_id bigint, row_key binary, fp binary, n_grams bigint, bands array<bigint>"
        ), "signatures",
    )
    classes = stored(
        signed.filter("fp is not null").groupBy("fp").agg(
            F.count("*").alias("copies"), F.min("row_key").alias("rep"), F.first("n_grams").alias("n_grams"),
            F.first("bands").alias("bands"), F.min("doc_id").alias("least_id"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("head"),
        ), "classes",
    )
    members = classes.select("fp", "n_grams", F.explode("bands").alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count("*").alias("m"), F.sum("n_grams").alias("total")).filter("m > 1")
    seats = stored(members.join(crowded, "bucket").select("bucket", "fp", "m", "total"), "seats")

    pieces = F.greatest(
        F.ceil(F.col("h.m") / tile_members), F.ceil(F.col("h.total") / tile_ngrams), F.lit(1)
    ).cast("bigint")
    home = stored(
        seats.groupBy("fp").agg(F.max(F.struct("m", "bucket", "total")).alias("h")).select(
            "fp", F.col("h.bucket").alias("home"), F.pmod(F.xxhash64("fp"), pieces).cast("int").alias("piece")
        ), "homes",
    )
    met = seats.select("bucket", "fp").join(home, "fp").select("bucket", F.struct("home", "piece").alias("tile")).distinct()
    met = stored(met, "met")
    pairs = met.alias("x").join(met.alias("y"), "bucket").filter("x.tile < y.tile").select(
        F.col("x.tile").alias("t1"), F.col("y.tile").alias("t2")
    ).distinct()

    wanted = home.join(classes.select("fp", "rep", "copies"), "fp").select(
        F.col("rep").alias("row_key"), F.col("home").alias("bucket"), "piece", "fp", "copies"
    )
    sets = source.select("row_key", "text").join(wanted, "row_key").mapInArrow(
        _with_sets(n), "bucket bigint, piece int, fp binary, copies bigint, grams binary"
    )
    tiles = stored(
        sets.groupBy("bucket", "piece").agg(F.collect_set(F.struct("fp", "copies", "grams")).alias("members"))
        .select(F.struct(F.col("bucket").alias("home"), "piece").alias("tile"), "members"), "tiles",
    )
    alone = tiles.filter(F.size("members") > 1).select(F.col("members").alias("a"), F.lit(None).cast(TILE).alias("b"))
    across = pairs.join(tiles.select(F.col("tile").alias("t1"), F.col("members").alias("a")), "t1").join(
        tiles.select(F.col("tile").alias("t2"), F.col("members").alias("b")), "t2"
    ).select("a", "b")
    schema = "fp binary, root binary, links bigint"
    checked = stored(
        alone.mapInArrow(_verifier(limit), schema).unionByName(across.mapInArrow(_verifier(limit), schema)), "links"
    )

    links = checked.groupBy("fp").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("fp").alias("u"), F.col("root").alias("v")))
    by_set = stored(classes.select("fp", "copies", "least_id", "head").join(links, "fp", "left").join(
        roots.select(F.col("node").alias("fp"), "root"), "fp", "left"
    ).select(
        "fp", "least_id", "head", F.coalesce("root", "fp").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    ), "by_set")
    # Stored, so that the join below has a plain shuffle on both sides and a large group can be split.
    heads = stored(by_set.groupBy("root").agg(
        F.min("least_id").alias("class_id"), F.min("head").alias("head")
    ).select("root", "class_id", F.col("head.row_key").alias("head")), "heads")
    known = by_set.select("fp", "root", "n_links").join(heads, "root").drop("root")
    return signed.select("doc_id", "row_key", "fp", "n_grams").join(known, "fp", "left").select(
        "doc_id", "row_key", "n_grams", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce(F.col("row_key") == F.col("head"), F.lit(True)).alias("keeper"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, all columns kept.

    Rows equal in doc_id and text count as one document; of these one stays.
    """
    kept = near_duplicates(docs, **options).filter("keeper").select(F.col("row_key").alias("_row_key")).distinct()
    tagged = docs.withColumn("_row_key", row_key())
    return tagged.join(kept, "_row_key", "left_semi").dropDuplicates(["_row_key"]).drop("_row_key")
