"""Approximate nearest neighbours by a forest of random-projection trees.

The forest is fitted on a bounded sample: a node splits its rows at the median of their projections
on a random direction. All vectors are then routed to one leaf of every tree. A query walks all trees
through one shared priority queue, best margin first, until the leaves it has seen hold its share of the
rows. Queries and vectors meet by leaf; a pair that meets in leaves of several trees is a candidate in the first of
these trees only, so that its exact distance is computed once. The nearest of all leaves are reranked. Equal vectors
are one point of the index, so no leaf holds a group of copies; leaves meet their queries in chunks of both.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starproof.llm.scratch import stored

TREES = 8
LEAF_ROWS = 128
SAMPLE_ROWS = 16_384
CALIBRATION_QUERIES = 256
TARGET_RECALL = 0.93
CHUNK_ROWS = 8_192
CHUNK_QUERIES = 2_048

#: A point's name: the smallest vec_id that has its vector, and a hash of the vector, since one vec_id may have several.
POINT = ("point", "mark")
ASKER = ("query", "query_mark")


@dataclass
class Tree:
    directions: np.ndarray  # one row per inner node
    thresholds: np.ndarray
    children: np.ndarray  # (left, right); a negative number -k-1 is leaf k

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        node = np.zeros(len(x), np.int64) if len(self.children) else np.full(len(x), -1)
        while True:
            at = np.flatnonzero(node >= 0)
            if not len(at):
                return -node - 1
            for k in np.unique(node[at]):
                rows = at[node[at] == k]
                right = x[rows] @ self.directions[k] >= self.thresholds[k]
                node[rows] = self.children[k][right.astype(int)]


@dataclass
class Forest:
    trees: list[Tree]
    sizes: list[np.ndarray]  # share of the sample in each leaf, by tree
    dim: int
    share: float = 1.0  # of the rows, with repeats over trees, that a query should see

    @property
    def most_leaves(self) -> int:
        return max(len(t.children) + 1 for t in self.trees)

    def visited(self, q: np.ndarray, share: float | None = None) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue, until the share is reached."""
        share = self.share if share is None else share
        heap = [(0.0, t, 0 if len(tree.children) else -1) for t, tree in enumerate(self.trees)]
        margins = [tree.directions @ q - tree.thresholds for tree in self.trees]
        heapq.heapify(heap)
        out, seen = [], 0.0
        while heap and seen < share:
            far, t, node = heapq.heappop(heap)
            while node >= 0:
                m = float(margins[t][node])
                near, other = self.trees[t].children[node][::-1] if m >= 0 else self.trees[t].children[node]
                heapq.heappush(heap, (max(far, abs(m)), t, int(other)))
                node = int(near)
            out.append((t, -node - 1))
            seen += self.sizes[t][-node - 1]
        return out


def fit_tree(x: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    directions, thresholds, children, leaves = [], [], [], 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf_rows:
            d = rng.normal(size=x.shape[1])
            d /= np.linalg.norm(d)
            p = x[rows] @ d
            cut = float(np.median(p))
            right = p >= cut
            if right.any() and not right.all():
                k = len(directions)
                directions.append(d)
                thresholds.append(cut)
                children.append([0, 0])
                children[k] = [grow(rows[~right]), grow(rows[right])]
                return k
        leaves += 1
        return -leaves

    grow(np.arange(len(x)))
    dim = x.shape[1]
    return Tree(np.array(directions).reshape(-1, dim), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2))


def fit(x: np.ndarray, trees: int = TREES, leaf_rows: int = LEAF_ROWS, k: int = 10, recall: float = TARGET_RECALL, seed: int = 11) -> Forest:
    """A forest over a sample, with the least share of rows that finds ``recall`` of the sample's own neighbours."""
    rng = np.random.default_rng(seed)
    forest = Forest([fit_tree(x, leaf_rows, rng) for _ in range(trees)], [], x.shape[1])
    at = [t.leaves(x) for t in forest.trees]
    forest.sizes = [np.bincount(a, minlength=len(t.children) + 1) / len(x) for a, t in zip(at, forest.trees)]
    probe = rng.permutation(len(x))[:CALIBRATION_QUERIES]
    d = ((x[probe][:, None, :] - x[None, :, :]) ** 2).sum(-1) if len(x) <= 256 else (
        (x[probe] ** 2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * x[probe] @ x.T)
    d[np.arange(len(probe)), probe] = np.inf
    near = np.argsort(d, axis=1)[:, : min(k, len(x) - 1)]
    if not near.size:
        forest.share = float(trees)
        return forest
    # For every true neighbour, the share seen when its first leaf comes up.
    needed = np.full(near.shape, float(trees))
    for r, q in enumerate(probe):
        seen = 0.0
        first: dict[tuple[int, int], float] = {}
        for t, leaf in forest.visited(x[q], share=float("inf")):
            seen += forest.sizes[t][leaf]
            first[t, leaf] = seen
        for c, n in enumerate(near[r]):
            needed[r, c] = min(first[t, int(at[t][n])] for t in range(trees))
    forest.share = float(np.quantile(needed, recall))
    return forest


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _router(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("vector").flatten()).reshape(batch.num_rows, -1)
            leaves = np.column_stack([tree.leaves(x) for tree in forest.trees]).astype(np.int32)
            first = np.arange(len(x) + 1, dtype=np.int32) * len(forest.trees)
            listed = pa.ListArray.from_arrays(pa.array(first), pa.array(leaves.ravel()))
            for t in range(len(forest.trees)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(leaves[:, t]), *[batch.column(c) for c in (*POINT, "vector")], listed],
                    ["tree", "leaf", *POINT, "vector", "leaves"])
    return run


def _walker(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                q = np.array(batch.column("vector")[i].as_py())
                seen = forest.visited(q)
                n = len(seen)
                codes = [t * forest.most_leaves + leaf for t, leaf in seen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in seen], pa.int32()), pa.array([leaf for _, leaf in seen], pa.int32()),
                     *[pa.repeat(batch.column(c)[i], n) for c in (*POINT, "vector")],
                     pa.repeat(pa.scalar(codes, pa.list_(pa.int32())), n)], ["tree", "leaf", *ASKER, "vector", "seen"])
    return run


def _nearest(k: int, trees: int, most_leaves: int):
    """Exact distances of some queries of a leaf to some of its rows, for pairs that no earlier tree has brought together; the
    k nearest of each query."""
    names = [*ASKER, *POINT, "score"]

    def run(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: np.zeros(0, np.float64 if c == "score" else np.int64) for c in names})]
        if len(queries) and len(rows):
            tree = key[0]
            rows = rows.sort_values([*POINT])
            x = np.stack(rows["vector"].to_numpy()).astype(np.float64)
            earlier = np.stack(rows["leaves"].to_numpy())[:, :tree] + np.arange(tree) * most_leaves
            points = [rows[c].to_numpy(np.int64) for c in POINT]
            for own in zip(*[queries[c] for c in (*ASKER, "vector", "seen")]):
                met = np.zeros(trees * most_leaves, bool)
                met[own[3]] = True
                new = np.flatnonzero(~met[earlier].any(axis=1))
                d = np.sqrt(((x[new] - np.asarray(own[2], np.float64)) ** 2).sum(axis=1))
                near = np.argsort(d, kind="stable")[:k]
                values = [np.full(len(near), v, np.int64) for v in own[:2]] + [p[new][near] for p in points] + [d[near]]
                out.append(pd.DataFrame(dict(zip(names, values))))
        return pd.concat(out)
    return run


def neighbours(
    vectors: DataFrame, queries: Column, k: int = 10, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
    sample_rows: int = SAMPLE_ROWS, recall: float = TARGET_RECALL,
) -> DataFrame:
    """The ``k`` nearest found of every row of ``vectors`` (vec_id, embedding) for which ``queries`` holds.

    Columns query_id, rank (from 1), vec_id, score: Euclidean distance in double precision, ties to the smaller
    vec_id; a row is no candidate of itself. Vectors that are null, empty, zero, or hold a null or non-finite component
    take no part, nor do vectors of another length than most have (ties to the shorter). Rows with a null vec_id take no
    part. Repeated rows of one vec_id are one candidate, and with different vectors several, each with its own score; a
    query with several vectors asks with each, and a candidate counts at the nearest. Fewer than ``k`` candidates give fewer rows; an empty table gives none. Other columns are ignored.

    The forest is fitted on at most ``sample_rows`` distinct vectors, the least by a hash; every row is indexed.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"),
                          queries.alias("asks")).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dim = lengths[0]["n"] if lengths else 0
    rows = rows.filter(F.size("vector") == dim)
    # Equal vectors: one point, named by its smallest id, with the ids that a query can want of it.
    ids = rows.select("vector", "vec_id").distinct().withColumn(
        "place", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).filter(F.col("place") <= k + 1)
    points = stored(ids.groupBy("vector").agg(F.min("vec_id").alias("point"), F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn(
        "mark", F.xxhash64("vector")), "points")
    asked = stored(rows.filter("asks").select("vec_id", "vector").distinct().join(points.select("vector", *POINT), "vector"), "asked")
    picked = points.select(*POINT).orderBy(F.xxhash64(*POINT), *POINT).limit(sample_rows)
    sample = points.select(*POINT, "vector").join(F.broadcast(picked), [*POINT]).collect()  # sample_rows at most: names are unique
    sample = sorted(sample, key=lambda r: (r.point, r.vector))
    x = np.array([r.vector for r in sample]).reshape(len(sample), dim)
    empty = "query_id long, rank int, vec_id long, score double"
    if not len(x):
        return spark.createDataFrame([], empty)
    forest = fit(x, trees, leaf_rows, k, recall)
    shared = spark.sparkContext.broadcast(forest)  # at most trees * sample_rows / leaf_rows * 4 directions
    index = stored(points.select(*POINT, "vector").mapInArrow(
        _router(shared), "tree int, leaf int, point bigint, mark bigint, vector array<double>, leaves array<int>"), "leaves")
    walks = stored(asked.select(*POINT, "vector").dropDuplicates([*POINT]).mapInArrow(
        _walker(shared), "tree int, leaf int, query bigint, query_mark bigint, vector array<double>, seen array<int>"), "walks")
    # Chunks bound what one task holds of a leaf and of its queries, however many there are.
    spot = ["tree", "leaf"]
    chunks = index.groupBy(*spot).count().select(*spot, F.ceil(F.col("count") / CHUNK_ROWS).cast("int").alias("chunks")).join(
        walks.groupBy(*spot).count().select(*spot, F.ceil(F.col("count") / CHUNK_QUERIES).cast("int").alias("parts")), spot)
    chunks = stored(chunks, "chunks")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = index.join(chunks, spot).withColumn("chunk", F.pmod(F.xxhash64(*POINT), "chunks").cast("int")).withColumn("part", every("parts"))
    asking = walks.join(chunks, spot).withColumn("chunk", every("chunks")).withColumn("part", F.pmod(F.xxhash64(*ASKER), "parts").cast("int"))
    # A query needs k other rows: at most k points besides those of its own vectors.
    most = k + (asked.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 1)
    keys = [*spot, "chunk", "part"]
    found = asking.select(*keys, *ASKER, "vector", "seen").groupBy(*keys).cogroup(
        held.select(*keys, *POINT, "vector", "leaves").groupBy(*keys)
    ).applyInPandas(_nearest(most, trees, forest.most_leaves), "query bigint, query_mark bigint, point bigint, mark bigint, score double")
    order = Window.partitionBy(*ASKER).orderBy("score", *POINT)
    best = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= most)
    names = dict(zip(POINT, ASKER))
    wide = asked.select(F.col("vec_id").alias("query_id"), *[F.col(c).alias(n) for c, n in names.items()]).join(best, [*ASKER]).join(
        points.select(*POINT, "ids"), [*POINT]).withColumn("vec_id", F.explode("ids")).filter("vec_id <> query_id")
    nearest = wide.groupBy("query_id", "vec_id", *POINT).agg(F.min("score").alias("score"))
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return nearest.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
