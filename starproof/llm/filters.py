"""Interaction of document filters, audited for every order in which they can be applied.

A document's failures are a mask, one bit per filter. Per part, the masks are counted and the counts
become the leaves of a decision diagram: one level per filter, each node with the weight below it, equal
sub-diagrams shared. Two neighbouring levels are swapped in place, and a sequence of such swaps passes
through all orders. In each, the path on which nothing fails leads from the root past the documents
that each step keeps, and its other branches are what each step removes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starproof.llm.scratch import stored

#: Fixed values of the filters.
NAMES = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # per cent of the words
MOST_CAPITALS = 5  # per cent of the code points
MARKS = "[#$%&*|]"

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COLUMNS)
Weight = tuple[int, ...]  # documents, good ones, toxic ones


def _bit(failed: Column, name: str) -> Column:
    return F.when(failed, 1 << NAMES.index(name)).otherwise(0)


def own_failures(text: Column) -> Column:
    """The bits of A to D, which a text decides alone."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return (_bit(n < LEAST_WORDS, "A") + _bit(100 * distinct.cast("bigint") < LEAST_DISTINCT * n.cast("bigint"), "B")
            + _bit(100 * capitals.cast("bigint") > MOST_CAPITALS * F.length(text).cast("bigint"), "C") + _bit(text.rlike(MARKS), "D"))


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): the documents of each part by their failures, at most 32 rows per part.

    Only those of equal texts that bear the smallest doc_id pass E. They are found by joins on (text's digest, doc_id), so
    that a group of copies is spread over tasks; all other rows of the digest are the rest.
    """
    text = F.coalesce("text", F.lit(""))
    plain = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    plain = plain.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), own_failures(F.col("text")).alias("own"))
    flags = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = stored(plain.join(flags, "doc_id", "left"), "failures")
    first = rows.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    passing = rows.filter("doc_id is not null").join(first, ["digest", "doc_id"], "left_semi").unionByName(rows.filter("doc_id is null"))

    def counted(df: DataFrame, bit: int, sign: int) -> DataFrame:
        sums = [F.coalesce(F.sum(c), F.lit(0)) * sign for c in ("good", "toxic")]
        return df.groupBy("part", (F.col("own") + bit).alias("mask")).agg(
            (F.count("*") * sign).alias("n"), sums[0].alias("good"), sums[1].alias("toxic"))

    e = 1 << NAMES.index("E")
    pieces = counted(rows, e, 1).unionByName(counted(passing, e, -1)).unionByName(counted(passing, 0, 1))
    return pieces.groupBy("part", "mask").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n", "good", "toxic")]).filter("n > 0")


class Diagram:
    """A decision diagram over failure masks whose nodes carry the weights below them.

    Level k holds {node: (node reached when the filter of this level passes, when it fails)}; the last
    level's children are leaves, one per different weight. No level is skipped, so a node's weight is the sum of its children's.
    """

    def __init__(self, names: str, weights: dict[int, Weight], width: int = 3):
        self.order = list(names)
        none = (0,) * width
        self.weight: list[Weight] = []
        leaves: dict[Weight, int] = {}
        below = []
        for mask in range(1 << len(names)):
            w = weights.get(mask, none)
            if w not in leaves:
                leaves[w] = self._node(w)
            below.append(leaves[w])
        self.levels: list[dict[int, tuple[int, int]]] = []
        for k in reversed(range(len(names))):  # bit k of the mask belongs to names[k]
            known: dict[tuple[int, int], int] = {}
            below = [self._shared(known, below[m], below[m | 1 << k]) for m in range(1 << k)]
            self.levels.insert(0, {node: pair for pair, node in known.items()})
        (self.root,) = below

    def _node(self, weight: Weight) -> int:
        self.weight.append(weight)
        return len(self.weight) - 1

    def _shared(self, known: dict, low: int, high: int) -> int:
        if (low, high) not in known:
            known[low, high] = self._node(tuple(a + b for a, b in zip(self.weight[low], self.weight[high])))
        return known[low, high]

    def swap(self, k: int) -> None:
        """Levels k and k + 1 change places; nodes of level k stay what they are to the levels above."""
        upper, lower = self.levels[k], self.levels[k + 1]
        known: dict[tuple[int, int], int] = {}
        turned = {}
        for node, (low, high) in upper.items():
            (ll, lh), (hl, hh) = lower[low], lower[high]
            turned[node] = self._shared(known, ll, hl), self._shared(known, lh, hh)
        self.levels[k], self.levels[k + 1] = turned, {node: pair for pair, node in known.items()}
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]

    def all_pass(self) -> Iterator[tuple[str, Weight, Weight]]:
        """Per level from the root: its filter, the weight that passes on, the weight that fails here."""
        node = self.root
        for name, level in zip(self.order, self.levels):
            node, failed = level[node]
            yield name, self.weight[node], self.weight[failed]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Positions k to swap with k + 1, passing once through every order of n things: the last thing sweeps
    through the others, which move on by one swap of their own sequence at each turn."""
    if n < 2:
        return
    down, up = list(reversed(range(n - 1))), list(range(n - 1))
    sweep, inner = down, adjacent_swaps(n - 1)
    while True:
        yield from sweep
        k = next(inner, None)
        if k is None:
            return
        yield k + (sweep is down)  # the sweeping thing now stands in front of the others, or behind them
        sweep = up if sweep is down else down


def audited(names: str, weights: dict[int, Weight]) -> Iterator[tuple]:
    """(order, step, *COLUMNS) for every order of the filters and every step."""
    diagram = Diagram(names, weights)
    paths = {"".join(diagram.order): list(diagram.all_pass())}
    for k in adjacent_swaps(len(names)):
        diagram.swap(k)
        paths["".join(diagram.order)] = list(diagram.all_pass())
    fails, alone, shapley = {}, {}, dict.fromkeys(names, 0)
    for path in paths.values():
        fails[path[0][0]], alone[path[-1][0]] = path[0][2][0], path[-1][2][0]
        for name, _, failed in path:
            shapley[name] += failed[0]
    for order, path in paths.items():
        for step, (name, passed, failed) in enumerate(path, 1):
            yield order, step, passed[0], failed[0], fails[name] - failed[0], alone[name], failed[1], failed[2], shapley[name]


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "filter_order", "step", *COLUMNS]
    for batch in batches:
        for part, masks in zip(batch.column("part").to_pylist(), batch.column("masks").to_pylist()):
            rows = list(audited(NAMES, {m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks}))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows)), pa.array(columns[0]), pa.array(columns[1], pa.int32())]
                + [pa.array(c, pa.int64()) for c in columns[2:]], names)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part of ``docs`` (doc_id, text, source), order of the five filters and step, as in ``SCHEMA``.

    A null text counts as empty, a null source as the empty one. Texts are equal to the byte. A null doc_id is smaller than none
    and has none before it, so it passes E; rows repeated with their doc_id don't fail each other. Of several labels
    (doc_id, quality, toxic) of one doc_id any 1 counts; null ones don't. Other columns are ignored; an empty table gives no row.
    """
    masks = masked(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return masks.mapInArrow(_audit, SCHEMA)
