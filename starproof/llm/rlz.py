"""Substring de-duplication by relative Lempel-Ziv factors.

Every document is parsed against all documents with a smaller doc_id. The reference is indexed in
blocks of ``WINDOW`` consecutive words, each under a 128-bit fingerprint with the place where it first
occurs: the smallest doc_id and the position in it. A factor starts where a block is indexed, and is extended greedily, word by
word, as long as the next block is indexed one word further on in the same reference; so it is a copy of the reference's
words from that place on, at least one block long. Where the place jumps or a block is missing the factor ends; blocks
that straddle such a boundary are looked up as any other, so no common run of ``WINDOW`` words is lost there.

Indexing every block of every document would multiply the corpus, so blocks are indexed only where
they can recur: of each run of ``WINDOW - SEED + 1`` seeds (sequences of ``SEED`` words) the one with
the least hash is kept, so that equal blocks keep an equal seed, and only blocks around a
seed that two different texts keep are indexed. This filter is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starproof.llm.scratch import stored
from starproof.llm.words import in_slices, long_array, mixed, ragged, window_hashes

WINDOW = 50
SEED = 20
FACTOR = ("start", "length", "ref_doc", "ref_start")

def kept_seeds(seeds: np.ndarray, span: int) -> np.ndarray:
    """Positions that hold the least hash of some ``span`` consecutive ones (the leftmost of equals)."""
    runs = np.lib.stride_tricks.sliding_window_view(seeds, span)
    return np.unique(runs.argmin(axis=1) + np.arange(len(runs)))


def _seeder(window: int, seed: int):
    """One row per document: its distinct kept seeds, each with all its positions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in in_slices(batch.column("text")):
                h = words.hashes()
                found, positions, runs = [], [], []
                for a, b in zip(words.first[:-1], words.first[1:]):
                    if b - a < window:
                        found.append(np.zeros(0, np.uint64))
                        continue
                    s = window_hashes(h[a:b], seed)
                    at = kept_seeds(s, window - seed + 1)
                    at = at[np.argsort(s[at], kind="stable")]
                    new = np.flatnonzero(np.concatenate([[True], np.diff(s[at]) != 0]))
                    found.append(s[at[new]])
                    positions.append(at)
                    runs.append(np.diff(np.append(new, len(at))))
                first = np.concatenate([[0], np.cumsum([len(x) for x in found])])
                nested = np.concatenate([[0], np.cumsum(np.concatenate([[], *runs]))]).astype(np.int64)
                flat = np.concatenate([np.zeros(0, np.int64), *positions]).astype(np.int32)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(words.counts, pa.int64()),
                     ragged(long_array(np.concatenate(found)), first),
                     ragged(ragged(pa.array(flat), nested), first)],
                    ["doc_id", "text_key", "n_words", "seeds", "positions"],
                )
    return run


def _near(positions: np.ndarray, blocks: int, window: int, seed: int) -> np.ndarray:
    """Starts of the blocks that hold a seed at one of ``positions``."""
    reach = np.zeros(blocks + 1, np.int64)
    np.add.at(reach, np.clip(positions - (window - seed), 0, blocks), 1)
    np.add.at(reach, np.clip(positions + 1, 0, blocks), -1)
    return np.flatnonzero(np.cumsum(reach[:-1]) > 0)


def _blocks(h: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of the blocks from ``starts`` on, by hashes of words that have nothing in common."""
    return window_hashes(h, window)[starts], window_hashes(mixed(~h), window)[starts]


def _indexer(window: int, seed: int):
    """One row per document and distinct block near a shared seed: fingerprint and all its starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in in_slices(batch.column("text")):
                h = words.hashes()
                part = batch.slice(lo, hi - lo)
                near = part.column("positions").to_pylist()
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    starts = _near(np.array(near[i], np.int64), b - a - window + 1, window, seed)
                    if not len(starts):
                        continue
                    h1, h2 = _blocks(h[a:b], starts, window)
                    order = np.lexsort((starts, h2, h1))
                    h1, h2, starts = h1[order], h2[order], starts[order]
                    new = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(part.column("doc_id")[i], len(new)), pa.repeat(part.column("tag")[i], len(new)),
                         long_array(h1[new]), long_array(h2[new]),
                         ragged(pa.array(starts.astype(np.int32)), np.append(new, len(starts)))],
                        ["doc_id", "tag", "h1", "h2", "starts"],
                    )
    return run


def factors_of(starts: np.ndarray, refs: np.ndarray, places: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, length, reference, place in it) from the indexed positions of one document."""
    order = np.argsort(starts, kind="stable")
    starts, refs, places = starts[order], refs[order], places[order]
    if not len(starts):
        return []
    cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(refs) != 0) | (np.diff(places) != 1)) + 1
    out = []
    for run in np.split(np.arange(len(starts)), cut):
        a, z = run[0], run[-1]
        out.append((int(starts[a]), int(starts[z] - starts[a] + window), int(refs[a]), int(places[a])))
    return out


def _cutter(window: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.large_string()),
        ("factors", pa.list_(pa.struct([(n, pa.int64() if n == "ref_doc" else pa.int32()) for n in FACTOR]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in in_slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                lists = [part.column(c).to_pylist() for c in ("dup", "refs", "places")]
                first_doc = part.column("first_doc").to_pylist()
                ids = part.column("doc_id").to_pylist()
                raw = words.data.tobytes()
                out = []
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    n = int(b - a)
                    if ids[i] is not None and first_doc[i] is not None and first_doc[i] < ids[i] and n >= window:
                        found = [(0, n, first_doc[i], 0)]  # the whole text is one factor of its first copy
                    else:
                        found = factors_of(*[np.array(x[i] or [], np.int64) for x in lists], window)
                    gone = np.zeros(n + 1, np.int64)
                    for start, length, _, _ in found:
                        gone[start] += 1
                        gone[start + length] -= 1
                    keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                    s, e = words.starts[a:b][keep], words.ends[a:b][keep]
                    text = b" ".join([raw[x:y] for x, y in zip(s.tolist(), e.tolist())])
                    out.append({
                        "doc_id": ids[i], "n_words": n, "n_removed": n - len(keep), "kept_text": text.decode(),
                        "factors": [dict(zip(FACTOR, f)) for f in found],
                    })
                yield pa.RecordBatch.from_pylist(out, schema)
    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_text, factors.

    Words are runs other than the six ASCII white-space characters, unchanged. A word goes if it lies in
    ``window`` consecutive words that also start in a document with a smaller doc_id, judged on the
    input. ``kept_text`` joins the other words by one space; ``factors`` lists (start, length, ref_doc, ref_start): those words of
    the document are the words of the reference document from ``ref_start`` on.

    Null texts count as empty; texts shorter than a window keep every word. Rows of equal doc_id never
    remove words of each other, also when their texts differ. A null doc_id is neither smaller nor
    larger than any other: such rows keep all words and are no reference. Other columns are
    ignored; an empty table gives an empty result.
    """
    source = docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"), "text")
    parsed = stored(
        source.mapInArrow(
            _seeder(window, seed),
            "doc_id bigint, text_key binary, n_words bigint, seeds array<bigint>, positions array<array<int>>",
        ), "seeds",
    ).filter("doc_id is not null")
    # Copies: only the first one is parsed and indexed.
    first = parsed.groupBy("text_key").agg(F.min("doc_id").alias("first_doc"))
    leads = parsed.filter("n_words >= %d" % window).groupBy("text_key").agg(
        F.min("doc_id").alias("doc_id"), F.first("seeds").alias("seeds"), F.first("positions").alias("positions")
    )
    seeds = leads.select("doc_id", "text_key", F.explode(F.arrays_zip("seeds", "positions")).alias("s")).select(
        "doc_id", "text_key", F.col("s.seeds").alias("seed"), F.col("s.positions").alias("positions")
    )
    shared = seeds.groupBy("seed").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("seed")
    spots = stored(
        seeds.join(shared, "seed").groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("positions")).alias("positions")), "spots"
    )
    # The tag tells the texts of one doc_id apart, at half the bytes of their key.
    located = source.join(spots, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"]).withColumn("tag", F.xxhash64("text_key"))
    blocks = stored(
        located.mapInArrow(
            _indexer(window, seed), "doc_id bigint, tag bigint, h1 bigint, h2 bigint, starts array<int>"
        ), "blocks",
    )
    index = blocks.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", F.col("starts")[0].alias("place"))).alias("ref"), F.max("doc_id").alias("hi")
    ).select("h1", "h2", F.col("ref.doc_id").alias("ref"), F.col("ref.place").alias("place"), "hi").filter("ref < hi")
    repeats = blocks.join(index, ["h1", "h2"]).filter("doc_id > ref").select(
        "doc_id", "tag", "ref", "place", F.explode("starts").alias("start")
    ).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "ref", "place")).alias("r"))
    repeats = repeats.select("doc_id", "tag", F.col("r.start").alias("dup"), F.col("r.ref").alias("refs"), F.col("r.place").alias("places"))
    marks = parsed.select("doc_id", "text_key").distinct().withColumn("tag", F.xxhash64("text_key")).join(first, "text_key").join(
        repeats, ["doc_id", "tag"], "left"
    ).filter("first_doc < doc_id or dup is not null").drop("tag")
    return source.join(stored(marks, "marks"), ["doc_id", "text_key"], "left").mapInArrow(
        _cutter(window),
        "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, "
        "factors array<struct<start: int, length: int, ref_doc: bigint, ref_start: int>>",
    )
