"""Token counts of sections by offset mapping.

A document is encoded once, as a whole. The character span of every token follows from the byte lengths of the
tokens; an interval join with the document's sections, by binary search, counts the tokens of each. A token
that crosses a section's edge is allocated by an explicit rule.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starproof.llm.pii import running

RULES = ("first", "last", "share")


@functools.cache
def encoding(path: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The vocabulary, and the number of bytes of each token."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size


def spans(text: str, codec: tiktoken.Encoding, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and character after the last of every token; a token inside a character has that character."""
    ids = np.array(codec.encode_ordinary(text), np.int64)
    data = np.frombuffer(text.encode(), np.uint8)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    ends = np.cumsum(sizes[ids])
    starts = ends - sizes[ids]
    return chars[starts + 1] - 1 if len(ids) else starts, chars[ends]


def counts(first: np.ndarray, last: np.ndarray, start: np.ndarray, end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, tokens that cross an edge) of every section [start, end) under ``rule``."""
    end = np.maximum(start, end)
    # Tokens that touch the section, and those that lie inside it.
    touching = np.searchsorted(first, end) - np.searchsorted(last, start, "right")
    inside = np.maximum(np.searchsorted(last, end, "right") - np.searchsorted(first, start), 0)
    touching = np.where(end > start, np.maximum(touching, 0), 0)
    crossing = touching - np.minimum(inside, touching)
    if rule == "first":
        n = np.searchsorted(first, end) - np.searchsorted(first, start)
    elif rule == "last":
        n = np.searchsorted(last - 1, end) - np.searchsorted(last - 1, start)
    else:
        # Each token is spread evenly over its characters; characters of several tokens add up.
        size = np.maximum(last - first, 1)
        length = int(max([0, *last, *end])) + 1
        density = np.zeros(length + 1)
        np.add.at(density, first, 1 / size)
        np.add.at(density, first + size, -1 / size)
        total = np.concatenate([[0], np.cumsum(np.cumsum(density)[:-1])])
        n = total[end] - total[start]
    return np.asarray(n, float), crossing


def _counter(path: str, pattern: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, sizes = encoding(path, pattern)
        for batch in batches:
            text, given = batch.column("text"), batch.column("sections")
            for i in range(batch.num_rows):
                sections = [s for s in given[i].as_py() or [] if s is not None]
                first, last = spans(text[i].as_py() or "", codec, sizes)
                start = np.array([s["start"] or 0 for s in sections], np.int64)
                end = np.array([s["end"] or 0 for s in sections], np.int64)
                n, crossing = counts(first, last, start, end, rule)
                k = len(sections)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("doc_id")[i].as_py()] * k, pa.int64()), pa.array([s["name"] for s in sections], pa.string()),
                     pa.array(start), pa.array(end), pa.array(n, pa.float64()), pa.array(crossing, pa.int64()),
                     pa.array([len(first)] * k, pa.int64())],
                    ["doc_id", "section", "start", "end", "tokens", "crossing", "doc_tokens"])
    return run


def with_lines(docs: DataFrame) -> DataFrame:
    """Adds ``sections``: the lines of a text, each with the line break behind it; they partition the text."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    lengths = F.transform(lines, lambda x: (F.length(x) + 1).cast("bigint"))
    whole = F.length(F.coalesce("text", F.lit(""))).cast("bigint")
    sections = F.transform(
        F.arrays_zip(running(F.col("_n")).alias("start"), F.col("_n").alias("n")),
        lambda x, i: F.struct(i.cast("string").alias("name"), x["start"].alias("start"), F.least(x["start"] + x["n"], F.col("_len")).alias("end")))
    return docs.withColumn("_n", lengths).withColumn("_len", whole).withColumn("sections", sections).drop("_n", "_len")


def attributed(docs: DataFrame, path: str, pattern: str, rule: str = "first") -> DataFrame:
    """One row per section of ``docs`` (doc_id, text, sections): doc_id, section, start, end, tokens, crossing, doc_tokens.

    ``sections`` lists (name, start, end) in code points, end exclusive; sections may overlap, leave gaps, or be empty.
    The rule says where a token counts that crosses an edge: ``first``, the section of its first character;
    ``last``, that of its last; ``share``, each by its part of the token's characters. Tokens inside one character
    (bytes of it) have that character. Under ``first`` and ``last`` the counts of a partition add up to the document's.

    Null and empty texts have no token; null section lists and entries give no row, null bounds count as 0. Repeated
    rows get rows each; other columns are ignored; an empty table gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    schema = "doc_id bigint, section string, start bigint, end bigint, tokens double, crossing bigint, doc_tokens bigint"
    return docs.select("doc_id", "text", "sections").mapInArrow(_counter(path, pattern, rule), schema)
