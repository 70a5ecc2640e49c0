"""BPE encoding and decoding of whole texts by tree concatenation.

Long texts are halved until the leaves are short; leaves of very long ones are rows of their own, so they are encoded in
parallel by many tasks, and others stay in their document's task. Neighbours are then joined pairwise, level by level: a window around the join is encoded again and grown on
both sides until its outer tokens agree exactly with those of the halves, which fixes every
token in between. White space always separates the pieces that the vocabulary merges, so a leaf
preferably ends there; inside a long run without white space it ends anywhere and the windows
do the work.

Within a task the texts of a batch are laid out as words with the white space behind them; each
distinct one is encoded once by the library and the ids are gathered by array operations.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starproof.llm.words import Words, chunks_of, found, slices, utf8

#: Characters of a leaf, and tokens of a first window on either side of a join.
LEAF_CHARS = 16_384
#: Characters of a text whose leaves are spread over tasks; those of shorter texts fill one task's batch anyway.
SPREAD_CHARS = 65_536
FIRST_WINDOW = 8
MOST_CACHED = 200_000
SLICE_BYTES = 2 << 20
CHUNKS_PER_TEXT = 2_000
#: What separates words. Python's strip() would also take U+001C to U+001F, which are tokens of their own.
WHITE = " \t\n\v\f\r"


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core already
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _steps(part: dict | None, name: str) -> list[str]:
    """The types of the steps of a normaliser or pre-tokenizer, as its file declares them."""
    if part is None:
        return []
    return [s["type"] for s in part[name]] if part["type"] == "Sequence" else [part["type"]]


def _word_by_word(declared: dict) -> bool:
    """Whether white space is dropped and only separates, so that the ids of a text are those of its words, end to end.

    That is known for normalisers that look at single characters or at runs of white space, before a split that keeps
    what its pattern matches and whose pattern matches no white space, without added tokens that hold or take in white space.
    """
    pre = declared["pre_tokenizer"] or {}
    split = (pre.get("pretokenizers") or [pre])[0]
    plain = all(s in ("NFC", "Replace", "Lowercase") for s in _steps(declared["normalizer"], "normalizers"))
    steps = (declared["normalizer"] or {}).get("normalizers", [])
    blanks = all(s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in steps if s["type"] == "Replace")
    keeps = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
    rest = _steps(pre or None, "pretokenizers")[1:] in ([], ["ByteLevel"]) and not any(
        s.get("add_prefix_space") for s in pre.get("pretokenizers", []))
    apart = keeps and not re.search(r"\\s(?![^\[]*\])|\\S|\.| ", split["pattern"].get("Regex", ".").replace(r"[^\s", "["))
    tokens = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]))
                 for t in declared["added_tokens"])
    return bool(plain and blanks and keeps and rest and apart and tokens and declared["post_processor"] is None)


class Codec:
    """One vocabulary in one worker, with the ids and the decoding of the chunks seen last."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        # The chunks seen last: a row for each, and flat arrays of their ids and of the characters of each token.
        self.cache: dict[str, int] = {}
        self.size = np.zeros(0, np.int64)
        self.ids, self.spans = np.zeros(0, "<u4"), np.zeros((0, 2), np.int32)
        declared = json.loads(self.tokenizer.to_str())
        # Without a decoder the library puts one space between tokens, so texts can be decoded chunk by chunk.
        self.by_chunk = declared["decoder"] is None
        self.by_words, self.lowers = _word_by_word(declared), "Lowercase" in _steps(declared["normalizer"], "normalizers")
        self.added = [t["content"] for t in declared["added_tokens"]]
        self.tokens = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()} if self.by_chunk else {}

    def encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def decode(self, ids: np.ndarray) -> str:
        if self.by_chunk:
            return " ".join(map(self.tokens.__getitem__, ids.tolist()))
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def keyed(self, words: Words) -> tuple[list[str], np.ndarray]:
        """The distinct chunks of the words, and the code of every word. A chunk is as the vocabulary's own normaliser leaves
        it where that is plain, one key for many spellings; one that holds an added token, in any case, stays as it is."""
        chunks, codes = chunks_of(words)
        plain = pc.ascii_trim(chunks, characters=WHITE)
        plain = pc.ascii_lower(plain) if self.lowers else plain
        for token in self.added:
            plain = pc.if_else(pc.match_substring(chunks, token, ignore_case=True), chunks, plain)
        coded = plain.dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[codes]

    def known(self, keys: list[str]) -> np.ndarray:
        """The row of each key. White space separates, so new keys are encoded many to a text."""
        cache = self.cache
        if len(cache) > MOST_CACHED:
            cache.clear()
            self.size, self.ids, self.spans = self.size[:0], self.ids[:0], self.spans[:0]
        new = [k for k in keys if k not in cache]
        sizes, ids, spans = [self.size], [self.ids], [self.spans]
        for lo in range(0, len(new), CHUNKS_PER_TEXT):
            part = new[lo : lo + CHUNKS_PER_TEXT]
            ends = np.cumsum([len(c) + 1 for c in part])
            e = self.encode("\n".join(part))
            ids.append(np.array(e.ids, "<u4"))
            own = np.fromiter(itertools.chain.from_iterable(e.offsets), np.int32, 2 * len(ids[-1])).reshape(-1, 2)
            sizes.append(np.diff(np.searchsorted(own[:, 0], ends), prepend=0))
            spans.append(own - np.repeat(ends - np.diff(ends, prepend=0), sizes[-1])[:, None].astype(np.int32))
        cache.update(zip(new, range(len(cache), len(cache) + len(new))))
        self.size, self.ids, self.spans = np.concatenate(sizes), np.concatenate(ids), np.concatenate(spans)
        return np.fromiter(map(cache.__getitem__, keys), np.int64, len(keys))

    def laid_out(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``self.ids`` of every token of the words, tokens of each word, tokens before each word and in all)."""
        keys, codes = self.keyed(words)
        rows = self.known(keys)[codes]
        start, n = np.cumsum(self.size) - self.size, self.size[rows]
        total = np.concatenate([[0], np.cumsum(n)])
        return np.repeat(start[rows] - total[:-1], n) + np.arange(total[-1]), n, total

    def pieces(self, texts: list[str], cuts: list[list[tuple[int, int]]]) -> list[list["Piece"]]:
        """The leaves ``cuts`` of some texts, from the words' ids where the vocabulary allows that."""
        if not self.by_words:
            return [[piece(self, text, lo, hi) for lo, hi in own] for text, own in zip(texts, cuts)]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        heads = np.flatnonzero((data & 0xC0) != 0x80)  # the byte at which each character starts
        base = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        ends = [b + hi for b, own in zip(base, cuts) for _, hi in own]
        words = found(data, np.append(heads, len(data))[[0, *ends]])
        at, n, total = self.laid_out(words)
        ids, spans = self.ids[at], self.spans[at] + np.repeat(np.searchsorted(heads, words.starts), n)[:, None]
        tokens, out, leaf = total[words.first], [], 0
        for b, leaves_ in zip(base, cuts):
            out.append([])
            for lo, hi in leaves_:
                own = slice(tokens[leaf], tokens[leaf + 1])
                out[-1].append(Piece(lo, hi, ids[own], spans[own] - b))
                leaf += 1
        return out

    def coded(self, column: pa.Array) -> Iterator[tuple[np.ndarray, str]]:
        """(ids, decoded text) of every text of a column, in order."""
        if not self.by_words:
            for text in column.to_pylist():
                ids = np.array(self.encode(text or "").ids, "<u4")
                yield ids, self.decode(ids)
            return
        data, offsets = utf8(column)
        for lo, hi in slices(offsets, SLICE_BYTES):
            at = offsets[lo : hi + 1]
            words = found(data[at[0] : at[-1]], at - at[0])
            at, _, total = self.laid_out(words)
            ids = self.ids[at]
            for a, b in zip(words.first[:-1], words.first[1:]):
                own = ids[total[a] : total[b]]
                yield own, self.decode(own)


@functools.cache
def codec_of(path: str) -> Codec:
    """The worker's own codec, which outlives a task."""
    return Codec(path)


# -- tree --------------------------------------------------------------------------------------


def _cut(text: str, lo: int, hi: int) -> int:
    """Where to halve ``text[lo:hi]``: the white space nearest the middle, else a place that normalisation cannot cross."""
    mid, reach = (lo + hi) // 2, (hi - lo) // 4
    for k in range(reach):
        for at in (mid + k, mid - k):
            if text[at] in " \t\n\r\v\f":
                return at
    for k in range(reach):
        for at in (mid + k, mid - k):
            pair = text[at - 1 : at + 1]
            apart = unicodedata.normalize("NFC", pair[0]) + unicodedata.normalize("NFC", pair[1])
            if not unicodedata.combining(pair[1]) and unicodedata.normalize("NFC", pair) == apart and pair.isalnum():
                return at
    return mid


def leaves(text: str, most: int = LEAF_CHARS) -> list[tuple[int, int]]:
    """Character ranges of the leaves of the halving tree, in order."""
    out, stack = [], [(0, len(text))]
    while stack:
        lo, hi = stack.pop()
        if hi - lo <= max(most, 8):
            out.append((lo, hi))
        else:
            at = _cut(text, lo, hi)
            stack += [(at, hi), (lo, at)]
    return out


class Piece:
    """Tokens of ``text[lo:hi]`` with the character range of each."""

    def __init__(self, lo: int, hi: int, ids: np.ndarray, spans: np.ndarray):
        self.lo, self.hi, self.ids, self.spans = lo, hi, ids, spans


def piece(codec: Codec, text: str, lo: int, hi: int) -> Piece:
    e = codec.encode(text[lo:hi])
    spans = np.array(e.offsets, np.int64).reshape(-1, 2) + lo
    return Piece(lo, hi, np.array(e.ids, np.uint32), spans)


def _edges(p: Piece) -> np.ndarray:
    """Tokens that begin where the one before has ended, so that a window may start there."""
    if not len(p.ids):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], p.spans[1:, 0] >= p.spans[:-1, 1]]))


def joined(codec: Codec, text: str, left: Piece, right: Piece) -> Piece:
    """The tokens of two neighbouring pieces as one encoding of the whole."""
    k = FIRST_WINDOW
    while True:
        a = max(len(left.ids) - k, 0)
        b = min(k, len(right.ids))
        ea, eb = _edges(left), _edges(right)
        a = int(ea[np.searchsorted(ea, a, "right") - 1]) if len(ea) else 0
        b = int(eb[np.searchsorted(eb, b)]) if np.searchsorted(eb, b) < len(eb) else len(right.ids)
        lo = int(left.spans[a, 0]) if a else left.lo
        hi = int(right.spans[b, 0]) if b < len(right.ids) else right.hi
        window = piece(codec, text, lo, hi)
        need = FIRST_WINDOW // 2
        whole_left, whole_right = a == 0, b == len(right.ids)
        ok_left = whole_left or (
            len(window.ids) >= need and np.array_equal(window.ids[:need], left.ids[a : a + need])
            and np.array_equal(window.spans[:need], left.spans[a : a + need]))
        ok_right = whole_right or (
            len(window.ids) >= need and np.array_equal(window.ids[-need:], right.ids[b - need : b])
            and np.array_equal(window.spans[-need:], right.spans[b - need : b]))
        if ok_left and ok_right:
            ids = np.concatenate([left.ids[:a], window.ids, right.ids[b:]])
            return Piece(left.lo, right.hi, ids, np.concatenate([left.spans[:a], window.spans, right.spans[b:]]))
        k *= 2


def merged(codec: Codec, text: str, pieces: list[Piece]) -> Piece:
    """Pairwise joins, level by level, up to the root of the tree."""
    while len(pieces) > 1:
        pairs = [joined(codec, text, pieces[i], pieces[i + 1]) for i in range(0, len(pieces) - 1, 2)]
        pieces = pairs + (pieces[-1:] if len(pieces) % 2 else [])
    return pieces[0]


def by_tree(codec: Codec, texts: list[str], leaf_chars: int) -> Iterator[tuple[np.ndarray, str]]:
    """(ids, decoded text) of each text, from its leaves to the root; a few texts at a time."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SLICE_BYTES):
            size += len(texts[hi])
            hi += 1
        some = texts[lo:hi]
        for text, own in zip(some, codec.pieces(some, [leaves(t, leaf_chars) for t in some])):
            ids = merged(codec, text, own).ids.astype("<u4")
            yield ids, codec.decode(ids)
        lo = hi


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in two bytes each where all fit, else in four."""
    small = not len(values) or (values.min() >= -(2**15) and values.max() < 2**15)
    return np.ascontiguousarray(values, "<i2" if small else "<i4").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<i2" if len(data) == 2 * n else "<i4").astype(np.int64)


def packed_piece(p: Piece) -> tuple[bytes, bytes]:
    """Ids, and spans as the gap before and the length of each token: what a leaf sends to its join."""
    before = np.concatenate([[p.lo], p.spans[:-1, 1]])[: len(p.ids)]
    return packed(p.ids.astype(np.int64) - 2**15), packed(np.concatenate([p.spans[:, 0] - before, p.spans[:, 1] - p.spans[:, 0]]))


def unpacked_piece(lo: int, hi: int, n: int, ids: bytes, spans: bytes) -> Piece:
    gap, length = np.split(unpacked(spans, 2 * n), 2)
    end = lo + np.cumsum(gap + length)
    return Piece(lo, hi, (unpacked(ids, n) + 2**15).astype(np.uint32), np.stack([end - length, end], axis=1))


# -- Spark ---------------------------------------------------------------------------------------


def _in_task(path: str, leaf_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            size = 1_000
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                texts = part.column("text")
                long = pc.greater(pc.utf8_length(texts), leaf_chars)
                short, tree = codec.coded(texts.filter(pc.invert(long))), by_tree(codec, texts.filter(long).to_pylist(), leaf_chars)
                out = [next(tree if is_long else short) for is_long in long.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([i.tobytes() for i, _ in out], pa.binary()),
                     pa.array([t for _, t in out], pa.string())], ["doc_id", "ids", "decoded"])
    return run


def _split(leaf_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, text = batch.column("text_key")[i], batch.column("text")[i].as_py()
                cuts = leaves(text, leaf_chars)
                for k, (lo, hi) in enumerate(cuts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()], pa.binary()), pa.array([k], pa.int32()), pa.array([lo], pa.int64()),
                         pa.array([text[lo:hi]], pa.string())], ["text_key", "leaf", "lo", "part"])
    return run


def _encode_leaves(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("part")[i].as_py()
                p = piece(codec, text, 0, len(text))
                ids, spans = packed_piece(p)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, 1) for c in ("text_key", "leaf", "lo", "part")]
                    + [pa.array([len(p.ids)], pa.int64()), pa.array([ids], pa.binary()), pa.array([spans], pa.binary())],
                    ["text_key", "leaf", "lo", "part", "n", "ids", "spans"])
    return run


def _join_leaves(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            for i in range(batch.num_rows):
                parts = sorted(batch.column("leaves")[i].as_py(), key=lambda x: x["leaf"])
                text = "".join(x["part"] for x in parts)
                pieces = [unpacked_piece(x["lo"], x["lo"] + len(x["part"]), x["n"], x["ids"], x["spans"]) for x in parts]
                ids = merged(codec, text, pieces).ids
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text_key").slice(i, 1), pa.array([ids.astype("<u4").tobytes()], pa.binary()),
                     pa.array([codec.decode(ids)], pa.string())], ["text_key", "ids", "decoded"])
    return run


def encode(docs: DataFrame, path: str, leaf_chars: int = LEAF_CHARS, spread_chars: int = SPREAD_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, ids (little-endian unsigned 32-bit), decoded.

    Ids are those of the tokenizers library for the vocabulary file at ``path``, without special tokens added;
    ``decoded`` is the library's decoding, special tokens kept. ``path`` must be readable on the executors.

    Texts of more than ``leaf_chars`` characters take the tree; the leaves of those of more than ``spread_chars`` are rows of
    their own, and each distinct one of these is encoded once. Null and
    empty texts give no ids and an empty text. Repeated rows and null doc_ids get a row each; other columns are
    ignored; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spread = max(leaf_chars, spread_chars)
    short = rows.filter(F.length("text") <= spread).mapInArrow(_in_task(path, leaf_chars), "doc_id bigint, ids binary, decoded string")
    long = rows.filter(F.length("text") > spread).withColumn("text_key", F.unhex(F.sha2("text", 256)))
    parts = long.groupBy("text_key").agg(F.first("text").alias("text")).mapInArrow(
        _split(leaf_chars), "text_key binary, leaf int, lo bigint, part string")
    coded = parts.repartition("text_key", "leaf").mapInArrow(
        _encode_leaves(path), "text_key binary, leaf int, lo bigint, part string, n bigint, ids binary, spans binary")
    whole = coded.groupBy("text_key").agg(
        F.collect_list(F.struct("leaf", "lo", "part", "n", "ids", "spans")).alias("leaves")
    ).mapInArrow(_join_leaves(path), "text_key binary, ids binary, decoded string")
    return short.unionByName(long.select("doc_id", "text_key").join(whole, "text_key").drop("text_key"))


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.expr("cast(length(ids) / 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
