"""Words of whole texts, found and hashed on the UTF-8 buffer of an Arrow column.

A word is a run of bytes other than the six ASCII white-space bytes, which never occur inside
a multi-byte character. All work is vectorised over slices of a few documents, so memory is
bounded by ``SLICE_BYTES`` or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEED = np.uint64(0x243F6A8885A308D3)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def followed(h: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Hashes of sequences made of two parts. The left part is mixed before the right one meets it: no polynomial in
    the parts, whose sequences of some texts (such as those of Thue and Morse) collide whatever its base is."""
    return mixed(mixed(h + _STEP) ^ by)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges ``data[start:end]``: eight bytes at a time, for all ranges together."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))  # the eight bytes from any place on
    length = ends - starts
    h = mixed(_SEED + length.astype(np.uint64))
    left = np.flatnonzero(length > 0)
    at = starts[left]
    rest = length[left]
    while len(left):
        piece = eight[at]
        short = np.minimum(rest, 8).astype(np.uint64)
        piece &= ~np.uint64(0) >> (np.uint64(64) - short * np.uint64(8))
        h[left] = followed(h[left], piece)
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    return h


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width`` consecutive elements of ``h``, put together from windows of powers of two."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, size = None, 0, h, 1
    while True:
        if width & size:
            part = power[done : done + n]
            out = part if out is None else followed(out, part)
            done += size
        size *= 2
        if size > width:
            return mixed(out ^ np.uint64(width))
        power = followed(power[: len(power) - size // 2], power[size // 2 :])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; nulls count as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts of the slice
    offsets: np.ndarray  # byte offsets of the texts
    starts: np.ndarray  # byte offsets of the words
    ends: np.ndarray
    first: np.ndarray  # word offsets of the texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return range_hashes(self.data, self.starts, self.ends)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def found(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of the texts that ``offsets`` cut out of ``data``; none crosses a text's edge."""
    inside = ~_IS_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def in_slices(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words) for slices of a string column."""
    data, offsets = utf8(column)
    for lo, hi in slices(offsets):
        at = offsets[lo : hi + 1]
        yield lo, hi, found(data[at[0] : at[-1]], at - at[0])


def distinct_chunks(words: Words) -> tuple[list[str], np.ndarray]:
    """``chunks_of`` with the distinct chunks as strings."""
    chunks, codes = chunks_of(words)
    return chunks.to_pylist(), codes


def chunks_of(words: Words) -> tuple[pa.Array, np.ndarray]:
    """Each word with the white space that follows it: the distinct ones, and the code of every word.

    The chunks of a text, laid end to end, are the text without its leading white space.
    """
    if not len(words.starts):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    # A chunk ends where the next word starts, or where its text ends.
    edges = np.concatenate([words.starts, [len(words.data)]])
    lead = words.offsets[1:][words.counts > 0]  # ends of texts that have words
    nxt = edges[1:].copy()
    last = words.first[1:][words.counts > 0] - 1
    nxt[last] = lead
    if np.array_equal(nxt[:-1], words.starts[1:]):
        base, pick = edges[:-1], slice(None)
        bounds = np.append(base, nxt[-1])
    else:  # white space before the first word of a text is cut into chunks of its own, and skipped
        bounds = np.unique(np.concatenate([words.starts, nxt]))
        pick = np.searchsorted(bounds, words.starts)
    chunks = pa.Array.from_buffers(
        pa.large_string(), len(bounds) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(words.data))],
    )
    coded = chunks.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary, codes[pick]


def long_array(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def ragged(values: pa.Array, first: np.ndarray) -> pa.Array:
    """A list column from flat values and the offsets of its rows."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), values)
