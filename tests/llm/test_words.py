import numpy as np
import pyarrow as pa
from llm_rows import words

from starproof.llm.words import distinct_chunks, in_slices, range_hashes, slices, window_hashes


def texts():
    return [None, "", " ", "a", " a  bb\tccc\n", "été 日本 x", "end", "\n\nstart", "a", "bb a"]


def test_words_of_every_text_are_found_and_equal_words_hash_alike():
    seen = {}
    for lo, _, found in in_slices(pa.array(texts())):
        h = found.hashes()
        raw = found.data.tobytes()
        for i, (a, b) in enumerate(zip(found.first[:-1], found.first[1:])):
            got = [raw[s:e].decode() for s, e in zip(found.starts[a:b], found.ends[a:b])]
            assert got == words(texts()[lo + i])
            for w, x in zip(got, h[a:b]):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_sliced_columns_and_slices_cover_all_rows():
    column = pa.array(["skip", *texts(), "skip"]).slice(1, len(texts()))
    assert sum(len(w.counts) for _, _, w in in_slices(column)) == len(texts())
    assert list(slices(np.array([0, 5, 5, 30, 31]), 6)) == [(0, 2), (2, 3), (3, 4)]
    assert list(slices(np.array([0]))) == []


def test_chunks_rebuild_the_texts_without_leading_white_space():
    for lo, _, found in in_slices(pa.array(texts())):
        chunks, codes = distinct_chunks(found)
        for i, (a, b) in enumerate(zip(found.first[:-1], found.first[1:])):
            assert "".join(chunks[c] for c in codes[a:b]) == (texts()[lo + i] or "").lstrip(" \t\n") * bool(b > a)


def test_equal_ranges_and_only_they_hash_alike():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    starts = rng.integers(0, 4900, 4000)
    ends = starts + rng.integers(0, 100, 4000)
    raw, seen = data.tobytes(), {}
    for a, b, h in zip(starts, ends, range_hashes(data, starts, ends)):
        assert seen.setdefault(raw[a:b], h) == h
    assert len(set(seen.values())) == len(seen)


def test_equal_windows_and_only_they_hash_alike():
    for base in ([0, 1], [5, 9, 13]):
        h = np.random.default_rng(2).choice(np.array(base, np.uint64), 600)
        tm = np.array([bin(i).count("1") % 2 for i in range(256)], np.uint64)
        h = np.concatenate([h, tm, 1 - tm])
        for width in (1, 2, 3, 5, 20, 32, 50, 64, 127):
            seen = {}
            for k, x in enumerate(window_hashes(h, width)):
                assert seen.setdefault(tuple(h[k : k + width]), x) == x
            assert len(set(seen.values())) == len(seen)
    assert len(window_hashes(h[:3], 4)) == 0
