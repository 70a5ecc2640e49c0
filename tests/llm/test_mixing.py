import pytest
from llm_rows import make_docs, words

from starproof.llm import mixing


def filled(sizes, most=3, weights=(1, 2, 3)):
    """Rounds of sharing: clamp what is above its cap, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = float(most * sizes[s])
            free.discard(s)
        left -= sum(target[s] for s in over)
    return target


def sample():
    rows = []
    for s, n in (("a", 40), ("b", 400), ("", 10), (None, 60), ("ä", 200), ("Z", 5), ("empty", 2)):
        for i in range(n):
            rows.append((len(rows), "" if s == "empty" else "w " * (1 + (i * 37) % 90), s))
    return rows + [(None, "one two", "a"), (3, None, "b"), (7, "w w w", "a"), (7, "w w w", "a")]


def test_targets_and_taken_words(spark):
    rows = sample()
    got = mixing.mixture(make_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    size, longest = {}, {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(words(t))
        longest[s] = max(longest.get(s, 0), len(words(t)))
    want = filled(size)
    by_size = {}
    for s, n in size.items():
        by_size.setdefault(n, []).append(s)
    taken = {}
    for r in got:
        (s,) = by_size[r.source_size]
        assert r.target == pytest.approx(want[s]) and r.target <= 3 * r.source_size
        assert 0 <= r.taken <= 3 * r.size
        assert r.size == 0 or r.taken % r.size == 0
        taken[s] = taken.get(s, 0) + r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6
    again = mixing.mixture(make_docs(spark, rows[::-1])).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_rows_are_repeated_as_often_as_taken(spark):
    rows = sample()
    docs = make_docs(spark, rows)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    words_out = sum(len(words(r.text)) for r in out.collect())
    assert words_out == sum(r.taken for r in mixing.mixture(docs).collect())


def test_repeated_rows_are_taken_one_by_one(spark):
    """Ten equal rows whose target is a fraction of them, many under one id, and null ids with different texts."""
    for repeats, doc_id in ((10, 4), (400, 4), (400, None)):
        rows = [(doc_id, "w " * 10, "a")] * repeats + [(100 + i, "x y z " * (i % 5), "b") for i in range(repeats)]
        rows += [(None, f"u{i} " * 7, "c") for i in range(repeats)]
        docs = make_docs(spark, rows).repartition(7)
        got = mixing.mixture(docs).collect()
        want = filled({s: sum(len(words(t)) for _, t, x in rows if x == s) for s in "abc"})
        for s, size, most in (("a", 10, repeats * 10), ("c", 7, repeats * 7)):
            mine = [r for r in got if r.source_size == most and r.size == size]
            assert len(mine) == repeats and abs(sum(r.taken for r in mine) - want[s]) <= size / 2 + 1e-6
        assert sum(len(words(r.text)) for r in mixing.mixed(docs).collect()) == sum(r.taken for r in got)
        again = mixing.mixture(docs.repartition(3)).collect()
        assert sorted(map(str, again)) == sorted(map(str, got))


def test_one_source_empty_texts_and_empty_table(spark):
    assert [r.taken for r in mixing.mixture(make_docs(spark, [(1, "a b c")])).collect()] == [3]
    assert [(r.target, r.taken) for r in mixing.mixture(make_docs(spark, [(1, None), (2, " ")])).collect()] == [(0.0, 0)] * 2
    assert mixing.mixture(make_docs(spark, [])).count() == 0
    assert mixing.mixed(make_docs(spark, [])).count() == 0
