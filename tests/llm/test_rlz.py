import pytest
from llm_rows import make_docs, words

from starproof.llm import rlz


def brute(rows, window):
    first = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(text)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), doc_id)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[k : k + window])] < doc_id:
                gone[k : k + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,seed", [(50, 20), (8, 3)])
def test_kept_words_equal_brute_force(spark, edge_rows, window, seed):
    got = rlz.substring_dedup(make_docs(spark, edge_rows), window, seed).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == brute(edge_rows, window)


def test_factors_are_copies_of_their_reference_and_cover_what_goes(spark, edge_rows):
    rows = edge_rows + [(2000, "p " + "u " * 80 + "q"), (2001, "p " + "u " * 49 + "q"), (2002, "u " * 70)]
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(words(text))
    for r in rlz.substring_dedup(make_docs(spark, rows)).collect():
        covered, own = set(), [t for t in texts[r.doc_id] if len(t) == r.n_words]
        for f in r.factors:
            assert f.length >= rlz.WINDOW and f.ref_doc < r.doc_id
            assert any(t[f.start : f.start + f.length] == ref[f.ref_start : f.ref_start + f.length] for t in own for ref in texts[f.ref_doc])
            covered |= set(range(f.start, f.start + f.length))
        assert len(covered) == r.n_removed


def test_a_run_over_a_factor_boundary_is_found(spark):
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[-30:] + b[:30])), (4, " ".join(a + b))]
    got = {r.doc_id: r.n_removed for r in rlz.substring_dedup(make_docs(spark, rows)).collect()}
    # Of document 4, the blocks of a and b are in 1 and 2, and those across the joint in 3.
    assert got == {1: 0, 2: 0, 3: 0, 4: 120}


def test_empty_table(spark):
    assert rlz.substring_dedup(make_docs(spark, [])).count() == 0
