import numpy as np
import pytest
from llm_rows import make_docs, words

from starproof.llm import jaccard
from starproof.llm.components import components


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def brute(rows, n=5):
    sets = [shingles(t, n) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[top(i)] = top(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((d, least[top(i)], links[i]) for i, (d, _) in enumerate(rows)), key=str), len(ids)


@pytest.mark.parametrize("tile", [512, 4])
def test_classes_and_links_equal_brute_force(spark, edge_rows, tile):
    got = jaccard.near_duplicates(make_docs(spark, edge_rows), tile_members=tile).collect()
    want, _ = brute(edge_rows)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == want


def test_one_document_of_each_group_stays_with_its_columns(spark, edge_rows):
    docs = make_docs(spark, edge_rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    # Texts without n-grams are no copies of each other, but equal rows are one document.
    _, groups = brute(edge_rows)
    assert len(rows) == groups
    assert {r.key for r in rows} == {"k"}


def test_empty_table(spark):
    docs = make_docs(spark, [])
    assert jaccard.near_duplicates(docs).count() == 0
    assert jaccard.keep_one(docs).count() == 0


def test_bands_reach_the_recall():
    bands, rows = jaccard.bands_for(0.8, 0.999999)
    assert bands * rows <= jaccard.MOST_HASHES
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999999


def test_common_counts_by_blocks():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50), dtype=np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]
    assert jaccard.common_counts(sets[:4], sets[4:], columns=7).tolist() == want


def test_components_of_a_long_chain_and_odd_edges(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
