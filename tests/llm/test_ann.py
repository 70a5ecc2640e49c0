import numpy as np
from pyspark.sql import functions as F

from starproof.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, point string, vector string, tree int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "p", "v", 1) for i, v in rows], SCHEMA)


def brute(rows, asked, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([np.asarray(v, np.float32).astype(float) for _, v in rows])
    out = {}
    for i, v in zip(ids, x):
        if i in asked:
            d = np.sqrt(((x - v) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 24))
    rows = [(i, centres[i % 20] + rng.normal(size=24)) for i in range(3000)]
    got = by_query(ann.neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0, leaf_rows=64, sample_rows=1000).collect())
    want = brute(rows, set(range(0, 3000, 50)))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    x = {i: np.asarray(v, np.float32).astype(float) for i, v in rows}
    for q, found in got.items():
        for i, score in found:
            assert np.isclose(score, np.sqrt(((x[q] - x[i]) ** 2).sum()), rtol=1e-12)
        assert found == sorted(found, key=lambda f: (f[1], f[0]))


def test_copies_ties_and_unusable_vectors(spark):
    good = [(i, [1.0, 2.0]) for i in range(0, 40)] + [(50, [1.0, 3.0]), (60, [-1.0, 0.0]), (70, [1.0, 1.0])]
    bad = [(100, None), (110, [0.0, 0.0]), (120, [float("nan"), 1.0]), (130, [float("inf"), 1.0]), (140, [None, 1.0]), (150, []), (160, [1.0, 2.0, 3.0]), (None, [1.0, 2.0])]
    got = by_query(ann.neighbours(frame(spark, good + bad + good[:3]), F.col("vec_id") % 10 == 0, leaf_rows=1).collect())
    assert got == brute(good, {0, 10, 20, 30, 50, 60, 70})


def test_one_id_with_several_vectors(spark):
    rows = [(i, [float(i), 0.0]) for i in range(1, 30)] + [(5, [500.0, 0.0]), (5, [501.0, 0.0])]
    got = by_query(ann.neighbours(frame(spark, rows + [(200, [499.0, 0.0]), (300, [4.5, 0.0]), (300, [700.0, 0.0])]), F.col("vec_id") % 100 == 0, k=4, leaf_rows=1, recall=1.0).collect())
    assert got[200] == [(5, 1.0), (5, 2.0), (300, 201.0), (29, 470.0)]
    assert got[300] == [(4, 0.5), (5, 0.5), (3, 1.5), (6, 1.5)]
    asked = by_query(ann.neighbours(frame(spark, rows), F.col("vec_id") == 5, k=3, leaf_rows=1, recall=1.0).collect())
    assert asked[5] == [(4, 1.0), (6, 1.0), (3, 2.0)]


def test_chunks_and_trees_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5)) for i in range(400)]
    whole = by_query(ann.neighbours(frame(spark, rows), F.col("vec_id") % 7 == 0, recall=1.0, leaf_rows=8).collect())
    monkeypatch.setattr(ann, "CHUNK_ROWS", 3)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 2)
    assert by_query(ann.neighbours(frame(spark, rows), F.col("vec_id") % 7 == 0, recall=1.0, leaf_rows=8).collect()) == whole


def test_few_candidates_and_empty_table(spark):
    assert by_query(ann.neighbours(frame(spark, [(0, [1.0]), (1, [3.0])]), F.lit(True)).collect()) == {0: [(1, 2.0)], 1: [(0, 2.0)]}
    assert ann.neighbours(frame(spark, [(0, [1.0])]), F.lit(True)).count() == 0
    assert ann.neighbours(frame(spark, []), F.lit(True)).count() == 0
    assert ann.neighbours(frame(spark, [(0, None)]), F.lit(True)).count() == 0


def test_queue_visits_every_leaf_once():
    x = np.random.default_rng(1).normal(size=(500, 6))
    forest = ann.fit(x, trees=3, leaf_rows=20)
    seen = forest.visited(x[0], share=float("inf"))
    assert len(seen) == len(set(seen)) == sum(len(t.children) + 1 for t in forest.trees)
    assert {t for t, _ in seen[:3]} == {0, 1, 2}
    assert all(leaf == forest.trees[t].leaves(x[:1])[0] for t, leaf in seen[:3])
