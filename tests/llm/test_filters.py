import random
from itertools import permutations

import pytest
from llm_rows import make_docs, words

from starproof.llm import filters

LABELS = "doc_id bigint, quality int, toxic int"


def brute(rows, labels):
    """rows: (doc_id, text, source)."""
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    docs = []
    for d, t, s in rows:
        t = t or ""
        w = words(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": d is not None and d > least[t]}
        mine = [x for x in labels if x[0] == d and d is not None]
        docs.append((s or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = set()
    for part in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == part]
        removals = {}
        for order in permutations("ABCDE"):
            left = here
            for f in order:
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                removals[order, f] = gone, len(left)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                gone, kept = removals[order, f]
                failing = [d for d in here if d[1][f]]
                only = sum(1 for d in failing if sum(d[1].values()) == 1)
                shapley = sum(len(removals[o, f][0]) for o in permutations("ABCDE"))
                out.add((part, "".join(order), step, kept, len(gone), len(failing) - len(gone), only,
                         sum(d[2] for d in gone), sum(d[3] for d in gone), shapley))
    return out


def sample(edge_rows):
    rng = random.Random(4)
    rows = [(d, t, rng.choice(["a", "b", "b", "b", "", None])) for d, t in edge_rows]
    for i in range(2000, 2120):
        text = " ".join(rng.choice(["one", "Two", "THREE", "a|b", f"w{rng.random()}", "é"]) for _ in range(rng.choice([10, 49, 50, 80])))
        rows += [(i, text, "c"), (i + rng.choice([0, 500]), text, rng.choice("abc"))]
    ids = [r[0] for r in rows]
    return rows, [(rng.choice(ids), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(200)] + [(None, 1, 1), (9, 1, 0), (9, 0, 1)]


def test_audit_equals_brute_force(spark, edge_rows):
    rows, labels = sample(edge_rows)
    got = filters.audit(make_docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    want = brute(rows, labels)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_adjacent_swaps_pass_through_every_order_once():
    for n in range(1, 7):
        now, seen = list(range(n)), {tuple(range(n))}
        swaps = list(filters.adjacent_swaps(n))
        for k in swaps:
            now[k], now[k + 1] = now[k + 1], now[k]
            seen.add(tuple(now))
        assert len(seen) == len(swaps) + 1 == len(list(permutations(range(n))))


def test_a_swapped_diagram_is_the_diagram_of_its_order():
    rng = random.Random(8)
    for _ in range(20):
        weights = {m: (rng.randrange(4), rng.randrange(2), 0) for m in range(32) if rng.random() < 0.6}
        diagram = filters.Diagram("ABCDE", weights)
        for _ in range(30):
            diagram.swap(rng.randrange(4))
            order = diagram.order
            moved = {sum(1 << order.index("ABCDE"[b]) for b in range(5) if m >> b & 1): w for m, w in weights.items()}
            fresh = filters.Diagram("".join(order), moved)
            assert list(fresh.all_pass()) == list(diagram.all_pass())
            assert [len(level) for level in fresh.levels] == [len(level) for level in diagram.levels]


def test_equal_parts_of_a_diagram_are_shared():
    assert [len(level) for level in filters.Diagram("ABCDE", {}).levels] == [1] * 5
    assert [len(level) for level in filters.Diagram("ABCDE", {m: (1, 0, 0) for m in range(32) if m & 1}).levels] == [1, 2, 2, 2, 2]


@pytest.mark.parametrize("rows, n", [([], 0), ([(1, None, None)], 600), ([(1, "x", "a"), (1, "x", "a"), (None, "x", None)], 1200)])
def test_small_tables(spark, rows, n):
    got = filters.audit(make_docs(spark, rows), spark.createDataFrame([], LABELS)).collect()
    assert len(got) == n and {tuple(r) for r in got} == brute(rows, [])
