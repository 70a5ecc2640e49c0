import random

from llm_rows import make_docs, words

from starproof.llm import quality


def brute(text):
    text = text or ""
    w = words(text)
    seen = {}
    for k in range(len(w) - 2):
        seen.setdefault(tuple(w[k : k + 3]), []).append(k)
    repeated = {k + j for at in seen.values() if len(at) > 1 for k in at for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    counts = (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated))
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return counts, failed


def test_counts_equal_brute_force(spark, edge_rows):
    rows = edge_rows + [(900, "a ### b\n|a|\n\n |a|\n|a|\n" * 9), (901, "one two three one two three " * 20)]
    got = quality.quality(make_docs(spark, rows)).collect()
    want = sorted(((d, *brute(t)[0], brute(t)[1]) for d, t in rows), key=str)
    assert sorted(((r.doc_id, *[r[c] for c in quality.COUNTS], r.base_failed) for r in got), key=str) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_order_of_rules_never_changes_a_verdict(spark, edge_rows):
    docs = make_docs(spark, edge_rows)
    rules = list(quality.RULES)
    want = sorted((str(r.doc_id), r.kept, r.n_words) for r in quality.quality(docs, rules).collect())
    random.Random(2).shuffle(rules)
    assert sorted((str(r.doc_id), r.kept, r.n_words) for r in quality.quality(docs, rules).collect()) == want


def test_rules_are_ordered_by_rejection_per_cost(spark, edge_rows):
    order = quality.ordered_rules(make_docs(spark, edge_rows))
    assert sorted(r.name for r in order) == sorted(r.name for r in quality.RULES)
    assert order[0].name in ("short", "repetitive", "repeated_lines", "letters")


def test_junk_goes_and_prose_stays(spark):
    prose = " ".join(f"word{i} is new{i} and it{i}." for i in range(40))
    rows = [(1, prose), (2, " ".join(f"w{i}$$$" for i in range(80))), (3, " ".join(f"W{i}!!" for i in range(80))), (4, "1 2 3 4 5 6 7 " * 20)]
    assert {r.doc_id: r.kept for r in quality.quality(make_docs(spark, rows)).collect()} == {1: True, 2: False, 3: False, 4: False}


def test_empty_table(spark):
    assert quality.quality(make_docs(spark, [])).count() == 0
