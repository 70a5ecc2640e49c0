import math
import random
import re
import zlib

import numpy as np
from llm_rows import make_docs

from starproof.llm import toxicity as t


def labelled(n=900, seed=3):
    """Neutral prose; a third of it with words of one coined stem, always in fresh forms."""
    rng = random.Random(seed)
    neutral = ["".join(rng.choice("aeiourstln") for _ in range(6)) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(neutral) for _ in range(40)]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(40)] = "zorgl" + "".join(rng.choice("abcd") for _ in range(4))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_on_unseen_forms(spark):
    rows, labels = labelled()
    got = t.toxicity(make_docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len(held) > 100 and np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_held_out_labels_are_never_used(spark):
    rows, labels = labelled(300)
    docs = make_docs(spark, rows)
    turned = [(i, 1 - x if zlib.crc32(str(i).encode()) % 5 == 0 else x) for i, x in labels]
    a, b = (sorted((r.doc_id, r.score) for r in t.toxicity(docs, spark.createDataFrame(x, "doc_id bigint, toxic int")).collect()) for x in (labels, turned))
    assert a == b


def verdicts(*classes):
    nxt, says = t.grammar()
    q, out = 0, []
    for c in classes:
        if says[q, c] >= 0:
            out.append(int(says[q, c]))
        q = nxt[q, c]
    return out


def test_composed_grammar():
    assert verdicts(t.OTHER, t.INSULT) == [t.PLAIN]
    assert verdicts(t.TARGET, t.OTHER, t.INSULT) == [t.AIMED]
    assert verdicts(t.TARGET, t.NEGATION, t.OTHER, t.INSULT) == [t.NEGATED]
    assert verdicts(t.NEGATION, *[t.OTHER] * 4, t.INSULT) == [t.PLAIN]
    assert verdicts(t.REPORT, t.TARGET, t.INSULT) == [t.REPORTED]
    assert verdicts(t.THREAT, t.OTHER) == []
    assert verdicts(t.THREAT, t.OTHER, t.TARGET) == [t.THREATENING]
    assert verdicts(t.TARGET, t.THREAT) == [t.THREATENING]


def test_composition_equals_running_one_after_the_other():
    a, b = t.negation_machine(), t.report_machine()
    both = t.compose(a, b)
    rng = random.Random(1)
    for _ in range(200):
        s = [(rng.randrange(t.OTHER + 1), frozenset()) for _ in range(12)]
        assert list(both.run(s)) == list(b.run(a.run(s)))


def test_edges_without_labels(spark, edge_rows):
    docs = make_docs(spark, edge_rows + [(500, "you are an idiot, a moron and worthless scum"), (501, "long clause " * 9000 + "idiot")])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = t.toxicity(docs, none).collect()
    assert len(got) == len(edge_rows) + 2
    assert {r.doc_id: r.predicted for r in got}[500] == 1
    assert all(r.predicted == 0 for r in got if r.doc_id in (1, 2, 3, None))
    kept = t.not_toxic(docs, none)
    assert kept.columns == docs.columns and kept.filter("doc_id = 500").count() == 0
    nulls = spark.createDataFrame([(None, 1), (7, None)], "doc_id bigint, toxic int")
    assert t.toxicity(make_docs(spark, []), nulls).count() == 0


def plain_sums(text, model):
    """The matches of one text by the rules of the grammar, word after word, without any automaton."""
    sums = [0.0] * t.N_SUMS
    chunks = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", (text or "").lstrip(" \t\n\v\f\r"))
    aimed = pending = report = False
    reach = 0
    for chunk in chunks:
        kind, weight, ends = model.lexical(chunk)
        out, at_target = kind, aimed and kind in (t.INSULT, t.THREAT)
        aimed |= kind == t.TARGET
        if kind == t.THREAT:
            pending, out = (False, kind) if at_target else (True, t.OTHER)
        elif kind == t.TARGET and pending:
            pending, out, at_target = False, t.THREAT, True
        counts = out in (t.INSULT, t.THREAT)
        negated, reported = counts and reach > 0, counts and report
        reach = 3 if out == t.NEGATION else max(reach - 1, 0)
        report |= out == t.REPORT
        if counts:
            what = t.NEGATED if negated else t.REPORTED if reported else t.THREATENING if out == t.THREAT else t.AIMED if at_target else t.PLAIN
            sums[what] += weight if kind == t.INSULT else 1.0
        if ends:
            aimed = pending = report = False
            reach = 0
    return sums


def test_scores_equal_a_plain_scorer(spark, edge_rows):
    rng = random.Random(12)
    parts = [*t.INSULTS[:4], *t.THREATS[:2], *t.TARGETS[:3], *t.NEGATIONS[:2], *t.REPORTS[:2], "word", "stemmy", "Idiot!", "you.", "x\n", "é,", '"kill"', "a?", "...", "\t"]
    rows = edge_rows + [(9000 + i, " ".join(rng.choice(parts) for _ in range(rng.choice([1, 5, 30, 200])))) for i in range(200)]
    model = t.Model(stems={"stem": 0.7})
    got = {(r.doc_id, r.text): (list(r._sums), r._score) for r in t.scored(make_docs(spark, rows).select("doc_id", "text"), model).collect()}
    for doc_id, text in rows:
        sums, score = got[doc_id, text]
        assert np.allclose(sums, plain_sums(text, model))
        z = model.weights[0] + sum(w * math.log1p(s) for w, s in zip(model.weights[1:], plain_sums(text, model)))
        assert math.isclose(score, 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_repeated_ids_and_shared_beginnings(spark):
    """Rows of one doc_id are one labelled text; documents that share a passage stay different; scores repeat."""
    rows, labels = labelled(300)
    shared = "one line that all of the documents begin with "
    rows = [(i, shared + x) for i, x in rows] + [(1, f"other text {k}") for k in range(50)]
    frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    runs = [sorted((str(r.doc_id), r.score) for r in t.toxicity(make_docs(spark, x), frame).collect()) for x in (rows, rows[::-1])]
    assert runs[0] == runs[1]
    found = {r.doc_id: r.predicted for r in t.toxicity(make_docs(spark, rows), frame).collect()}
    assert np.mean([found[i] == x for i, x in labels]) >= 0.97
