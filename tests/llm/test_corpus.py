import hashlib
from collections import Counter

import numpy as np
import oracle
import public_tokenizers
import pytest
import test_jaccard
import test_mixing
import test_toxicity
from llm_rows import words

import __spark_entry__ as entry
import corpus_pipeline
from starproof.llm import bpe, mixing, pii, queries, toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_runs_and_is_whole(spark, name):
    df = queries.QUERIES[name](spark, SF)
    tables = {"op1": ("embeddings", None), "op3": ("pages", 1), "op5": ("documents", None), "op11": ("documents", None), "op12": ("conversations", None)}
    source, rows = tables.get(name.split("_")[0], ("documents", 1))
    got = df.count()
    if rows:
        assert got == spark.read.parquet(f"{SF}/{source}.parquet").count()
    else:
        assert got > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql_twin(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cursor = oracle.connect(SF).execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert oracle.rows(df.columns, [tuple(r) for r in df.collect()]) == oracle.rows(columns, cursor.fetchall())


def test_entry_registers_them():
    assert {f"op{i}" for i in range(1, 14)} <= {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        seen[name] = docs
        if name != "bpe":
            assert docs.columns == before.columns
    ids = lambda n: sorted(r.doc_id for r in seen[n].select("doc_id").collect())
    assert ids("personal_data") == ids("near_duplicates") and set(ids("near_duplicates")) <= set(ids("toxicity"))
    left = pii.digests(pii.find(seen["personal_data"])).selectExpr("sum(n_email + n_ip + n_card + n_phone) AS n").first().n
    assert left == 0
    codec = bpe.Codec(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    mixed = sorted((r.doc_id, len(codec.encode(r.text).ids)) for r in seen["source_mix"].collect())
    assert sorted((r.doc_id, r.n_tokens) for r in seen["bpe"].collect()) == mixed
    total = sum(len(words(r.text)) for r in seen["personal_data"].collect())
    assert abs(sum(len(words(r.text)) for r in seen["source_mix"].collect()) - total) < 0.2 * total


def mixed_by_hand(rows):
    """rows: (doc_id, text, source); each as often as the mix takes it."""
    size = Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    target, out = test_mixing.filled(size), []
    for s in size:
        digest = lambda r: hashlib.md5(f"{mixing.SEED}:{r[0]}:{hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest()
        whole = int(target[s] // size[s]) if size[s] else 0
        want, before = target[s] - whole * size[s], 0
        for row in sorted((r for r in rows if r[2] == s), key=digest):
            n = len(words(row[1]))
            out += [row] * (whole + (want > 0 and before + n / 2 <= want))
            before += n
    return out


def test_pipeline_equals_brute_force(spark):
    """All five stages by plain loops over the rows; only masking itself, which has a test of its own, is the operator's."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.learned(docs, labels)
    rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect()]
    toxic = lambda t: model.weights[0] + np.log1p(test_toxicity.plain_sums(t, model)) @ model.weights[1:] >= 0
    rows = [r for r in rows if not toxic(r[1])]
    classes, _ = test_jaccard.brute([r[:2] for r in rows])
    keep = {least for _, least, _ in classes}
    rows = [r for r in rows if r[0] in keep]
    masked = {r.doc_id: r.text for r in pii.redact(docs.filter(docs.doc_id.isin([r[0] for r in rows]))).collect()}
    codec = bpe.Codec(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    want = Counter()
    for doc_id, text, _ in mixed_by_hand([(d, masked[d] or "", s) for d, _, s in rows]):
        ids = np.array(codec.encode(text).ids, "<u4")
        want[doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest()] += 1
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and len(got) > 50
