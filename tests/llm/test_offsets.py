import public_tokenizers
import pytest
from llm_rows import make_docs

from starproof.llm import offsets

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def token_spans(text):
    """By decoding prefixes: the characters that the bytes of each token touch."""
    codec, _ = offsets.encoding(PATH, PATTERN)
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    at, out = 0, []
    for token in codec.encode_ordinary(text):
        n = len(codec.decode_single_token_bytes(token))
        out.append((owner[at], owner[at + n - 1] + 1))
        at += n
    return out


def brute(text, start, end, rule):
    end = max(start, end)
    n, crossing = 0.0, 0
    for a, b in token_spans(text):
        inside = max(0, min(b, end) - max(a, start))
        if rule == "first":
            n += start <= a < end
        elif rule == "last":
            n += start <= b - 1 < end
        else:
            n += inside / (b - a)
        crossing += 0 < inside < b - a
    return n, crossing


@pytest.mark.parametrize("rule", offsets.RULES)
def test_counts_equal_brute_force(spark, rule):
    texts = ["Hello wonderful world\nsecond line", "été 日本語 🙂🙂 mixed\n\n\nend", "", None, "x" * 500, "a b c"]
    sections = [("all", 0, 10_000), ("head", 0, 7), ("mid", 3, 12), ("none", 5, 5), ("back", 9, 2), ("tail", 10, 40), (None, 11, 13)]
    rows = [(i, t, sections) for i, t in enumerate(texts)] + [(None, "abc", None), (99, "abc", [None, ("n", None, None)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, sections array<struct<name:string,start:bigint,end:bigint>>")
    got = sorted(((r.doc_id, str(r.section), r.start, r.end, round(r.tokens, 9), r.crossing) for r in
                  offsets.attributed(docs, PATH, PATTERN, rule).collect()))
    want = [(i, str(n), s, e, *brute(t or "", s, e, rule)) for i, t in enumerate(texts) for n, s, e in sections] + [(99, "n", 0, 0, 0.0, 0)]
    assert got == sorted((*w[:4], round(w[4], 9), w[5]) for w in want)


def test_lines_partition_every_document(spark, edge_rows):
    docs = make_docs(spark, edge_rows)
    rows = offsets.attributed(offsets.with_lines(docs), PATH, PATTERN).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    texts = {}
    for doc_id, text in edge_rows:
        texts.setdefault(doc_id, []).append(text or "")
    for doc_id, found in by_doc.items():
        assert len(found) == sum(t.count("\n") + 1 for t in texts[doc_id])
        assert sum(r.tokens for r in found) == sum(len(token_spans(t)) for t in texts[doc_id])
    assert set(by_doc) == set(texts)


def test_unknown_rule_and_empty_table(spark):
    docs = offsets.with_lines(make_docs(spark, []))
    assert offsets.attributed(docs, PATH, PATTERN).count() == 0
    with pytest.raises(ValueError, match="rule"):
        offsets.attributed(docs, PATH, PATTERN, "half")
