import json
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from llm_rows import make_docs

from starproof.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", "the", "Z", "é", "é", "ß", "'", "'s", "'ll", "1", "23", "!!", "#", "…", " ", " ", "\n", "<|endoftext|>", "<|",
         "日本", "한", "하", "İ", "Σ", "🙂", "‍", "_", ".", " "]

PARTS += [*map(chr, range(32)), "\x85"]


def random_text(rng, n):
    parts = rng.sample(PARTS, rng.choice([2, 4, 8, len(PARTS)]))
    return "".join(rng.choice(parts) for _ in range(n))


def test_tree_equals_the_library():
    codec, rng = bpe.Codec(PATH), random.Random(4)
    for _ in range(600):
        text = random_text(rng, rng.choice([5, 30, 120, 400]))
        cuts = bpe.leaves(text, rng.choice([8, 16, 40]))
        assert "".join(text[a:b] for a, b in cuts) == text
        got = bpe.merged(codec, text, [bpe.piece(codec, text, a, b) for a, b in cuts]).ids.tolist()
        assert got == codec.encode(text).ids
        by_words = bpe.merged(codec, text, codec.pieces([text], [cuts])[0]).ids
        assert by_words.tolist() == got
        assert codec.decode(by_words) == codec.tokenizer.decode(got, skip_special_tokens=False)


def test_packed_pieces_come_back():
    codec, rng = bpe.Codec(PATH), random.Random(6)
    for text in ["", " ", "日本語" * 30, "x" * 70_000 + " y", *[random_text(rng, 50) for _ in range(50)]]:
        p = bpe.piece(codec, text, 0, len(text))
        q = bpe.unpacked_piece(0, len(text), len(p.ids), *bpe.packed_piece(p))
        assert q.ids.tolist() == p.ids.tolist() and q.spans.tolist() == p.spans.tolist()


def test_columns_equal_the_library():
    codec, rng = bpe.Codec(PATH), random.Random(5)
    texts = [random_text(rng, rng.choice([0, 5, 60])) for _ in range(300)] + [None, "", " ", "\n a"]
    got = [(ids.tolist(), text) for ids, text in codec.coded(pa.array(texts))]
    want = [codec.encode(t or "").ids for t in texts]
    assert got == [(ids, codec.tokenizer.decode(ids, skip_special_tokens=False)) for ids in want]


def without(tmp_path, drop):
    """The vocabulary with one of its normaliser's steps left out, or with an added token that holds white space."""
    d = json.loads(open(PATH).read())
    if drop == "added":
        d["added_tokens"][0]["content"] = "a a"
    else:
        d["normalizer"]["normalizers"] = [s for s in d["normalizer"]["normalizers"] if s["type"] != drop]
    path = tmp_path / f"{drop}.json"
    path.write_text(json.dumps(d))
    return str(path)


@pytest.mark.parametrize("drop, by_words", [("Lowercase", True), ("NFC", True), ("Replace", True), ("added", False), ("bytes", False)])
def test_other_vocabularies_equal_the_library(tmp_path, drop, by_words):
    codec, rng = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json") if drop == "bytes" else without(tmp_path, drop)), random.Random(8)
    assert codec.by_words == by_words and bpe.Codec(PATH).by_words
    texts = [random_text(rng, rng.choice([0, 5, 60])) for _ in range(200)] + ["Hello World NASA", "hello  world\nnasa", None, "", "A a<|endoftext|>A", "<|ENDOFTEXT|> <|EndOfText|>"]
    got = [(ids.tolist(), text) for ids, text in codec.coded(pa.array(texts))]
    want = [codec.encode(t or "").ids for t in texts]
    assert got == [(ids, codec.tokenizer.decode(ids, skip_special_tokens=False)) for ids in want]


def test_control_characters_at_the_edges_of_words():
    codec = bpe.Codec(PATH)
    texts = [t for c in [*map(chr, range(32)), "\x7f", "\x85", "\xa0", "\u2028"] for t in (c, f"{c}abc", f"abc{c}", f"Abc{c} abc", f"a {c}\n{c}b", c * 3)]
    got = [(ids.tolist(), text) for ids, text in codec.coded(pa.array(texts))]
    want = [codec.encode(t).ids for t in texts]
    assert got == [(ids, codec.tokenizer.decode(ids, skip_special_tokens=False)) for ids in want]


@pytest.mark.parametrize("leaf, spread", [(64, 64), (64, 200), (64, 10**9), (bpe.LEAF_CHARS, bpe.SPREAD_CHARS)])
def test_documents(spark, edge_rows, leaf, spread):
    rows = [r for r in edge_rows if len(r[1] or "") < 60_000]
    got = bpe.encode(make_docs(spark, rows), PATH, leaf, spread).collect()
    codec = bpe.Codec(PATH)
    want = []
    for doc_id, text in rows:
        ids = np.array(codec.encode(text or "").ids, "<u4")
        want.append((str(doc_id), ids.tobytes(), codec.decode(ids)))
    assert sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in got) == sorted(want)


def test_empty_table(spark):
    assert bpe.digests(bpe.encode(make_docs(spark, []), PATH)).count() == 0
