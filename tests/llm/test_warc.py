import hashlib
import random

import pytest
import zstandard

from starproof.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string, first string, bundle string"


def pages():
    rng = random.Random(2)
    big = "é" * 60
    rows = [(1, "http://a", None), (2, "http://b", ""), (3, None, "x" * 99), (4, "http://c", "x" * 99), (9, "u\r\nX: 1", big), (5, "u", big),
            (7, "u", big), (5, "u", big), (None, "u", big), (None, "v", "n" * 200), (None, "w", "n" * 200), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    rows += [(100 + i, f"http://{i}", "".join(rng.choice("<abc>\n ") for _ in range(rng.randint(0, 4000)))) for i in range(200)]
    rows += [(400 + i, f"http://{i}", "copy" * 100) for i in range(50)] + [(500, "http://long", "long text " * 60_000)]
    return rows


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "bundles")
    rows = [(*r, "d", "f", "b") for r in pages()]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    return path


def test_round_trip(spark, archive):
    first = {}
    for page, _, html in pages():
        if html and len(html.encode()) >= 100 and page is not None:
            first[html] = min(first.get(html, page), page)
    want = []
    for page, _, html in pages():
        data = (html or "").encode()
        ref = first.get(html) if html in first and page != first[html] else None
        want.append((warc.record_id(page), len(data), hashlib.sha256(data).hexdigest(), "revisit" if ref is not None else "response",
                     warc.record_id(ref) if ref is not None else None, None if ref is not None else data))
    got = [(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload)) if r.payload else
           (r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.record_type == "revisit" else b"")
           for r in warc.read_archives(spark, archive).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_records_are_fetched_by_identifier(spark, archive):
    ids = spark.createDataFrame([("urn:page:500",), ("urn:page:8",), ("urn:page:77777",)], "record_id string")
    got = {r.record_id: bytes(r.payload) for r in warc.fetch(spark, archive, ids).collect()}
    assert got == {"urn:page:500": b"long text " * 60_000, "urn:page:8": b"\r\n\r\nWARC/1.1\r\n" * 20}


def test_frames_are_independent_and_the_bundle_is_plain_zstd():
    w = warc.BundleWriter()
    records = {f"r{i}": bytes([i % 251]) * (i * 1000) for i in range(1, 120)}
    for rid, raw in records.items():
        w.add(rid, raw)
    data = w.finish()
    reader = warc.BundleReader(data)
    assert len(w.frames) > 3
    for e in reversed(w.entries):
        assert reader.frame(e["frame"])[e["offset"] : e["offset"] + e["length"]] == records[e["record_id"]]
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == b"".join(records.values())
    with pytest.raises(ValueError, match="seek table"):
        warc.BundleReader(data[:-1] + b"\0")


def test_damage_is_seen():
    fields, body = warc.parsed(warc.record(1, "u", b"abc", hashlib.sha256(b"abd").hexdigest(), None, "d"))
    with pytest.raises(ValueError, match="damaged"):
        warc._described(fields, body)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0
