"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent frames; a bundle is a run of frames with the seek table of the
seekable format in its footer, and an index that maps each record identifier to its frame and
its offset in the frame's plain bytes. Bundles are rows of a Parquet table (bundle, data, entries), so
they live on any storage that Spark reads, are committed with their task, and are read in parallel.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 8 * 1024 * 1024
LEAST_REVISIT = 100

# The seekable format's fixed values: skippable frame, footer magic, entry and footer sizes.
_SKIPPABLE, _SEEKABLE, _ENTRY, _FOOTER = 0x184D2A5E, 0x8F92EAB1, 8, 9

ENTRY = "struct<record_id: string, frame: int, offset: bigint, length: bigint>"
_ENTRY_TYPE = pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])


def record_id(page_id) -> str:
    return f"urn:page:{'-' if page_id is None else page_id}"


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A response, or a revisit of ``refers_to`` without a body."""
    revisit = refers_to is not None
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "urn:unknown"
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id)}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {target}", "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{record_id(refers_to)}>", f"WARC-Payload-Length: {len(payload)}"]
    body = b"" if revisit else payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} has a wrong length")
    return fields, rest[:n]


class BundleWriter:
    def __init__(self, level: int = 3):
        self._zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.entries: list[dict] = []
        self._open = bytearray()

    def add(self, rid: str, raw: bytes) -> None:
        if self._open and len(self._open) + len(raw) > FRAME_BYTES:
            self._close_frame()
        self.entries.append({"record_id": rid, "frame": len(self.frames), "offset": len(self._open), "length": len(raw)})
        self._open += raw

    def _close_frame(self) -> None:
        packed = self._zstd.compress(bytes(self._open))
        self.sizes.append((len(packed), len(self._open)))
        self.frames.append(packed)
        self._open = bytearray()

    @property
    def size(self) -> int:
        return sum(c for c, _ in self.sizes) + len(self._open)

    def finish(self) -> bytes:
        if self._open:
            self._close_frame()
        table = b"".join(struct.pack("<II", c, d) for c, d in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, _SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", _SKIPPABLE, len(table) + len(footer)) + table + footer


class BundleReader:
    """Frames by number, found through the footer; only the frames asked for are decompressed."""

    def __init__(self, data: bytes):
        n, _, magic = struct.unpack("<IBI", data[-_FOOTER:])
        if magic != _SEEKABLE:
            raise ValueError("no seek table")
        table = data[len(data) - _FOOTER - n * _ENTRY : len(data) - _FOOTER]
        self._data, self._starts, at = memoryview(data), [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self._starts.append((at, packed, plain))
            at += packed
        self._zstd = zstandard.ZstdDecompressor()
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            at, packed, plain = self._starts[k]
            self._last = k, self._zstd.decompress(self._data[at : at + packed], max_output_size=plain)
        return self._last[1]

    def record(self, entry: dict) -> tuple[dict[str, str], bytes]:
        return parsed(self.frame(entry["frame"])[entry["offset"] : entry["offset"] + entry["length"]])


def _writer(date: str):
    schema = pa.schema([("bundle", pa.string()), ("data", pa.binary()), ("entries", pa.list_(_ENTRY_TYPE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, out = TaskContext.get().partitionId(), 0, BundleWriter()

        def done():
            return pa.RecordBatch.from_pylist([{"bundle": f"{part:06d}-{made:06d}", "data": out.finish(), "entries": out.entries}], schema)

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, digest, ref = (batch.column(c)[i].as_py() for c in ("page_id", "url", "html", "digest", "ref"))
                out.add(record_id(page), record(page, url, html.encode(), digest, ref, date))
                if out.size >= BUNDLE_BYTES:
                    yield done()
                    made, out = made + 1, BundleWriter()
        if out.entries:
            yield done()
    return run


def classified(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, ref): ref is the page_id of the response that a revisit refers to, else null."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    large = F.octet_length("html") >= LEAST_REVISIT
    first = rows.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    # Payloads that cannot match get keys of their own, so that they are not dealt to one task.
    key = F.when(large, F.col("digest")).otherwise(F.concat(F.lit("-"), F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")))))
    both = rows.withColumn("key", key).join(first.select(F.col("digest").alias("key"), "first"), "key", "left")
    ref = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return both.select("page_id", "url", "html", "digest", ref.alias("ref"))


def write_archives(pages: DataFrame, path: str, date: datetime = datetime(2000, 1, 1, tzinfo=UTC)) -> None:
    """Writes one WARC record per row of ``pages`` (page_id, url, html) as bundles at ``path``.

    Of rows with equal payloads of at least ``LEAST_REVISIT`` bytes, those with the smallest page_id become responses
    and the others revisits of it; a group of null page_ids alone has responses only. Null html is an empty
    payload, a null url the target ``urn:unknown``. Repeated rows get a record each. Other columns are not archived.
    """
    stamp = date.strftime("%Y-%m-%dT%H:%M:%SZ")
    classified(pages).mapInArrow(_writer(stamp), f"bundle string, data binary, entries array<{ENTRY}>").write.parquet(path)


def bundles(spark, path: str) -> DataFrame:
    return spark.read.schema(f"bundle string, data binary, entries array<{ENTRY}>").parquet(path)


RECORDS = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes bigint, payload_digest string, payload binary"


def _described(fields: dict[str, str], body: bytes) -> dict:
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {
        "record_id": fields["WARC-Record-ID"].strip("<>"), "record_type": fields["WARC-Type"], "target_uri": fields["WARC-Target-URI"],
        "refers_to": fields["WARC-Refers-To"].strip("<>") if revisit else None, "payload_digest": digest,
        "payload_bytes": int(fields["WARC-Payload-Length"]) if revisit else len(body), "payload": None if revisit else body,
    }


def _reader(with_payload: bool):
    kinds = [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bundle = BundleReader(batch.column("data")[i].as_py())
                out, held = [], 0
                for entry in batch.column("entries")[i].as_py():
                    row = _described(*bundle.record(entry))
                    if not with_payload:
                        row["payload"] = None
                    out.append(row)
                    held += len(row["payload"] or b"")
                    if held > BUNDLE_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
                yield pa.RecordBatch.from_pylist(out, schema)
    return run


def read_archives(spark, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the bundles at ``path``; each response is checked against its digest."""
    return bundles(spark, path).select("data", "entries").mapInArrow(_reader(with_payload), RECORDS)


def fetch(spark, path: str, ids: DataFrame) -> DataFrame:
    """The records named in ``ids`` (record_id): the index is searched first, then only their frames are read."""
    where = bundles(spark, path).select("bundle", F.explode("entries").alias("e")).select("bundle", "e")
    where = where.join(ids.select(F.col("record_id").alias("_id")).distinct(), F.col("e.record_id") == F.col("_id"), "left_semi")
    wanted = where.groupBy("bundle").agg(F.array_sort(F.collect_list("e")).alias("entries"))
    held = bundles(spark, path).select("bundle", "data")
    return held.join(wanted, "bundle").select("data", "entries").mapInArrow(_reader(True), RECORDS)
