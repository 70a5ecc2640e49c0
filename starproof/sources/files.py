"""File-level access: listing, fingerprints, readiness.

Listing goes through Hadoop's FileSystem, so every URI scheme the session knows
works here, and only metadata reaches the driver, with control files and the header lines
of exports. All other contents are only ever read by tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starproof import specs

HASH_BLOCK = 1 << 20


def _path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(uri)


def filesystem(spark: SparkSession, uri: str):
    return _path(spark, uri).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    return filesystem(spark, uri).exists(_path(spark, uri))


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> list[str]:
    """Sorted URIs of the entries of ``directory`` whose name matches ``pattern``."""
    found = filesystem(spark, directory).globStatus(_path(spark, f"{directory.rstrip('/')}/{pattern}"))
    return sorted(str(s.getPath().toString()) for s in found or [])


def stamps(spark: SparkSession, directory: str, pattern: str = "*") -> dict[str, tuple[int, int]]:
    """(bytes, last change in ms) of every entry that matches; a landed folder counts with all of its parts. Metadata only."""
    fs = filesystem(spark, directory)

    def size_and_time(status) -> tuple[int, int]:
        if not status.isDirectory():
            return status.getLen(), status.getModificationTime()
        inner = [size_and_time(s) for s in fs.listStatus(status.getPath())]
        return sum(n for n, _ in inner), max([status.getModificationTime(), *[t for _, t in inner]])

    found = fs.globStatus(_path(spark, f"{directory.rstrip('/')}/{pattern}"))
    return {str(s.getPath().toString()): size_and_time(s) for s in found or []}


def delete(spark: SparkSession, uri: str) -> None:
    filesystem(spark, uri).delete(_path(spark, uri), True)


def write_once(spark: SparkSession, uri: str, text: str) -> bool:
    """A small control file, unless one of this name exists: then False, and it stays as it is."""
    fs, path = filesystem(spark, uri), _path(spark, uri)
    if fs.exists(path):
        return False
    try:
        out = fs.create(path, False)
    except Exception:  # noqa: BLE001 - another writer was faster, or the storage failed
        if fs.exists(path):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def is_directory(spark: SparkSession, uri: str) -> bool:
    return filesystem(spark, uri).getFileStatus(_path(spark, uri)).isDirectory()


def opened(spark: SparkSession, uri: str):
    """The bytes of a file as a Java stream, to be closed by the caller."""
    return filesystem(spark, uri).open(_path(spark, uri))


def small_text(spark: SparkSession, uri: str) -> str:
    """A small control file whose name may start with ``_``, which scans skip as hidden."""
    stream = opened(spark, uri)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs = filesystem(spark, source)
    if not fs.exists(_path(spark, source)):
        raise FileNotFoundError(f"nothing to publish: {source} does not exist")
    if fs.exists(_path(spark, target)):
        raise FileExistsError(f"already published: {target}")
    parent = _path(spark, target).getParent()
    fs.mkdirs(parent)
    if not fs.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not rename {source} to {target}")


def _listing(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.format("binaryFile").load(directory)


def file_inventory(spark: SparkSession, directory: str) -> DataFrame:
    """One row per file: name and length. File contents are not read."""
    return _listing(spark, directory).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "path"
    )


def source_status(spark: SparkSession, directory: str) -> DataFrame:
    """Number of sales files, whether the manifest is there, and both together; a missing folder is not ready."""
    if not exists(spark, directory):
        return spark.range(1).select(
            F.lit(0).cast("bigint").alias("sales_files"), F.lit(False).alias("manifest_present"), F.lit(False).alias("ready"))
    manifest = exists(spark, f"{directory.rstrip('/')}/{specs.MANIFEST_NAME}")
    sales = len(list_files(spark, directory, specs.SALES.file_glob))
    return spark.range(1).select(
        F.lit(sales).cast("bigint").alias("sales_files"), F.lit(manifest).alias("manifest_present"),
        F.lit(sales > 0 and manifest).alias("ready"))


def fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    """SHA-256 of every file, streamed in blocks by one task per file, whatever its size or name.

    Scans skip names starting with ``_`` or ``.``: those control files are listed apart. Tasks open files
    through Arrow's filesystems, so the directory must be on one that they know (local, hdfs, s3, gs, abfs).
    """
    seen = file_inventory(spark, directory).select("path")
    hidden = [
        (p,) for p in list_files(spark, directory) if p.rsplit("/", 1)[-1][0] in "_." and not is_directory(spark, p)
    ]
    if hidden:
        seen = seen.unionByName(spark.createDataFrame(hidden, "path string"))
    return seen.mapInArrow(_hash_in_blocks, "path string, file_name string, sha256 string").select("file_name", "sha256")


def entry_fingerprints(spark: SparkSession, entries: list[str]) -> dict[str, str]:
    """One digest per landed entry: of a file's bytes, or of the sorted digests of a folder's parts. Tasks read, one file each."""
    if not entries:
        return {}
    parts = [(e, p) for e in entries for p in (list_files(spark, e) if is_directory(spark, e) else [e])
             if p == e or p.rsplit("/", 1)[-1][0] not in "_."]
    paths = spark.createDataFrame(parts, "entry string, path string")
    hashed = paths.repartition(min(len(parts), 10_000), "path").select("path").mapInArrow(
        _hash_in_blocks, "path string, file_name string, sha256 string").join(paths, "path")
    whole = F.when(F.count(F.lit(1)) == 1, F.first("sha256")).otherwise(
        F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("sha256"))), 256))
    return dict(hashed.groupBy("entry").agg(whole.alias("sha256")).collect())


def _hash_in_blocks(batches) -> Iterator:
    import pyarrow as pa
    from pyarrow import fs

    for batch in batches:
        rows = []
        for uri in batch.column("path").to_pylist():
            if uri.startswith("file:"):
                system, path = fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
            else:
                system, path = fs.FileSystem.from_uri(quote(uri, safe=":/@"))
            digest = hashlib.sha256()
            with system.open_input_stream(path, compression=None) as stream:
                while block := stream.read(HASH_BLOCK):
                    digest.update(block)
            rows.append({"path": uri, "file_name": uri.rsplit("/", 1)[-1], "sha256": digest.hexdigest()})
        schema = pa.schema([("path", pa.string()), ("file_name", pa.string()), ("sha256", pa.string())])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)
