"""Sales ingestion that reads only what has changed since the last run.

A ledger holds, for every landed export, its size, time of change and fingerprint, and where its partial lies: the
export's lines, still text, one per key with the number of its copies. An export with the size and time of the ledger is
not opened. Others are fingerprinted by tasks; only those whose bytes differ are read. Partials merge:
the first line in file order wins over all of them and copies add up, so the lines and counters are those of a full
run. The ledger is the current version of a pointer, so a run that dies leaves the last state as it was.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starproof import specs
from starproof.operators import cleaning
from starproof.plans.ingest import counted_sales
from starproof.sources import files, pointer, readers

ENTRY = "_entry"
LEDGER = "path string, bytes bigint, changed bigint, sha256 string, part string"
_POSITION = ("_block", "_row")


@dataclass(frozen=True)
class Update:
    """``lines`` and ``report`` as of a full run; ``read`` and ``gone`` are the exports that this run read or found missing."""

    version: int
    lines: DataFrame
    report: DataFrame
    read: tuple[str, ...]
    gone: tuple[str, ...]
    kept: tuple[str, ...]


def _ledger(spark: SparkSession, state: str) -> tuple[int, dict[str, dict]]:
    version, content = pointer.current(spark, state)
    if content is None:
        return version, {}
    rows = spark.read.schema(LEDGER).parquet(f"{state}/{pointer.SETS}/{content['set']}/ledger").collect()
    return version, {r.path: r.asDict() for r in rows}  # one short row per landed export, as a listing has


def _partials(spark: SparkSession, paths: list[str], target: str) -> None:
    """One line per key and export, in one job; an export's bytes decide how many files its partial has."""
    raw = readers.scan_files(spark, paths, specs.SALES)
    # A landing may be a folder of parts: its entry is what was listed. Paths come encoded, entries are matched as they are.
    decoded = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))
    names = sorted({p.rsplit("/", 1)[-1] for p in paths}, key=len, reverse=True)
    parts = F.transform(F.split(decoded, "/"), lambda x: F.when(x.isin(*names), x))
    raw = raw.withColumn(ENTRY, F.element_at(F.array_compact(parts), -1))
    own = [f.name for f in specs.SALES.fields if f.name in raw.columns]
    first = cleaning.keep_first(raw.select(*own, ENTRY, "_file", *_POSITION), [*cleaning.SALES_KEY, ENTRY], ["_file", *_POSITION], copies="_copies")
    first.hint("rebalance", ENTRY).write.partitionBy(ENTRY).parquet(target)


def update(spark: SparkSession, raw_dir: str, state_dir: str) -> Update:
    """Brings the state in ``state_dir`` up to the exports in ``raw_dir`` and returns the audited lines.

    No export is an error. Raises ``pointer.Conflict`` if another run has moved the state on meanwhile.
    """
    state = state_dir.rstrip("/")
    version, known = _ledger(spark, state)
    landed = files.stamps(spark, raw_dir, specs.SALES.file_glob)
    if not landed:
        raise FileNotFoundError(f"no file matches {specs.SALES.file_glob} in {raw_dir}")
    suspects = [p for p, stamp in landed.items() if p not in known or (known[p]["bytes"], known[p]["changed"]) != stamp]
    digests = files.entry_fingerprints(spark, suspects)
    read = sorted(p for p in suspects if p not in known or known[p]["sha256"] != digests.get(p))
    gone = sorted(set(known) - set(landed))
    name = uuid.uuid4().hex
    target = f"{state}/{pointer.SETS}/{name}"
    if read:
        _partials(spark, read, f"{target}/lines")
    rows = []
    for p, (size, changed) in sorted(landed.items()):
        part = f"{name}/lines" if p in read else known[p]["part"]
        rows.append((p, size, changed, digests.get(p) or known[p]["sha256"], part))
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.parquet(f"{target}/ledger")
    parts = sorted({r[4] for r in rows})
    new = pointer.advance(spark, state, version, {"set": name, "uses": sorted({p.split("/")[0] for p in parts} | {name})})
    lines, report = counted_sales(_merged(spark, state, rows), len(rows))
    return Update(new, lines, report, tuple(read), tuple(gone), tuple(p for p in sorted(landed) if p not in read))


def _merged(spark: SparkSession, state: str, rows: list[tuple]) -> DataFrame:
    """The lines of all exports from their partials. Each read names its exports, so a replaced partial is pruned by its folder."""
    by_part: dict[str, list[str]] = {}
    for path, *_, part in rows:
        by_part.setdefault(part, []).append(path.rsplit("/", 1)[-1])
    frames = [spark.read.parquet(f"{state}/{pointer.SETS}/{part}").filter(F.col(ENTRY).isin(*names)) for part, names in sorted(by_part.items())]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)
    order = ["_file", *_POSITION]
    first = cleaning.keep_first(union.drop(ENTRY), list(cleaning.SALES_KEY), order, copies="_all", weight="_copies", rare=True)  # a line lands in one export
    return cleaning.typed_sales(first.withColumnRenamed("_all", "_copies"))


def sweep(spark: SparkSession, state_dir: str, older_than: float = 86_400.0) -> list[str]:
    """Deletes sets that the current state doesn't use: replaced partials and what dead runs have left."""
    state = state_dir.rstrip("/")
    _, content = pointer.current(spark, state)
    return pointer.leftovers(spark, state, older_than, keep=set(content["uses"]) if content else set())
