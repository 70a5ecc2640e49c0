"""Secrets in texts by patterns and by the entropy of candidate strings, in built-in column expressions only.

Three patterns name secrets outright. Beyond them, every long run of key-like characters is a candidate: a window of
``WINDOW`` characters slides over it, the counts of its characters are brought up to date by the one that enters and
the one that leaves, and with them the Shannon entropy of the window. A candidate is a secret if some window reaches the
entropy of its character class and mixes the kinds of characters that the class asks for, unless the
allow-list knows it: identifiers, placeholders, alphabets in order. Work is linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starproof.llm.pii import listed, running

WINDOW = 20
#: Entropies are sums of c * log2(c) over the counts c of a window, in millionths of a bit, so that they are exact.
UNIT = 1_000_000
TERMS = tuple(round(c * log2(c) * UNIT) if c else 0 for c in range(WINDOW + 1))

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_VALUE = "[A-Za-z0-9+/_.=-]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]


_ASSIGN = rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?({_VALUE}++)"""

#: Kinds whose spans are always reported, in the order in which spans of one start are listed.
BASE = (
    Kind("assign", _ASSIGN, lambda m: F.length(F.regexp_extract(m, _ASSIGN, 1)) >= 6),
    Kind("access", "AKIA[A-Z0-9]++", lambda m: F.length(m) >= 20),
    Kind("hex", "(?<![0-9a-f])[0-9a-f]{24,}+", lambda m: F.lit(True)),
)
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}+"


@dataclass(frozen=True)
class CharacterClass:
    """A candidate belongs to the first class whose characters it keeps to."""

    name: str
    pattern: str
    entropy: float  # bits that a window must reach
    digits: int  # least numbers of digits, capitals and small letters in that window
    capitals: int
    small: int

    @property
    def most(self) -> int:
        """The sum of terms that a window of this entropy has."""
        return round(WINDOW * (log2(WINDOW) - self.entropy) * UNIT)


CLASSES = (
    CharacterClass("upper_hex", r"\A[0-9A-F]+\z", 3.0, 4, 3, 0),
    CharacterClass("lower_key", r"\A[0-9a-z]+\z", 3.4, 4, 0, 4),
    CharacterClass("mixed_key", r"\A[A-Za-z0-9+/_=-]+\z", 3.7, 2, 2, 2),
)
#: What looks like a secret and is none: a candidate that one of these is found in, in either case.
ALLOWED = (
    r"\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z",  # identifiers
    "example|sample|dummy|placeholder|changeme|redacted|your[_-]", "x{6}|0{8}",  # placeholders
    "abcdefgh|12345678|qwerty",  # alphabets in order
    r"\Asha(?:1|256|384|512)-",  # digests of public files
)

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,entropy:double>>"


def _spans(matches: Column, pieces: Column, span: Callable[[Column, Column], Column]) -> Column:
    """``span(start, match)`` of every match, in code points; ``pieces`` is what lies between the matches."""
    both = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches,
                      lambda p, m: F.struct(F.length(p).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("n"), m.alias("match")))
    ends = running(F.transform(both, lambda x: x["gap"] + x["n"]))
    return F.zip_with(both, ends, lambda x, before: span(before + x["gap"], x["match"]))


def _base(df: DataFrame, kind: Kind, rank: int) -> DataFrame:
    def span(start: Column, match: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(match)).alias("end"),
                        F.lit(kind.name).alias("kind"), kind.valid(match).alias("ok"))

    df = df.withColumn("_m", F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0)))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split("text", kind.pattern, -1)))
    good = F.filter(_spans(F.col("_m"), F.col("_p"), span), lambda x: x["ok"])
    good = F.transform(good, lambda x: F.struct(x["start"], x["rank"], x["end"], x["kind"], F.lit(None).cast("double").alias("entropy")))
    return df.withColumn(kind.name, F.when(F.size("_m") > 0, good).otherwise(F.array()).cast(SPAN)).drop("_m", "_p")


def _class_of(match: Column) -> Column:
    chosen = F.lit(None)
    for c in reversed(CLASSES):
        own = F.struct(F.lit(c.name).alias("name"), F.lit(c.most).cast("bigint").alias("most"), F.lit(c.digits).alias("digits"),
                       F.lit(c.capitals).alias("capitals"), F.lit(c.small).alias("small"))
        chosen = F.when(match.rlike(c.pattern), own).otherwise(chosen)
    return chosen


def least_terms(codes: Column, kind: Column) -> Column:
    """The least sum of terms over all windows that mix characters as ``kind`` asks; null where none does.

    ``codes`` are places in ``ALPHABET``. Each step adds the character that enters and takes off the one that leaves.
    """
    terms = F.array(*[F.lit(t).cast("bigint") for t in TERMS])
    leaving = F.concat(F.array_repeat(F.lit(-1), WINDOW), F.slice(codes, F.lit(1), F.size(codes) - WINDOW))
    steps = F.zip_with(codes, leaving, lambda c, o: F.struct(c.alias("new"), o.alias("old")))
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0).cast("bigint").alias("terms"), F.lit(0).alias("digits"),
        F.lit(0).alias("capitals"), F.lit(0).alias("small"), F.lit(0).alias("seen"), F.lit(None).cast("bigint").alias("least"))

    def between(c: Column, lo: str, hi: str) -> Column:
        return c.between(ALPHABET.index(lo), ALPHABET.index(hi)).cast("int")

    def step(acc: Column, x: Column) -> Column:
        new, old = x["new"], x["old"]
        counts = F.transform(acc["counts"], lambda n, i: n + (i == new).cast("int") - (i == old).cast("int"))
        entered = F.get(terms, F.get(acc["counts"], new) + 1) - F.get(terms, F.get(acc["counts"], new))
        left = F.get(terms, F.get(acc["counts"], old) - 1) - F.get(terms, F.get(acc["counts"], old))
        total = acc["terms"] + F.when(new == old, F.lit(0)).otherwise(entered + F.when(old >= 0, left).otherwise(0))
        kinds = {k: acc[k] + between(new, *ends) - between(old, *ends) for k, ends in
                 (("digits", "09"), ("capitals", "AZ"), ("small", "az"))}
        fits = (acc["seen"] + 1 >= WINDOW) & (kinds["digits"] >= kind["digits"]) & (kinds["capitals"] >= kind["capitals"]) & (
            kinds["small"] >= kind["small"])
        return F.struct(
            counts.alias("counts"), total.cast("bigint").alias("terms"), *[v.cast("int").alias(k) for k, v in kinds.items()],
            (acc["seen"] + 1).cast("int").alias("seen"), F.least(acc["least"], F.when(fits, total)).cast("bigint").alias("least"))

    return F.aggregate(steps, start, step, lambda acc: acc["least"])


def _added(df: DataFrame) -> DataFrame:
    """Adds ``added``: the candidates that entropy confirms and no allow-list entry suppresses, apart from base spans."""
    df = df.withColumn("_m", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split("text", CANDIDATE, -1)))

    def candidate(start: Column, match: Column) -> Column:
        mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]") & ~F.lower(match).rlike("|".join(f"(?:{a})" for a in ALLOWED))
        return F.struct(start.alias("start"), (start + F.length(match)).alias("end"), F.when(mixed, match).alias("match"),
                        F.when(mixed, _class_of(match)).alias("kind"))

    found = F.filter(_spans(F.col("_m"), F.col("_p"), candidate), lambda x: x["match"].isNotNull())
    apart = F.filter(found, lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    df = df.withColumn("_c", F.when(F.size("_m") > 0, apart))
    coded = F.transform("_c", lambda x: F.struct(
        x["start"], x["end"], x["kind"], F.transform(F.split(x["match"], ""), lambda c: (F.position(c, F.lit(ALPHABET)) - 1).cast("int")).alias("codes")))
    df = df.withColumn("_k", coded)
    weighed = F.transform("_k", lambda x: F.struct(x["start"], x["end"], x["kind"], least_terms(x["codes"], x["kind"]).alias("least")))
    df = df.withColumn("_w", weighed)
    sure = F.filter("_w", lambda x: x["least"] <= x["kind"]["most"])
    spans = F.transform(sure, lambda x: F.struct(
        x["start"], F.lit(len(BASE)).alias("rank"), x["end"], x["kind"]["name"].alias("kind"),
        (F.lit(log2(WINDOW)) - x["least"] / float(UNIT * WINDOW)).alias("entropy")))
    return df.withColumn("added", F.when(F.size("_c") > 0, spans).otherwise(F.array()).cast(SPAN)).drop("_m", "_p", "_c", "_k", "_w")


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, base, added; the spans by start, then kind.

    A span is (start, rank, end, kind, entropy), in code points, end exclusive. ``base`` holds the leftmost, non-overlapping
    matches of each base kind that are long enough; ``added`` the candidates of a class of ``CLASSES`` that overlap no base span.
    Null and empty texts have none. Repeated rows and null doc_ids get a row each; other columns are ignored; an empty
    table gives an empty result.
    """
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for rank, kind in enumerate(BASE):
        df = _base(df, kind, rank)
    df = df.select("doc_id", "text", F.array_sort(F.concat(*[k.name for k in BASE])).alias("base"))
    return _added(df).select("doc_id", "base", "added")


def digests(found: DataFrame) -> DataFrame:
    def count(name: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == name)).cast("bigint").alias(f"n_{name}")

    return found.select(
        "doc_id", *[count(k.name) for k in BASE], F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"))
