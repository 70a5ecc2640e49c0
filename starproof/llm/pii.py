"""Personal data by patterns, checksums and context, in built-in column expressions only.

A regular expression proposes spans of a kind, a validator confirms them, and words within
``CONTEXT_CHARS`` characters before or behind a span adjust its score. Patterns are written so that matching takes linear time: possessive repeats, and
a look-behind where a match can only start at the head of a run. Texts are cut by a pattern into
what lies between the matches, so offsets are running sums of lengths, counted in code points.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCEPT = 0.7
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
ROUNDS = 3
_BLOCK = 256


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _n_digits(match: Column, least: int, most: int) -> Column:
    return F.length(_digits(match)).between(least, most)


def luhn(match: Column) -> Column:
    """The checksum of card numbers: every second digit from the right is doubled, the sum ends in 0."""
    backwards = F.reverse(_digits(match))
    place = F.sequence(F.lit(1), F.length(backwards))

    def worth(i: Column) -> Column:
        d = F.substr(backwards, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(place, F.lit(0), lambda acc, i: acc + worth(i)) % 10 == 0


def mod97(match: Column) -> Column:
    """The checksum of bank account numbers: head moved to the end, letters as 10 to 35, remainder 1."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(c >= 65, (acc * 100 + c - 55) % 97).otherwise((acc * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    may: Callable[[Column], Column]  # a cheap test that every text with a match passes
    score: float
    context: str  # words, as an alternation, that make a match likelier
    tag: str


_LOCAL = "[A-Za-z0-9._%+-]"
_DIGIT_DOT = r"[0-9]++\."
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_CARD_WORDS = "card|visa|mastercard|credit|karte|carte|tarjeta"
_PHONE_WORDS = "phone|tel|call|mobile|fax|telefon|téléphone|teléfono"

#: Kinds whose confirmed spans are always reported, in the order in which spans of one start are listed.
BASE = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True),
         lambda t: t.contains("@"), 0.9, "mail|contact|write|kontakt|correo", "[EMAIL]"),
    Kind("ip", rf"(?<![0-9]){_DIGIT_DOT}{_DIGIT_DOT}{_DIGIT_DOT}[0-9]++", lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
         lambda t: t.contains("."), 0.8, "ip|host|server|address|adresse", "[IP]"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda m: _n_digits(m, 14, 19) & luhn(m),
         lambda t: F.lit(True), 0.8, _CARD_WORDS, "[CARD]"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: _n_digits(m, 10, 15),
         lambda t: t.contains("+"), 0.8, _PHONE_WORDS, "[PHONE]"),
)
#: Kinds that need their checksum or their context to reach ``ACCEPT``; they never displace a base span.
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", mod97,
         lambda t: F.lit(True), 0.8, "iban|account|konto|compte|cuenta", "[IBAN]"),
    Kind("short_card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12}(?![0-9])", luhn, lambda t: F.lit(True), 0.5, _CARD_WORDS, "[CARD]"),
    Kind("local_phone", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", lambda m: F.lit(True),
         lambda t: F.lit(True), 0.4, _PHONE_WORDS, "[PHONE]"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: F.lit(True), lambda t: t.contains("-"),
         0.4, "ssn|social security", "[SSN]"),
)


def _matches(kind: Kind, text: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(kind.may(text), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(none)


def running(lengths: Column, add: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    """Sums of all earlier elements, or what ``add`` makes of them from 0; in blocks, so that long arrays are not copied once per element."""
    def sums(a: Column) -> Column:
        return F.aggregate(a, F.array(F.lit(0).cast("bigint")), lambda acc, v: F.concat(acc, F.array(add(F.element_at(acc, -1), v))))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
        lambda b: sums(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))
    before = F.slice(sums(F.transform(blocks, lambda x: F.element_at(x, -1))), F.lit(1), F.size(blocks))
    return F.flatten(F.zip_with(blocks, before, lambda x, o: F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda v: add(v, o))))


def _around(pieces: Column, matches: Column, i: Column) -> tuple[Column, Column]:
    """The ``CONTEXT_CHARS`` characters of the text before and behind match ``i``, across other matches.

    A match has two characters at least, so that many pieces suffice and no text is walked once per match.
    """
    n, most = F.lit(CONTEXT_CHARS), CONTEXT_CHARS // 2
    first, count = F.greatest(i - most, F.lit(0)) + 1, F.least(i, F.lit(most))
    earlier = F.zip_with(F.slice(pieces, first, count), F.slice(matches, first, count),
                         lambda p, m: F.concat(F.right(p, n), F.right(m, n)))
    later = F.zip_with(F.slice(matches, i + 2, F.lit(most)), F.slice(pieces, i + 3, F.lit(most)),
                       lambda m, p: F.concat(F.left(m, n), F.left(p, n)))
    before, after = pieces[i], pieces[i + 1]
    return (F.right(F.when(F.length(before) >= n, before).otherwise(F.concat(F.array_join(earlier, ""), before)), n),
            F.left(F.when(F.length(after) >= n, after).otherwise(F.concat(after, F.array_join(later, ""))), n))


def _score(kind: Kind, before: Column, after: Column) -> Column:
    words = rf"(?<![a-zà-ÿ])(?:{kind.context})"
    near = F.lower(before).rlike(words) | F.lower(after).rlike(words)
    return F.lit(kind.score) + F.when(near, CONTEXT_BONUS).otherwise(0.0)


SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>"


def _spans(df: DataFrame, kind: Kind, rank: int, context: bool = True) -> DataFrame:
    """Adds the confirmed spans of one kind as column ``kind.name``; without ``context`` under the kind's plain score."""
    m, p, s = f"_m_{kind.name}", f"_p_{kind.name}", f"_s_{kind.name}"
    df = df.withColumn(m, _matches(kind, F.col("text")))
    df = df.withColumn(p, F.when(F.size(m) > 0, F.split("text", kind.pattern, -1)))
    both = F.zip_with(F.slice(p, F.lit(1), F.size(m)), F.col(m), lambda a, b: (F.length(a) + F.length(b)).cast("bigint"))
    df = df.withColumn(s, F.when(F.size(m) > 0, running(both)))

    def span(i: Column) -> Column:
        match, before = F.col(m)[i], F.col(p)[i]
        start = F.col(s)[i] + F.length(before)
        likely = _score(kind, *_around(F.col(p), F.col(m), i)) if context else F.lit(kind.score)
        score = F.when(kind.valid(match), likely).otherwise(0.0)
        return F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(match)).alias("end"),
            F.lit(kind.name).alias("kind"), score.alias("score"))

    found = F.filter(F.transform(F.sequence(F.lit(0), F.size(m) - 1), span), lambda x: x["score"] >= ACCEPT)
    return df.withColumn(kind.name, F.when(F.size(m) > 0, found).otherwise(F.array()).cast(SPAN)).drop(m, p, s)


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, base, added; the spans by start, then kind.

    A span is (start, rank, end, kind, score), in code points, end exclusive. ``base`` holds the leftmost,
    non-overlapping matches of each base kind that its validator confirms; ``added`` those of the other kinds
    that reach ``ACCEPT`` by checksum or context and overlap no base span. Null and empty texts have none. Repeated
    rows and null doc_ids get a row each; other columns are ignored; an empty table gives an empty result.
    """
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for rank, kind in enumerate((*BASE, *ADDED)):
        df = _spans(df, kind, rank)
    df = df.select("doc_id", F.array_sort(F.concat(*[k.name for k in BASE])).alias("base"),
                   F.array_sort(F.concat(*[k.name for k in ADDED])).alias("added"))
    apart = F.filter("added", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return df.withColumn("added", F.when(F.size("added") > 0, apart).otherwise(F.col("added")))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    def count(name: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == name)).cast("bigint").alias(f"n_{name}")

    return found.select(
        "doc_id", *[count(k.name) for k in BASE], F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def _cut_out(df: DataFrame, kinds: tuple[Kind, ...] = (*BASE, *ADDED)) -> DataFrame:
    """Every confirmed span of ``text`` replaced, overlapping ones as their union under the tag of the first; adds ``_cut``.

    Spans are found on the text as it is, also the added ones that overlap a base span, and it is cut once. What is kept is put
    together from blocks of ``_BLOCK`` code points, so that no text is walked once per span.
    """
    for rank, kind in enumerate(kinds):
        df = _spans(df, kind, rank, context=kind.score < ACCEPT)
    df = df.withColumn("_all", F.array_sort(F.concat(*[k.name for k in kinds]))).drop(*[k.name for k in kinds])
    some = F.size("_all") > 0
    df = df.withColumn("_reach", F.when(some, running(F.transform("_all", lambda x: x["end"]), F.greatest)))
    df = df.withColumn("_b", F.when(some, F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{_BLOCK}}}+"), F.lit(0))))

    def kept(lo: Column, hi: Column) -> Column:
        a, z = F.floor(lo / _BLOCK).cast("int"), F.floor((hi - 1) / _BLOCK).cast("int")
        piece = F.substr(F.array_join(F.slice("_b", a + 1, z - a + 1), ""), (lo - a * _BLOCK + 1).cast("int"), (hi - lo).cast("int"))
        return F.when(hi > lo, piece).otherwise("")

    # A span that starts where all earlier ones have ended opens a union; what lies between is kept.
    heads = F.filter(F.zip_with("_all", "_reach", lambda x, r: F.struct(r.alias("lo"), x["start"].alias("hi"), x["rank"].alias("rank"))),
                     lambda c: c["hi"] >= c["lo"])
    tags = F.array(*[F.lit(k.tag) for k in kinds])
    parts = F.transform(heads, lambda c: F.concat(kept(c["lo"], c["hi"]), F.element_at(tags, c["rank"] + 1)))
    last = F.array_max(F.transform("_all", lambda x: x["end"]))
    whole = F.concat(F.array_join(parts, ""), kept(last, F.length("text").cast("bigint")))
    return df.withColumn("text", F.when(some, whole).otherwise(F.col("text"))).withColumn("_cut", some).drop("_all", "_reach", "_b")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every confirmed span replaced by the tag of its kind; all columns kept.

    Changed texts are looked through again, up to ``ROUNDS`` times in all: a number that was too long together with a
    masked one may be confirmed alone. Only kinds that need no context are, since tags are context words themselves. ``n_chars``, where there is one, is brought in line with changed texts. Null
    texts stay null.
    """
    names = docs.columns
    df = _cut_out(docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("text", F.col(f"c{names.index('text')}")))
    sure = tuple(k for k in (*BASE, *ADDED) if k.score >= ACCEPT)
    for _ in range(ROUNDS - 1):
        df = _cut_out(df.withColumn("_whole", F.col("text")).withColumn("text", F.when(F.col("_cut"), F.col("text"))), sure)
        df = df.withColumn("text", F.coalesce("text", "_whole")).drop("_whole")
    new = {"text": F.col("text")}
    if "n_chars" in names:
        old, at = F.col(f"c{names.index('text')}"), F.col(f"c{names.index('n_chars')}")
        new["n_chars"] = F.when(F.col("text") != old, F.length("text")).otherwise(at).cast(docs.schema["n_chars"].dataType)
    return df.select(*[new.get(n, F.col(f"c{i}")).alias(n) for i, n in enumerate(names)])
