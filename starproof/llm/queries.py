"""One registered query per corpus operator, over its whole table, with its SQL twin where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import starproof
from starproof.llm import ann, bpe, filters, jaccard, mixing, offsets, pii, quality, repair, rlz, scratch, secret_scan, toxicity, warc

ROOT = str(Path(starproof.__file__).resolve().parent.parent)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers of a local session start in its working folder; let them find this package from anywhere.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op1_random_projection_forest")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op2_ngram_jaccard_join", rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
grams AS (SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS gram FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 5 * k >= 4 * (x.n + y.n - k)),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT d.doc_id, least(d.doc_id, coalesce(r.least_v, d.doc_id)) AS class_id, coalesce(l.n, 0) AS n_links
FROM documents d
LEFT JOIN (SELECT u, min(v) AS least_v FROM reach GROUP BY 1) r ON r.u = d.doc_id
LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY 1) l ON l.u = d.doc_id
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query("op3_warc_bundles", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT page_id, strlen(html) AS n, sha256(html) AS digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
    CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to FROM m
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch.folder(spark).rstrip('/')}/llm/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) AS bigint)")
    return warc.read_archives(spark, path, with_payload=False).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )


@query("op4_pii_spans")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


@query("op5_token_attribution")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = offsets.with_lines(table(spark, sf_dir, "documents"))
    found = offsets.attributed(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", F.col("section").cast("int").alias("line"), F.col("start").alias("char_start"),
                        F.col("end").alias("char_end"), F.col("tokens").cast("bigint").alias("n_tokens"), "crossing")


@query("op6_substring_dedup", rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
blocks AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS start, ws FROM w WHERE len(ws) >= 50),
marked AS (SELECT doc_id, start, min(doc_id) OVER (PARTITION BY md5(array_to_string(ws[start:start + 49], ' '))) AS ref FROM blocks),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 50)) AS i FROM marked WHERE ref < doc_id),
lists AS (SELECT doc_id, list(i) AS l FROM gone GROUP BY 1),
kept AS (SELECT w.doc_id, len(ws) AS n, coalesce(len(l), 0) AS removed,
    CASE WHEN l IS NULL THEN ws ELSE [ws[i] FOR i IN range(1, len(ws) + 1) IF NOT list_contains(l, i)] END AS kept
    FROM w LEFT JOIN lists USING (doc_id))
SELECT doc_id, n AS n_words, removed AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM kept
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query("op7_bpe_tree")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@query("op8_source_mix", rf"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size, 
    md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight,
    3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, cap / weight AS ratio,
    (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER earlier, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level FROM w
    WINDOW earlier AS (ORDER BY cap / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN fixed IS NULL THEN cap ELSE least(cap, fixed * weight) END AS target
    FROM l, (SELECT arg_min(level, ratio) AS fixed FROM l WHERE ratio > level)),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
o AS (SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS want,
    sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS UNBOUNDED PRECEDING) - size AS before
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
    size * (whole + CASE WHEN want > 0 AND before + size / 2.0 <= want THEN 1 ELSE 0 END) AS taken FROM o
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query("op9_quality_cascade", rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
grams AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM grams),
repeated AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM counted WHERE c > 1) GROUP BY 1),
texts AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM texts
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
base AS (SELECT w.doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(regexp_replace(text, '[^!?]', '', 'g')) AS shouts,
    len([x FOR x IN ws IF regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')]) AS letter_words,
    coalesce(lines.dup, 0) AS n_dup_lines, coalesce(lines.n, 0) AS n_lines, coalesce(repeated.n, 0) AS n_repeat_words
    FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR n_symbols > n_words OR shouts > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
         OR 2 * letter_words < n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM judged
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).drop("rejected_by")


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query("op11_filter_audit", rf"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS} AS ws,
    doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS late FROM documents),
flags AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
d AS (SELECT part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
    100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(late, false) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM w LEFT JOIN flags USING (doc_id)),
masks AS (SELECT part, {{'A': a, 'B': b, 'C': c, 'D': d, 'E': e}} AS f, a::INT + b::INT + c::INT + d::INT + e::INT AS n_fails,
    count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
ran AS (SELECT m.*, o, step, o[step] AS letter, g.hit,
    len([x FOR x IN string_split(o[1:step - 1], '') IF x <> '' AND hits[x]]) = 0 AS reached
    FROM masks m, steps, LATERAL (SELECT MAP {{'A': f.A, 'B': f.B, 'C': f.C, 'D': f.D, 'E': f.E}} AS hits) h,
    LATERAL (SELECT hits[o[step]] AS hit) g),
counted AS (SELECT part, o AS filter_order, step, letter,
    coalesce(sum(n) FILTER (reached AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (reached AND hit), 0) AS removed,
    coalesce(sum(n) FILTER (NOT reached AND hit), 0) AS redundant, coalesce(sum(n) FILTER (hit AND n_fails = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (reached AND hit), 0) AS good_lost, coalesce(sum(toxic) FILTER (reached AND hit), 0) AS toxic_lost
    FROM ran GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM counted
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _edit(initial: str, cost: str, after: str, line: str = "") -> str:
    """An edit in front of the best edits of state ``after``, as a struct (cost, audit, repaired lines)."""
    lines = f"list_prepend({line}, {after}.r)" if line else f"{after}.r"
    return f"{{'c': {after}.c + {cost}, 'a': '{initial}' || {after}.a, 'r': {lines}}}"


_TAKES = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))  # by grammar state: the role it takes, where that leads
_KEEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})


def _consumed(s: int) -> str:
    role, t = _TAKES[s]
    keep = [f"CASE WHEN NOT must_go AND initial = '{k}' THEN {_edit('K', 'extra', f'f{n}', 'line')} END" for k, n in _KEEPS[s].items()]
    return ", ".join([_edit("D", "2", f"f{s}"), f"CASE WHEN NOT must_go THEN {_edit('R', '1 + extra', f'f{t}', f"""'{role}:' || text""")} END", *keep])


def _inserted(s: int) -> str:
    role, t = _TAKES[s]
    again, u = _TAKES[t]
    twice = f"{{'c': g{u}.c + 10, 'a': 'II' || g{u}.a, 'r': list_concat(['{role}:', '{again}:'], g{u}.r)}}"
    return f"list_min([g{s}, {_edit('I', '5', f'g{t}', f"""'{role}:'""")}, {twice}])"


@query("op12_conversation_repair", rf"""
WITH RECURSIVE keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (SELECT k, xor(list_reduce([CAST(unicode(c) AS BIGINT) FOR c IN string_split(k, '')], lambda h, c:
        list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(h, c)),
    4294967295::BIGINT), 4294967295) % 20 AS kind FROM (SELECT DISTINCT k FROM keyed)),
rows AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM keyed JOIN kinds USING (k) WHERE kind <> 0),
told AS (SELECT *, row_number() OVER () AS id FROM rows),
placed AS (SELECT *, role[1] AS initial, role || ':' || text AS line,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, id) AS i,
    NOT regexp_matches(text, '[^ 	-
]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, id) > 1 AS again,
    NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut FROM told),
faults AS (SELECT *, blank OR again AS must_go, CASE WHEN cut AND NOT blank AND NOT again THEN 5 ELSE 0 END AS extra,
    initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) NOT IN ('su', 'ua', 'au') AS bad FROM placed),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (extra > 0) AS truncated, count(*) FILTER (bad) AS illegal,
    count(*) AS n FROM faults GROUP BY 1),
states AS (
    SELECT conv_id, n + 1 AS i, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS f0, {{'c': 10::BIGINT, 'a': 'II', 'r': ['user:', 'assistant:']}} AS f1,
        {{'c': 5::BIGINT, 'a': 'I', 'r': ['assistant:']}} AS f2, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS f3 FROM stats
    UNION ALL
    SELECT conv_id, i, {", ".join(f"{_inserted(s)} AS f{s}" for s in range(4))} FROM (
        SELECT s.conv_id, d.i, {", ".join(f"list_min([{_consumed(s)}]) AS g{s}" for s in range(4))}
        FROM states s JOIN faults d ON d.conv_id IS NOT DISTINCT FROM s.conv_id AND d.i = s.i - 1))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(f0.c, 0) AS cost, coalesce(f0.a, '') AS audit,
    sha256(coalesce(array_to_string(f0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN (SELECT * FROM states WHERE i = 1) s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(table(spark, sf_dir, "conversations"))


@query("op13_secret_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.find(table(spark, sf_dir, "documents")))
