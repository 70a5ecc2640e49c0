"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical transducer turns each word into a class (insult, threat, target, negation, report,
other); insults and their stems carry weights learned from labelled documents. Four small
transducers are composed into one machine: target marks insults aimed at someone, threat needs a
target in its clause, negation and reported speech mark what they govern. Running the machine over a
clause adds the weight of each match to one of five sums; a logistic function of the sums is the
document's score. A single word thus counts for what its clause makes of it.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from starproof.llm.scratch import stored
from starproof.llm.words import distinct_chunks, in_slices

#: Bounds of what is learned: labelled documents read, and lexicon entries kept.
MOST_LABELLED = 20_000
MOST_ENTRIES = 2_000
HELD_OUT_FOLDS = 5
#: Entries that a task holds in memory at once; beyond, counts are sent on and caches emptied.
MOST_HELD = 150_000
STEM_LENGTHS = (4, 5, 6)
LEAST_DOCUMENTS = 8
LEAST_LOG_ODDS = 2.5

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)

# General vocabulary, used where no labels speak for or against a word.
INSULTS = ("idiot moron stupid imbecile loser pathetic worthless scum trash disgusting dumb fool filth vermin "
           "dummkopf arschloch abschaum trottel connard crétin ordure imbécile cabrón basura inútil").split()
THREATS = "kill murder destroy hurt stab shoot strangle töten umbringen tuer frapper matar golpear".split()
TARGETS = "you your yours yourself u ur they them du dich dir ihr euch tu toi vous te tú usted ustedes".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't didn't nobody nicht kein keine nie pas jamais nunca".split()
REPORTS = "said says say told quoted called wrote claimed alleged reportedly sagte sagt schrieb dit disait dijo dice".split()

# What the composed machine can say about a match.
PLAIN, AIMED, NEGATED, REPORTED, THREATENING = range(5)
N_SUMS = 5
PRIOR = np.array([-2.5, 3.0, 3.5, 1.0, 1.0, 3.0])  # intercept, then one weight per sum
PRIOR_STRENGTH = 1.0

_EDGE = re.compile(r"^\W+|\W+$")
_CLAUSE_END = re.compile(r"[.!?;:][\"')\]]*\s*$|\n")


# -- transducers -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer with integer states; ``arcs[state, symbol] = (next state, output)``."""

    states: int
    arcs: dict

    def run(self, symbols, state: int = 0):
        for s in symbols:
            state, out = self.arcs[state, s]
            yield out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds each output of ``first`` to ``second``."""
    arcs = {}
    for a, b in product(range(first.states), range(second.states)):
        for (state, symbol), (nxt, out) in first.arcs.items():
            if state == a:
                b2, final = second.arcs[b, out]
                arcs[a * second.states + b, symbol] = (nxt * second.states + b2, final)
    return Transducer(first.states * second.states, arcs)


# Symbols between the machines: (word class, flags), flags a frozenset of sums' names.
_FLAGS = [frozenset(f) for f in ((), ("aimed",), ("negated",), ("reported",), ("aimed", "negated"),
                                 ("aimed", "reported"), ("negated", "reported"), ("aimed", "negated", "reported"))]


def _machine(states: int, step) -> Transducer:
    return Transducer(states, {
        (q, (c, f)): step(q, c, f) for q in range(states) for c in range(OTHER + 1) for f in _FLAGS
    })


def target_machine() -> Transducer:
    """State 1: a target was named in this clause; what follows is aimed."""
    return _machine(2, lambda q, c, f: (
        1 if q or c == TARGET else 0, (c, f | {"aimed"} if q and c in (INSULT, THREAT) else f)))


def threat_machine() -> Transducer:
    """A threat word counts once a target follows it (or precedes it); state 1: one is pending."""
    def step(q, c, f):
        if c == THREAT:
            return (0, (THREAT, f)) if "aimed" in f else (1, (OTHER, f))
        if c == TARGET and q:
            return 0, (THREAT, f | {"aimed"})
        return q, (c, f)
    return _machine(2, step)


def negation_machine(scope: int = 3) -> Transducer:
    """State q: the negation reaches q more words."""
    return _machine(scope + 1, lambda q, c, f: (
        scope if c == NEGATION else max(q - 1, 0), (c, f | {"negated"} if q and c in (INSULT, THREAT) else f)))


def report_machine() -> Transducer:
    """State 1: the rest of the clause is reported speech."""
    return _machine(2, lambda q, c, f: (
        1 if q or c == REPORT else 0, (c, f | {"reported"} if q and c in (INSULT, THREAT) else f)))


def _verdict(symbol) -> int:
    c, f = symbol
    if c not in (INSULT, THREAT):
        return -1
    if "negated" in f:
        return NEGATED
    if "reported" in f:
        return REPORTED
    return THREATENING if c == THREAT else AIMED if "aimed" in f else PLAIN


@functools.cache
def grammar() -> tuple[np.ndarray, np.ndarray]:
    """The composed machine as tables [state, word class]: next state, and sum to add to (or -1)."""
    m = compose(compose(compose(target_machine(), threat_machine()), negation_machine()), report_machine())
    nxt = np.zeros((m.states, OTHER + 1), np.int64)
    out = np.full((m.states, OTHER + 1), -1)
    for (q, (c, f)), (q2, symbol) in m.arcs.items():
        if not f:
            nxt[q, c], out[q, c] = q2, _verdict(symbol)
    return nxt, out


# -- lexicon and model ---------------------------------------------------------------------------


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, 1.0))
    stems: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def lexical(self, chunk: str) -> tuple[int, float, bool]:
        """(class, weight, ends its clause) of a word with the white space after it."""
        end = bool(_CLAUSE_END.search(chunk))
        word = normal(chunk)
        weight = self.words.get(word, 0.0)
        for n in STEM_LENGTHS:
            if len(word) > n:
                weight = max(weight, self.stems.get(word[:n], 0.0))
        if weight > 0:
            return INSULT, weight, end
        return _CLOSED.get(word, OTHER), 1.0, end


_CLOSED = {w: c for c, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}


def normal(chunk: str) -> str:
    return _EDGE.sub("", chunk.lower())


def sums_of(words, model: Model, cache: dict) -> np.ndarray:
    """Per text, the weights of the grammar's matches summed by kind."""
    chunks, codes = distinct_chunks(words)
    known = []
    for c in chunks:
        found = cache.get(c)
        if found is None:
            if len(cache) > MOST_HELD:
                cache.clear()
            found = cache[c] = model.lexical(c)
        known.append(found)
    kinds = np.array([k[0] for k in known], np.int64)
    out = np.zeros((len(words.counts), N_SUMS))
    if not len(codes):
        return out
    kind = kinds[codes]
    weight = np.array([k[1] for k in known])[codes]
    stop = np.array([k[2] for k in known])[codes]
    stop[words.first[1:][words.counts > 0] - 1] = True
    ends = np.flatnonzero(stop) + 1
    starts = np.concatenate([[0], ends[:-1]])
    clauses = np.unique(np.searchsorted(ends, np.flatnonzero((kind == INSULT) | (kind == THREAT)), "right"))
    doc = np.searchsorted(words.first, starts[clauses], "right") - 1
    nxt, says = grammar()
    for k, d in zip(clauses, doc):
        q = 0
        for i in range(starts[k], ends[k]):
            c = kind[i]
            s = says[q, c]
            if s >= 0:
                out[d, s] += weight[i] if c == INSULT else 1.0
            q = nxt[q, c]
    return out


def score_of(sums: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(weights[0] + np.log1p(sums) @ weights[1:])))


def fitted(sums: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton steps, pulled to the prior; a match never speaks against toxicity."""
    x = np.column_stack([np.ones(len(sums)), np.log1p(sums)])
    w = PRIOR.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (labels - p) - PRIOR_STRENGTH * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_STRENGTH * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        w[1:] = np.maximum(w[1:], 0.0)
    return w


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())

    def flushed() -> pa.RecordBatch:
        entries = list(counts[0].keys() | counts[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(entries, pa.string()), pa.array([counts[1][e] for e in entries], pa.int64()),
             pa.array([counts[0][e] for e in entries], pa.int64())], ["entry", "pos", "neg"])
        counts[0].clear()
        counts[1].clear()
        return out

    for batch in batches:
        labels = batch.column("toxic").to_pylist()
        for lo, _, words in in_slices(batch.column("text")):
            chunks, codes = distinct_chunks(words)
            forms = [normal(c) for c in chunks]
            for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                own = {forms[c] for c in np.unique(codes[a:b])} - {""}
                stems = {f"{w[:n]}*" for w in own for n in STEM_LENGTHS if len(w) > n}
                counts[labels[lo + i]].update(own | stems)
            if len(counts[0]) + len(counts[1]) > MOST_HELD:
                yield flushed()
    yield flushed()


def fold() -> Column:
    """crc32 of doc_id as text, modulo the number of folds; fold 0 is held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_FOLDS


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon and weights from at most ``MOST_LABELLED`` labelled documents outside the held-out fold."""
    spark = docs.sparkSession
    picked = labels.filter(F.col("toxic").isNotNull() & (fold() != 0)).groupBy("doc_id").agg(
        F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).cast("int").alias("toxic")
    ).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED)
    rows = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.md5("text")).alias("text"))
    sample = stored(rows.select("toxic", "text").distinct(), "labelled")
    totals = dict(sample.groupBy("toxic").count().collect())
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    model = Model()
    if not pos or not neg:
        return model
    odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    error = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    counts = sample.mapInArrow(_counted, "entry string, pos bigint, neg bigint").groupBy("entry").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    ).filter(f"pos + neg >= {LEAST_DOCUMENTS}")
    counts = counts.withColumn("sure", odds - error)
    against = counts.filter(F.col("entry").isin(*INSULTS) & (F.col("sure") < 0)).select("entry")
    for (entry,) in against.collect():
        model.words.pop(entry, None)
    strong = counts.filter((F.col("sure") >= LEAST_LOG_ODDS) & (F.col("pos") >= LEAST_DOCUMENTS)).orderBy(
        F.desc("sure"), "entry").limit(MOST_ENTRIES)
    found = [tuple(r) for r in strong.select("entry", "sure", "pos").collect()]
    for entry, sure, seen in found:
        weight = float(np.clip(sure / 3, 0.5, 2.0))
        if not entry.endswith("*"):
            model.words[entry] = weight
        elif not any(w.startswith(entry[:-1]) and n >= 0.9 * seen for w, _, n in found if not w.endswith("*")):
            model.stems[entry[:-1]] = weight  # a stem of one word only would add nothing but risk
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            for lo, hi, words in in_slices(batch.column("text")):
                sums = sums_of(words, shared.value, cache)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic").slice(lo, hi - lo)] + [pa.array(sums[:, k]) for k in range(N_SUMS)],
                    ["toxic"] + [f"s{k}" for k in range(N_SUMS)])

    rows = sample.select("toxic", "text").mapInArrow(
        measure, "toxic int, " + ", ".join(f"s{k} double" for k in range(N_SUMS))).collect()
    if rows:  # at most MOST_LABELLED rows of six numbers, one per doc_id
        data = np.array([tuple(r) for r in rows], float)
        data = data[np.lexsort(data.T)]  # a fixed order, for equal sums in every run
        model.weights = fitted(data[:, 1:], data[:, 0])
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, and the five sums behind it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            for lo, hi, words in in_slices(batch.column("text")):
                sums = sums_of(words, shared.value, cache)
                score = score_of(sums, shared.value.weights)
                part = batch.slice(lo, hi - lo)
                others = [part.column(c) for c in batch.schema.names]
                yield pa.RecordBatch.from_arrays(others + [pa.array(score), ragged_sums(sums)],
                                                 batch.schema.names + ["_score", "_sums"])

    added = [StructField("_score", DoubleType()), StructField("_sums", ArrayType(DoubleType()))]
    return docs.mapInArrow(run, StructType(docs.schema.fields + added))


def ragged_sums(sums: np.ndarray) -> pa.Array:
    first = np.arange(len(sums) + 1) * N_SUMS
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(sums.ravel()))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, and the sums by kind of match.

    Only text decides a score. Labels (doc_id, toxic) of documents outside the held-out fold are used for
    learning, at most ``MOST_LABELLED`` of them, chosen by a hash of doc_id; of several labels of one doc_id the
    largest counts, null ones do not. A labelled doc_id with several texts gives one (the least by md5), and of equal texts with an
    equal label one is learned from. Without labels of both kinds the general vocabulary and the prior weights
    hold. Null and empty texts have no match and get the score of the intercept; a null doc_id is not held out.
    Repeated rows are scored alike; other columns are ignored; an empty table gives an empty result.
    """
    model = learned(docs, labels)
    out = scored(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"), F.col("_sums").alias("sums"),
    )


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic, all columns kept (also ones named as ours)."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index("text")
    scored_ = scored(plain.withColumn("text", F.col(f"c{at}")), learned(docs.select("doc_id", "text"), labels))
    return scored_.filter("_score < 0.5").select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
