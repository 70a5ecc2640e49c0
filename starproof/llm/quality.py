"""Quality rules as a short-circuit cascade.

Each rule is measured on a bounded sample: its cost per document and the share that it rejects.
Rules then run in the order of rejection per cost, each one only on the documents that all
earlier ones passed. The order changes the work, never the verdict: a document is kept if it passes
every rule.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starproof.llm.words import Words, in_slices, range_hashes, window_hashes

#: Documents measured for the order of the rules.
SAMPLE_ROWS = 2_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123), *range(0xC0, 256)]] = True  # ASCII letters and lead bytes of other characters
_NEWLINE = 10


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


class Features:
    """Counts of the texts of one slice, each computed when first asked for and only for the rows asked for."""

    def __init__(self, words: Words):
        self.words = words
        self._hashes = self._cut = None

    def n_words(self, rows):
        return self.words.counts[rows]

    def word_chars(self, rows):
        """Code points inside words: bytes that are neither white space nor the continuation of a character."""
        w = self.words
        inside = np.zeros(len(w.data) + 1, np.int64)
        np.add.at(inside, w.starts, 1)
        np.add.at(inside, w.ends, -1)
        chars = (np.cumsum(inside[:-1]) > 0) & ((w.data & 0xC0) != 0x80)
        return _per_text(chars, w.offsets)[rows]

    def n_symbols(self, rows):
        return _per_text(_SYMBOL[self.words.data], self.words.offsets)[rows]

    def n_shouts(self, rows):
        """Exclamation and question marks."""
        data = self.words.data
        return _per_text((data == 33) | (data == 63), self.words.offsets)[rows]

    def n_letter_words(self, rows):
        """Words with a letter."""
        w = self.words
        total = np.concatenate([[0], np.cumsum(_ALPHA[w.data])])
        has = total[w.ends] > total[w.starts]
        return _per_text(has, w.first)[rows]

    def _lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the lines of all texts that hold a word, and the text of each."""
        if self._cut is None:
            w = self.words
            breaks = np.flatnonzero(w.data == _NEWLINE)
            starts = np.unique(np.concatenate([w.offsets[:-1], breaks + 1]))
            ends = np.append(starts[1:], len(w.data))
            words_before = np.searchsorted(w.starts, np.append(starts, len(w.data)))
            full = np.diff(words_before) > 0
            starts, ends = starts[full], ends[full]
            ends = ends - (w.data[ends - 1] == _NEWLINE)
            self._cut = starts, ends, np.searchsorted(w.offsets, starts, "right") - 1
        return self._cut

    def n_dup_lines(self, rows):
        """Lines equal to an earlier line of the same text; equal hashes are checked on the lines themselves."""
        starts, ends, text = self._lines()
        wanted = np.isin(text, rows)
        starts, ends, text = starts[wanted], ends[wanted], text[wanted]
        hashes = range_hashes(self.words.data, starts, ends)
        order = np.lexsort((hashes, text))
        same = (np.diff(hashes[order]) == 0) & (np.diff(text[order]) == 0)
        out = np.zeros(len(self.words.counts), np.int64)
        for t in np.unique(text[order[1:][same]]):
            a, b = np.searchsorted(text, [t, t + 1])
            lines = [self.words.data[x:y].tobytes() for x, y in zip(starts[a:b], ends[a:b])]
            out[t] = len(lines) - len(set(lines))
        return out[rows]

    def n_lines(self, rows):
        return np.bincount(self._lines()[2], minlength=len(self.words.counts))[rows]

    def n_repeat_words(self, rows):
        """Words inside some 3-word window that occurs at least twice in the text."""
        if self._hashes is None:
            self._hashes = self.words.hashes()
        out = np.zeros(len(rows), np.int64)
        for k, r in enumerate(rows):
            h = self._hashes[self.words.first[r] : self.words.first[r + 1]]
            if len(h) < 4:
                continue
            grams = window_hashes(h, 3)
            order = np.argsort(grams, kind="stable")
            g = grams[order]
            same = np.concatenate([[False], g[1:] == g[:-1], [False]])
            twice = np.zeros(len(h), bool)
            at = order[same[:-1] | same[1:]]
            for j in range(3):
                twice[at + j] = True
            out[k] = twice.sum()
        return out


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Features, np.ndarray], np.ndarray]


RULES = (
    Rule("short", lambda f, r: f.n_words(r) < 50),
    Rule("repetitive", lambda f, r: 100 * f.n_repeat_words(r) > 50 * f.n_words(r)),
    Rule("symbols", lambda f, r: f.n_symbols(r) > f.n_words(r)),
    Rule("shouting", lambda f, r: f.n_shouts(r) > f.n_words(r)),
    Rule("word_length", lambda f, r: (f.word_chars(r) < 2 * f.n_words(r)) | (f.word_chars(r) > 20 * f.n_words(r))),
    Rule("letters", lambda f, r: 2 * f.n_letter_words(r) < f.n_words(r)),
    Rule("repeated_lines", lambda f, r: 2 * f.n_dup_lines(r) > f.n_lines(r)),
)
BASE = ("short", "repetitive")


def cascade(features: Features, n: int, rules) -> np.ndarray:
    """Index of the rule that rejects each text, or -1; a rule sees only what earlier rules passed."""
    verdict = np.full(n, -1)
    left = np.arange(n)
    for k, rule in enumerate(rules):
        if not len(left):
            break
        bad = rule.rejects(features, left)
        verdict[left[bad]] = k
        left = left[~bad]
    return verdict


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cost, rejected, seen = np.zeros(len(RULES)), np.zeros(len(RULES), np.int64), 0
    for batch in batches:
        for lo, hi, words in in_slices(batch.column("text")):
            rows = np.arange(hi - lo)
            seen += hi - lo
            for k, rule in enumerate(RULES):
                began = time.thread_time()
                rejected[k] += int(rule.rejects(Features(words), rows).sum())
                cost[k] += time.thread_time() - began
    yield pa.RecordBatch.from_pydict(
        {"rule": list(range(len(RULES))), "cost": cost, "rejected": rejected, "seen": [seen] * len(RULES)})


def ordered_rules(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``RULES`` by rejected documents per second, measured on the ``sample_rows`` documents of least hashed doc_id."""
    picked = docs.select("doc_id").filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).distinct()
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text")
    stats = sample.mapInArrow(_measured, "rule bigint, cost double, rejected bigint, seen bigint").groupBy("rule").agg(
        F.sum("cost").alias("cost"), F.sum("rejected").alias("rejected")).collect()
    rank = {r.rule: -r.rejected / max(r.cost, 1e-9) for r in stats}
    return [RULES[k] for k in sorted(range(len(RULES)), key=lambda k: (rank.get(k, 0.0), k))]


def quality(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, the base counts, base_failed, kept, rejected_by.

    Counts cover whole texts. ``base_failed``: fewer than 50 words, or over half of them in 3-word windows
    that repeat. ``kept``: no rule rejects. ``rejected_by`` names the first rule, in cascade order, that
    rejects. Null and empty texts count zero everywhere and fail as too short. Repeated rows and null doc_ids
    get a row each; other columns are ignored; an empty table gives an empty result.
    """
    rules = tuple(rules if rules is not None else ordered_rules(docs))
    names = [r.name for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = [next(r for r in RULES if r.name == n) for n in names]
        for batch in batches:
            for lo, hi, words in in_slices(batch.column("text")):
                f, rows = Features(words), np.arange(hi - lo)
                verdict = cascade(f, hi - lo, order)
                n, repeated = f.n_words(rows), f.n_repeat_words(rows)
                failed = (n < 50) | (100 * repeated > 50 * n)
                counts = [n, f.word_chars(rows), f.n_symbols(rows), f.n_dup_lines(rows), repeated]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo)] + [pa.array(c, pa.int64()) for c in counts]
                    + [pa.array(failed), pa.array(~failed & (verdict < 0)),
                       pa.array([names[v] if v >= 0 else None for v in verdict], pa.string())],
                    ["doc_id", *COUNTS, "base_failed", "kept", "rejected_by"])

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, rejected_by string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
