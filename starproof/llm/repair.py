"""Repair of conversation structure by the cheapest edits, over a suffix-shared automaton of signatures.

After damage every row of a conversation is one letter: its role's initial and its fault. The letters of a
conversation are its signature; what an edit costs and which edits are best depends on the letters that
follow and on the state of the role grammar ``(s?(ua)+)?`` alone. So the signatures of all conversations form an
automaton that shares their suffixes, minimised from the end: a node is a letter in front of another
node. Cost-to-go and best edit are computed once per node and grammar state. Distinct signatures come sorted from
the end, so that a task keeps one path of the automaton, and a node is left when the last signature that has it is done.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starproof.llm.scratch import stored

#: Fixed values of damage, faults and edits.
CLASSES = 20
DROPPED, EMPTIED, UNPUNCTUATED, REPEATED, REROLED = range(5)
REROLE, DELETE, INSERT, TRUNCATED_KEPT = 1, 2, 5, 5

#: Letters of a signature: roles s, u, a and any other, by fault none, truncated, blank, duplicate.
ROLES = "sua-"
LETTERS = "suaxSUAXbcdeBCDE"
FAULTS = ("none", "truncated", "blank", "duplicate")
SEGMENT = 8192
_NEVER = 1 << 60

# Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a. What may follow, and where it leads.
START, HEAD, ASKED, ANSWERED = range(4)
NEXT = ({"s": HEAD, "u": ASKED}, {"u": ASKED}, {"a": ANSWERED}, {"u": ASKED})
MISSING = ("u", "u", "a", "u")  # the one of user and assistant that a state takes
FULL = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

STATS = ("blank", "duplicate", "truncated", "illegal", "cost")
RESULT = "signature string, " + ", ".join(f"{c} bigint" for c in STATS) + ", audit string"


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) after damage by crc32 of ``conv_id:turn``, with ``n`` copies of each."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % CLASSES
    text = F.when(kind == EMPTIED, "").when(kind == UNPUNCTUATED, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    return rows.filter(kind != DROPPED).select(
        "conv_id", "turn", F.when(kind == REROLED, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        F.when(kind == REPEATED, 2).otherwise(1).alias("n"))


def lettered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n, letter, again): equal rows folded to one with their number ``n``; ``letter``
    is that of the first of them, ``again`` that of the others.

    A row was seen earlier if its role and text have an earlier turn in the conversation: a grouped minimum, joined back on
    a digest, so a text that fills a conversation is folded or spread, never gathered.
    """
    folded = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    key = F.concat_ws(":", conv, F.length("role").cast("string"), "role", "text")
    folded = folded.withColumn("digest", F.unhex(F.sha2(key, 256))).withColumn("at", F.struct(F.col("turn").isNotNull().alias("some"), "turn"))
    first = folded.groupBy("digest").agg(F.min("at").alias("first"))
    role = F.substr("role", F.lit(1), F.lit(1))
    letter = F.when(role.isin("s", "u", "a"), role).otherwise("x")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z")

    def as_fault(k: int) -> Column:
        return F.translate(letter, LETTERS[:4], LETTERS[4 * k : 4 * k + 4])

    once = F.when(blank, as_fault(2)).when(F.col("at") != F.col("first"), as_fault(3)).when(cut, as_fault(1)).otherwise(letter)
    return folded.join(first, "digest").select(
        "conv_id", "turn", "role", "text", "n", once.alias("letter"), F.when(blank, as_fault(2)).otherwise(as_fault(3)).alias("again"))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of the stretches of conversations in one sorted range of rows, ``SEGMENT`` rows at a time."""
    part = TaskContext.get().partitionId()
    conv, letters, seq, done = None, [], 0, []

    def cut() -> None:
        nonlocal seq
        if letters:
            done.append((conv, part, seq, "".join(letters)))
            seq += 1
            letters.clear()

    names = ["conv_id", "part", "seq", "letters"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string()]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "n", "letter", "again")]
        for c, n, letter, again in zip(*columns):
            if c != conv or len(letters) >= SEGMENT:
                cut()
                conv = c
            letters.append(letter if n == 1 else letter + again * (n - 1))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*done)) or [[]] * 4, kinds)], names)
        done.clear()
    cut()
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*done)) or [[]] * 4, kinds)], names)


def signatures(letters: DataFrame) -> DataFrame:
    """(conv_id, signature): one letter per row in the order of turns, null turns first, ties by role and text.

    Rows are sorted over all tasks, so a long conversation is read by many; only its letters come together.
    """
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    ranged = letters.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "n", "letter", "again")
    pieces = ranged.mapInArrow(_segments, "conv_id bigint, part int, seq bigint, letters string")
    joined = F.sort_array(F.collect_list(F.struct("part", "seq", "letters")))
    return pieces.groupBy("conv_id").agg(joined.alias("pieces")).select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["letters"]), "").alias("signature"))


class Suffixes:
    """The path of the automaton for one signature, from its end; sharing what follows with the path before it.

    Per node and grammar state: the least cost to go, and the first of the best edits. Edits that cost the same differ in
    their initial, so the least initial begins the least audit.
    """

    def __init__(self):
        ends = [0 if s in (START, ANSWERED) else _NEVER for s in range(4)]
        self.nodes = [self._inserted(ends, [""] * 4)]
        self.seen = [(0, 0, 0, 0)]  # blank, duplicate, truncated, illegal to go
        self.path = ""
        self.made = 0

    @staticmethod
    def _inserted(cost: list[int], edit: list[str]) -> tuple[tuple, tuple]:
        """Costs where up to two rows are inserted before what was already chosen; more would return to a state."""
        best = []
        for s in range(4):
            t = NEXT[s][MISSING[s]]
            u = NEXT[t][MISSING[t]]
            best.append(min((cost[s], edit[s]), (cost[t] + INSERT, "I"), (cost[u] + 2 * INSERT, "I")))
        return tuple(c for c, _ in best), tuple(e for _, e in best)

    def _push(self, letter: str) -> None:
        after = self.nodes[-1][0]
        fault, kind = divmod(LETTERS.index(letter), 4)
        role, must_go, extra = ROLES[kind], fault >= 2, TRUNCATED_KEPT if fault == 1 else 0
        cost, edit = [], []
        for s in range(4):
            options = [(after[s] + DELETE, "D")]
            if not must_go:
                options.append((after[NEXT[s][MISSING[s]]] + REROLE + extra, "R"))
                if role in NEXT[s]:
                    options.append((after[NEXT[s][role]] + extra, "K"))
            c, e = min(options)
            cost.append(c)
            edit.append(e)
        self.nodes.append(self._inserted(cost, edit))
        b, d, t, i = self.seen[-1]
        pair = role + (ROLES[LETTERS.index(self.path[-1]) % 4] if self.path else "")
        self.seen.append((b + (fault == 2), d + (fault == 3), t + (fault == 1), i + (len(pair) == 2 and pair not in LEGAL)))
        self.path += letter
        self.made += 1

    def turn_to(self, backwards: str) -> None:
        """Makes ``backwards``, a signature read from its end, the path; keeps the suffix that it has in common."""
        keep = len(commonprefix([self.path, backwards]))
        del self.nodes[keep + 1 :], self.seen[keep + 1 :]
        self.path = backwards[:keep]
        for letter in backwards[keep:]:
            self._push(letter)

    def audit(self) -> str:
        """The edits from the head of the signature, read off along the path."""
        edits, s, at = [], START, len(self.path)
        while True:
            e = self.nodes[at][1][s]
            if e == "":
                return "".join(edits)
            edits.append(e)
            if e == "I":
                s = NEXT[s][MISSING[s]]
                continue
            at -= 1
            if e == "R":
                s = NEXT[s][MISSING[s]]
            elif e == "K":
                s = NEXT[s][ROLES[LETTERS.index(self.path[at]) % 4]]

    def result(self) -> tuple:
        return (*self.seen[-1], self.nodes[-1][0][START], self.audit())


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = Suffixes()
    for batch in batches:
        out = []
        for backwards in batch.column("backwards").to_pylist():
            automaton.turn_to(backwards)
            out.append((backwards[::-1], *automaton.result()))
        columns = list(zip(*out)) or [[]] * (len(STATS) + 2)
        kinds = [pa.string(), *[pa.int64()] * len(STATS), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["signature", *STATS, "audit"])


def solved(found: DataFrame) -> DataFrame:
    """The result of each distinct signature, as in ``RESULT``."""
    distinct = found.select(F.reverse("signature").alias("backwards")).distinct()
    return distinct.repartitionByRange("backwards").sortWithinPartitions("backwards").mapInArrow(_solved, RESULT)


class _Repair:
    """Applies an audit to the rows of one conversation as they pass, hashing what is left."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.hash, self.first = hashlib.sha256(), True

    def _emit(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _put_in(self) -> str:
        need = MISSING[self.state]
        self.state = NEXT[self.state][need]
        return FULL[need]

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._emit(self._put_in(), "")

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self._emit(self._put_in(), text)
        elif edit == "K":
            self._emit(role, text)
            self.state = NEXT[self.state][role[0]]


_OUT = ("conv_id", "gaps", *STATS, "audit")
REPAIRED = "conv_id bigint, gaps bigint, " + ", ".join(f"{c} bigint" for c in STATS) + ", audit string, repaired_sha256 string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations as a stream, each its result followed by its rows; nothing but the audit is held."""
    head, repair, done = None, None, []

    def close() -> None:
        if head is not None:
            repair.inserts()
            done.append((*head, repair.hash.hexdigest()))

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*done)) or [[]] * (len(_OUT) + 1)
        kinds = [*[pa.int64()] * (len(_OUT) - 1), pa.string(), pa.string()]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [*_OUT, "repaired_sha256"])
        done.clear()
        return out

    for batch in batches:
        heads, rows = ([batch.column(c).to_pylist() for c in names] for names in (_OUT, ("is_row", "role", "text", "n")))
        for own, (is_row, role, text, n) in zip(zip(*heads), zip(*rows)):
            if is_row:
                for _ in range(n):
                    repair.row(role, text)
            else:
                close()
                head, repair = own, _Repair(own[-1])
        yield flushed()
    close()
    yield flushed()


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text), before damage: its gaps, faults, cost, audit and repaired hash.

    Damage, faults and edits are those of the module's fixed values. A null role or text is one space, also in the damage's key for
    conv_id and turn; null conv_ids are one conversation, null turns come first and count for no gap. Rows of one turn are
    taken by role, then text. A role that begins with none of s, u, a, also an empty one, can't be kept and is never in a legal pair.
    Repeated rows are duplicates of the first. Whole texts are hashed as they stream by; SHA-256 has one order, so a
    conversation is hashed by one task, whatever its length. Other columns are ignored; an empty table gives an empty result.
    """
    rows = rows.select("conv_id", "turn", "role", "text")
    after = damaged(rows)
    letters = stored(lettered(after), "letters")
    stays = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]).cast("binary")) % CLASSES != DROPPED
    turn = F.when(stays, F.col("turn"))
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("bigint")
    every = rows.groupBy("conv_id").agg(gaps.alias("gaps"))
    found = stored(signatures(letters), "signatures")
    known = found.join(solved(found), "signature").drop("signature").withColumnRenamed("conv_id", "own")
    heads = every.join(known, F.col("conv_id").eqNullSafe(F.col("own")), "left").select(
        "conv_id", "gaps", *[F.coalesce(c, F.lit(0)).alias(c) for c in STATS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.lit(False).alias("is_row"))
    both = heads.unionByName(letters.select("conv_id", "turn", "role", "text", "n", F.lit(True).alias("is_row")), allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), "is_row", F.asc_nulls_first("turn"), "role", "text")
    return both.select(*_OUT, "is_row", "role", "text", "n").mapInArrow(_hashed, REPAIRED)
