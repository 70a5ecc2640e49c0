import functools
import hashlib
import random
import re
import zlib

from starproof.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, letter string, signature string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """Every conversation by itself, row after row, with all edits tried."""
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for c, t, r, x in rows:
            if c != conv:
                continue
            key = f"{' ' if c is None else c}:{' ' if t is None else t}"
            kind = zlib.crc32(key.encode()) % 20
            r, x = " " if r is None else r, " " if x is None else x
            if kind == 0:
                continue
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            r = "user" if kind == 4 else r
            after += [(t is not None, t or 0, r, x)] * (2 if kind == 3 else 1)
        after.sort(key=lambda a: (a[0], a[1], a[2].encode(), a[3].encode()))
        turns = [t for some, t, _, _ in after if some]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, _, r, x in after:
            solid = re.sub(r"[\x20\x09-\x0D]", "", x)
            faults.append("blank" if not solid else "duplicate" if (r, x) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((r, x))
        roles = [a[2][:1] for a in after]
        illegal = sum((a + b) not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, audit, left = best(tuple(roles), tuple(faults))
        lines = [f"{role or after[i][2]}:{'' if i is None else after[i][3]}" for i, role in left]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


@functools.cache
def best(roles, faults):
    """The least (cost, audit) over all edits, compared as whole strings; no automaton, no shared suffixes."""
    @functools.cache
    def go(i, made, inserted):
        """From row i on, where ``made`` is the last initial; three inserted rows in a row help nobody."""
        found = []
        if i == len(roles) and made in ("", "a"):
            found.append((0, "", ()))

        def follow(cost, letter, j, role, new, ins):
            rest = go(j, role, ins)
            if rest:
                found.append((cost + rest[0], letter + rest[1], (new, *rest[2]) if new else rest[2]))

        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[made]
        if inserted < 3:
            for role in allowed.replace("s", ""):
                follow(5, "I", i, role, (None, {"u": "user", "a": "assistant"}[role]), inserted + 1)
        if i < len(roles):
            follow(2, "D", i + 1, made, None, 0)
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                for role in allowed.replace("s", ""):
                    follow(1 + more, "R", i + 1, role, (i, {"u": "user", "a": "assistant"}[role]), 0)
                if roles[i] and roles[i] in allowed:
                    follow(more, "K", i + 1, roles[i], (i, None), 0)
        return min(found, key=lambda f: f[:2]) if found else None

    cost, audit, left = go(0, "", 0)
    kept = "".join((role or roles[i])[:1] for i, role in left)
    assert GRAMMAR.fullmatch(kept)
    return cost, audit, left


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "l", "s") for r in rows], SCHEMA)


def sample():
    rng = random.Random(6)
    rows = []
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?\n", "é 🙂.", "dot. then", None, " "]
    for conv in range(400):
        n = rng.choice([1, 2, 3, 4, 6, 9, 14])
        for turn in range(n):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "", None, "Assistant"]) if rng.random() < 0.4 else (
                "user", "assistant")[turn % 2]
            text = rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randrange(99)}."
            rows.append((conv, rng.choice([turn, turn, turn, turn * 2, None]) if conv % 3 == 0 else turn, role, text))
    rows += [(None, t, "user", f"x{t}.") for t in (0, 1, 5, None)] + [(-7, None, "user", "a."), (-7, None, "assistant", "b.")]
    rows += rows[:20] + [(900, 3, "user", "same.")] * 9 + [(901, t, "assistant", "same.") for t in range(30)]
    rows += [(902, t, ("user", "assistant")[t % 2], "w " * 2000 + f"{t}.") for t in range(60)]
    return rows


def got(spark, rows):
    return {r.conv_id: tuple(r)[1:] for r in repair.repaired(make(spark, rows)).collect()}


def test_repair_equals_brute_force(spark):
    rows = sample()
    want = brute(rows)
    assert got(spark, rows) == want
    random.Random(1).shuffle(rows)
    assert got(spark, rows) == want


def test_long_conversations_are_cut_into_segments(spark, monkeypatch):
    rows = sample()
    frame = repair.lettered(repair.damaged(make(spark, rows)))
    whole = {r.conv_id: r.signature for r in repair.signatures(frame).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = {r.conv_id: r.signature for r in repair.signatures(frame.repartition(5)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert whole == split and max(map(len, whole.values())) >= 50
    small = [(5, t, "user", f"{t}.") for t in range(20_000)]
    (row,) = repair.repaired(make(spark, small)).collect()
    assert len(row.audit.replace("I", "")) == sum(zlib.crc32(f"5:{t}".encode()) % 20 != 0 for t in range(20_000)) + row.duplicate


def test_nodes_are_made_once_per_suffix():
    rng = random.Random(3)
    signatures = sorted({"".join(rng.choice("suaxUAbc") for _ in range(rng.randint(1, 9))) for _ in range(500)})
    shared = repair.Suffixes()
    for backwards in signatures:
        shared.turn_to(backwards)
        alone = repair.Suffixes()
        alone.turn_to(backwards)
        assert shared.result() == alone.result()
    assert shared.made == len({s[:k] for s in signatures for k in range(1, len(s) + 1)})


def test_empty_table_and_conversations_without_rows(spark):
    assert got(spark, []) == {}
    gone = next(t for t in range(999) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    assert got(spark, [(1, gone, "user", "x.")]) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
