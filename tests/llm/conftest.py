import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and white texts, repeated rows, copies, near copies, a shared passage, a long text, odd characters."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base, passage = text(120).split(), text(60)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a null id with five words or more"), (None, None), (4, "two words"), (5, "two words"),
            (6, "two\twords"), (7, " ".join(base)), (8, " ".join(base)), (9, " ".join(base)), (9, " ".join(base)), (9, text(80))]
    for i in range(10, 40):
        near = list(base)
        near[rng.randrange(len(near))] = "changed"
        rows.append((i, "\n".join([" ".join(near[:60]), " ".join(near[60:])])))
    for i in range(40, 60):
        rows.append((i, f"{text(rng.randint(0, 70))}\n{passage} {text(rng.randint(0, 70))}"))
    rows += [(i, text(rng.randint(1, 150))) for i in range(60, 110)]
    rows += [(110, text(40_000)), (111, "x" * 30_000), (112, "été 日本語 🙂 naïve word word " * 30), (113, "same line\n" * 50)]
    rows += [(r[0] + 1000 if r[0] else r[0], r[1]) for r in rows[60:70]]
    return rows + twins()


def thue_morse(a, b, n):
    return [(a, b)[bin(i).count("1") % 2] for i in range(n)]


def twins():
    """Words, word runs and lines that a polynomial hash modulo a power of two does not tell apart."""
    long = ["".join(thue_morse(*pair, 1024)) for pair in ("ab", "ba")]
    runs = [" ".join(thue_morse(*pair, 64)) for pair in (("red", "blue"), ("blue", "red"))]
    filler = " ".join(f"f{i}" for i in range(49))
    return [(3000, long[0]), (3001, long[1]), (3002, f"{filler} {long[0]}"), (3003, f"{filler} {long[1]}"), (3004, runs[0]), (3005, runs[1]),
            (3006, f"{long[0]}\n{long[1]}\n{long[0]}\n"), (3007, " ".join(thue_morse("red", "blue", 32)) + f" {filler}"),
            (3008, " ".join(thue_morse("blue", "red", 32)) + f" {filler}")]
