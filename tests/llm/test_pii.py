import random
import re

from llm_rows import make_docs
from pyspark.sql import functions as F

from starproof.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
PARTS = ["a@b.c", "x.y@d-e.f.g", "_", ".", "@", "1.2.3.4", "256.1.1.1", "007.1.1.255", "4111 1111 1111 1111", "4111-1111-1111-1111 2",
         "+1 (988) 555-2485", "+44", "555", "-", " ", "🙂", "é", "12", "9999999999", "call 555-123-4567", "GB82 WEST 1234 5698 7654 32", "\n", "%"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def confirmed(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), rank, m.end(), kind) for rank, (kind, p) in enumerate(BASE.items())
             for m in re.finditer(p, text or "") if confirmed(kind, m[0])]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


def test_base_spans_equal_brute_force(spark, edge_rows):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.choice([1, 3, 8, 30, 700]))) for _ in range(250)]
    rows = edge_rows + [(5000 + i, t) for i, t in enumerate(texts)]
    got = pii.find(make_docs(spark, rows)).select("doc_id", pii.listed(F.col("base")).alias("b")).collect()
    assert sorted((str(r.doc_id), r.b) for r in got) == sorted((str(d), ",".join(brute(t))) for d, t in rows)


def spans_of(spark, *texts):
    rows = pii.digests(pii.find(make_docs(spark, list(enumerate(texts))))).orderBy("doc_id").collect()
    return [r.spans for r in rows]


def test_checksums_and_context_confirm(spark):
    assert spans_of(
        spark, "iban GB82 WEST 1234 5698 7654 32 ok", "GB83 WEST 1234 5698 7654 32", "call 555-123-4567", "sum 555-123-4567",
        "visa 4222222222222", "number 4222222222222", "ssn 078-05-1120", "078-05-1120",
    ) == ["iban:5:32", "", "local_phone:5:17", "", "short_card:5:18", "", "ssn:4:15", ""]


def test_context_reaches_across_other_matches(spark):
    far = "x" * 41
    assert spans_of(
        spark, "Phone: 555-123-4567 or 555-987-6543", "ssn 078-05-1120, 078-05-1121", "visa 4222222222222 4222222222222",
        "phone 555-123-4567 sum 555-987-6543", "555-123-4567 is my phone", f"phone {far} 555-123-4567", f"555-123-4567 {far} phone",
        "visa 12 13 4222222222222 14", "fax" + " 555-123-4567" * 5,
    ) == ["local_phone:7:19,local_phone:23:35", "ssn:4:15,ssn:17:28", "short_card:5:18,short_card:19:32", "local_phone:6:18,local_phone:23:35", "local_phone:0:12", "", "", "short_card:11:24",
          "local_phone:4:16,local_phone:17:29,local_phone:30:42"]


def test_counts_and_order_of_one_start(spark):
    row = pii.digests(pii.find(make_docs(spark, [(1, "1.2.3.4@x.y a@b.c +4111111111111111")]))).first()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (2, 1, 1, 0)
    assert row.spans.startswith("email:0:11,ip:0:7,email:12:17")


def test_running_sums_over_many_blocks(spark):
    for n in (1, 255, 256, 257, 1000):
        got = spark.range(1).select(pii.running(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: i.cast("bigint"))).alias("s")).first().s
        assert list(got) == [i * (i + 1) // 2 for i in range(n)]


def test_hostile_texts_take_linear_time(spark):
    long = [(1, "a" * 200_000), (2, "1" * 200_000), (3, "+1 " * 60_000), (4, "a@" * 80_000), (5, "x@y" + ".z" * 80_000), (6, "1." * 80_000)]
    got = {r.doc_id: r for r in pii.digests(pii.find(make_docs(spark, long))).collect()}
    assert got[5].n_email == 1 and got[6].n_ip == 20_000


def test_redaction_keeps_rows_and_columns(spark, edge_rows):
    docs = make_docs(spark, edge_rows + [(700, "write to a.b@c.de or +1 (988) 555-2485, card 4111 1111 1111 1111 from 10.0.0.1!")])
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    row = out.filter("doc_id = 700").first()
    assert row.text == "write to [EMAIL] or [PHONE], card [CARD] from [IP]!" and row.n_chars == len(row.text)
    same = docs.exceptAll(out).select("doc_id").collect()
    assert [r.doc_id for r in same] == [700]


def test_redaction_leaves_nothing_of_any_span(spark):
    """Letters stand for code points of op4's spans, which all go; what is outside of every confirmed span stays."""
    rng = random.Random(9)
    texts = ["Tel +33.1.42.68.53.00", "+441111111111111", "1.2.3.4@x.y 🙂 é", "GB82 WEST 1234 5698 7654 32 4111 1111 1111 1111",
             "+1 (988) 555-2485. 4111 1111 1111 1111 x", "a@b.c" * 300, "🙂 10.0.0.1 " * 200, "none", None]
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.choice([3, 8, 30, 300]))) for _ in range(120)]
    docs = make_docs(spark, list(enumerate(texts)))
    spans = {r.doc_id: [(x.start, x.end) for x in r.base + r.added] for r in pii.find(docs).collect()}
    once = {r.doc_id: r.text for r in pii._cut_out(docs.select("doc_id", "text")).collect()}
    for i, text in enumerate(texts):
        if text is None:
            assert once[i] is None
            continue
        inside = {k for a, b in spans[i] for k in range(a, b)}
        rest, left = "".join(c for k, c in enumerate(text) if k not in inside), re.sub(r"\[(?:EMAIL|IP|CARD|PHONE|IBAN|SSN)\]", "", once[i])
        if "WEST" not in text:  # an account number that overlaps a base span goes as well
            assert left == rest
        assert bool(spans[i]) == (once[i] != text)
    got = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert [got[i] for i in range(5)] == ["Tel [PHONE]", "[PHONE]", "[EMAIL] 🙂 é", "[IBAN] [CARD]", "[PHONE]. [CARD] x"]
    assert got[5] == "[EMAIL]" + re.sub(BASE["email"], "[EMAIL]", "a@b.c" * 300).removeprefix("[EMAIL]") and got[8] is None
    assert not any(brute(t) for t in got.values())


def test_empty_table(spark):
    assert pii.digests(pii.find(make_docs(spark, []))).count() == 0
    assert pii.redact(make_docs(spark, [])).count() == 0
