import random
import re

from pyspark.sql import functions as F

from riskloom.llm import pii
from tests.llm.helpers import clashing, documents

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def good(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def base(spans):
    return [s for s in spans.split(",") if s.split(":")[0] in pii.BASE]


def test_base_spans_match_the_plain_patterns(spark):
    draw = random.Random(6)
    bits = ["a", "Z", "9", "1", "4111 1111 1111 1111", ".", "_", "%", "+", "-", "@", "b.c", "@d", "🤗", "é", " ", "(", ")", "\n", "255", "256", "0.0.0.0", "+49 30 123456", "5500-0000-0000-0004"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 50))) for _ in range(1500)]
    texts += [None, "", "1 " * 20_000, "a@b.c " * 1500, "a." * 20_000 + "@", "a@b" + ".c" * 20_000, "+1" + " " * 30_000]
    rows = pii.report(clashing(documents(spark, texts)).repartition(8)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id - 1])
        assert base(r.spans) == want or not want and base(r.spans) == [], texts[r.doc_id - 1]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.BASE]


def test_checksums_and_context_decide_on_other_kinds(spark):
    text = "my IBAN: DE89 3704 0044 0532 0130 00, not DE88 3704 0044 0532 0130 00; social security 078-05-1120" + " z" * 60 + " 078-05-1120"
    spans = pii.find(documents(spark, [text]), ["doc_id"]).first().spans
    assert [(s.kind, text[s.start : s.end]) for s in spans if s.kind in ("iban", "ssn")] == [("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "078-05-1120")]
    cards = pii.find(documents(spark, ["card 4111111111111111", "x 4111111111111111"]), ["doc_id"]).collect()
    assert cards[0].spans[0].score > cards[1].spans[0].score


def test_running_sums_in_blocks(spark):
    n = 3 * 512 + 7
    got = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x % 5).alias("v")).select(pii.running(F.col("v")).alias("s")).first().s
    total, want = 0, []
    for i in range(1, n + 1):
        total += i % 5
        want.append(total)
    assert got == want


def test_rows_stay_and_no_python_runs(spark):
    docs = documents(spark, [(None, "a@b.cd"), (1, None), (1, None)])
    assert sorted((r.n_email, r.doc_id is None) for r in pii.report(docs).collect()) == [(0, False), (0, False), (1, True)]
    assert pii.report(docs.where(F.lit(False))).count() == 0
    assert "Python" not in pii.report(docs)._jdf.queryExecution().toString()


def test_long_runs_of_digits_take_linear_time(spark):
    from time import monotonic

    texts = ["7" * 1_000_000, "7" * 400_000 + ".1.2.3 10.0.0.1", "1.2.3.4" + "5" * 300_000 + ".6.7.8 9.9.9.9", "1.1.1.1.2.2.2.2.3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    start = monotonic()
    found = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "ip"] for r in pii.find(docs, ["doc_id"]).collect()}
    assert monotonic() - start < 60
    assert found == {0: [], 1: [(400_007, 400_015)], 2: [(300_014, 300_021)], 3: [(0, 7), (8, 15)]}
