import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import divergence as dv
from tests.llm.helpers import DOC, clashing

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, documents=30, top=50):
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        df[lang].update(set(terms))
    kept = {lang: sorted(t for t, k in c.items() if k >= documents) for lang, c in df.items()}
    share = {}
    for lang, source in [*groups, *{(lang, None) for lang, _ in groups}]:
        c = counts[lang, source] if source is not None else sum((counts[g] for g in groups if g[0] == lang), Counter())
        terms = kept.get(lang, [])
        total = sum(c[t] for t in terms) + 5 * len(terms)
        share[lang, source] = {t: 1 + 10**9 * (c[t] + 5) // total for t in terms}
    out = []
    for lang, source in groups:
        p = share[lang, source]
        pair = [(s, sum(abs(p[t] - share[lang, s][t]) for t in p)) for g, s in groups if g == lang and s != source]
        term = [(t, p[t] - share[lang, None][t]) for t in p if counts[lang, source][t] and p[t] > share[lang, None][t]]
        for part, found, most in (("pair", pair, None), ("term", term, top)):
            ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def table(draw, n, words):
    out = []
    for i in range(n):
        source = None if i % 11 == 0 else f"s{min(draw.randrange(9), draw.randrange(9))}"
        lang = (None, "en", "de")[draw.randrange(3)]
        text = " ".join(draw.choice(words) for _ in range(draw.randrange(0, 120)))
        out.append((i if i % 5 else None, text if i % 17 else None, lang, source, 0))
    return out


def test_equal_to_exact_arithmetic(spark, monkeypatch):
    draw = random.Random(12)
    words = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(12) for b in range(12)] + ["Été", "été", "ÉTÉ", "a1b2", "don't", "x_y", "日本語", "ABC"]
    rows = table(draw, 400, words) + [(1, "rare", "fr", "only", 0), (2, None, "fr", None, 0), (3, "", "it", "one", 0), (4, "word " * 100_000, "en", "s1", 0)]
    rows += rows[:20]
    docs = clashing(spark.createDataFrame(rows, DOC)).repartition(6)
    want = brute(rows)
    assert found(dv.audit(docs)) == want
    monkeypatch.setattr(dv, "BUCKET", 16)
    monkeypatch.setattr(dv, "BLOCK", 2)
    assert found(dv.audit(docs)) == want


def test_empty_table(spark):
    assert dv.audit(spark.createDataFrame([], DOC)).count() == 0


def test_shares_of_large_counts_are_exact(spark):
    draw = random.Random(4)
    cases = [(draw.randrange(10**k), draw.randrange(10**k, 9 * 10**15)) for k in range(1, 16) for _ in range(20)]
    want = [1 + 10**9 * (c + 5) // t for c, t in cases]
    assert dv.share(np.array([c for c, _ in cases]), np.array([t for _, t in cases])).tolist() == want
    rows = spark.createDataFrame([(k, c, t) for k, (c, t) in enumerate(cases)], "k int, c long, t long")
    assert [r.p for r in rows.select("k", dv._share(F.col("c"), F.col("t")).alias("p")).orderBy("k").collect()] == want
