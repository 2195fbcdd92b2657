import random
import re
from collections import Counter, defaultdict

import pytest

from riskloom.llm import collocations as co
from tests.llm.helpers import DOC, clashing

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, often, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= often}
        covered = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    covered[p[i : i + size]] = max(covered[p[i : i + size]], a)
        found = []
        for p, a in candidates.items():
            if 100 * covered[p] >= 100 * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), left, right))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, rank, p, a, left, right, n[lang], score) for rank, (score, a, p, left, right) in enumerate(found[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def table(draw):
    words = [f"w{k}" for k in range(40)] + ["Été", "été", "日本", "a-b", "x" * 300]
    out = []
    for i in range(300):
        text = ""
        for _ in range(draw.randrange(0, 60)):
            text += draw.choice(words if draw.random() < 0.7 else ["New york City", "as far\tas  I can", "b b b b b b b"])
            text += draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\u000b", "  "])
        out.append((i if i % 7 else None, text if i % 13 else None, draw.choice([None, "en", "en", "de", ""]), "s", 0))
    return out + out[:10] + [(5, "over and over " * 30_000, "fr", "s", 0)]


@pytest.mark.parametrize(("mask", "top", "size"), [(2**64 - 1, 2000, 1 << 23), (2**64 - 2**57, 7, 2000)])
def test_equal_to_counting_phrases(spark, monkeypatch, mask, top, size):
    """The second case has fingerprints of seven bits, which collide, small parts and a low limit."""
    for name, value in (("OFTEN", 12), ("MASK", mask), ("TOP", top), ("BYTES", size), ("HELD", 4 * size), ("RANGE", size)):
        monkeypatch.setattr(co, name, value)
    rows = table(random.Random(3))
    docs = clashing(spark.createDataFrame(rows, DOC)).repartition(5)
    assert found(co.phrases(docs)) == brute(rows, 12, top)


def test_nothing_frequent_and_empty_table(spark):
    assert co.phrases(spark.createDataFrame([(1, "one two", "en", "s", 7), (None, None, None, None, None)], DOC)).count() == 0
    assert co.phrases(spark.createDataFrame([], DOC)).count() == 0


def test_scores_beyond_64_bits_are_exact(spark):
    draw = random.Random(9)
    cases = []
    for _ in range(200):
        n = draw.randrange(10**6, 10**14)
        a = draw.randrange(100, n)
        cases.append((a, n, draw.randrange(a, n + 1), draw.randrange(a, n + 1)))
    rows = spark.createDataFrame(cases, "a long, n long, l long, r long")
    got = [r[0] for r in rows.select(co._score(rows["a"], rows["n"], rows["l"], rows["r"])).collect()]
    assert got == [1000 * a * n // (left * right) for a, n, left, right in cases]
