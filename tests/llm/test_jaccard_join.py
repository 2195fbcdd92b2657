import random
import re

import numpy as np
import pyarrow as pa

from riskloom.llm import jaccard_join as jj
from tests.llm.helpers import clashing, documents

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(id, text) rows to (id, size, component), counting on exact sets."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted(((k, len(s), least.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def family(draw, words, copies, most):
    base = [f"w{draw.randrange(3000)}" for _ in range(words)]
    for _ in range(copies):
        text = list(base)
        for _ in range(draw.randrange(0, most + 1)):
            text[draw.randrange(words)] = f"n{draw.randrange(10**6)}"
        yield " ".join(text)


def test_equal_to_comparing_all_pairs(spark):
    draw = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [t for n, k, m in ((30, 6, 2), (80, 40, 3), (200, 60, 8), (400, 10, 20), (6, 5, 1)) for t in family(draw, n, k, m)]
    texts += [f"{passage} " + " ".join(f"s{draw.randrange(10**6)}" for _ in range(draw.choice([10, 14, 40]))) for _ in range(90)]
    texts += [None, "", " \t\n", "one two", "ONE\u000btwo", "one two three", texts[3], texts[3].upper(), "É é É", "é É é"]
    rows = list(enumerate(texts, 1))
    draw.shuffle(rows)
    docs = documents(spark, rows)
    assert found(jj.classes(clashing(docs).repartition(5))) == brute(rows)


def test_chains_between_regions(spark, monkeypatch):
    """Links between members of regions whose pivots are too far apart to be linked themselves."""
    draw = random.Random(5)
    rows, k = [], 0
    for _ in range(12):
        words = [f"w{draw.randrange(10**6)}" for _ in range(150)]
        for _ in range(9):
            k += 1
            rows.append((k, " ".join(words)))
            for _ in range(2):
                words = list(words)
                words[draw.randrange(150)] = f"n{draw.randrange(10**6)}"
    draw.shuffle(rows)
    docs = documents(spark, rows)
    seen = []
    inner = jj.member_pairs

    def watched(apart, *rest):
        seen.append(apart.count())
        return inner(apart, *rest)

    monkeypatch.setattr(jj, "member_pairs", watched)
    for agree, side in ((2, 1024), (6, 3)):
        monkeypatch.setattr(jj, "AGREE", agree)
        monkeypatch.setattr(jj, "SIDE", side)
        assert found(jj.classes(docs)) == brute(rows)
    assert max(seen) > 0


def test_common_shingles_and_bitmaps_only_change_the_work(spark, monkeypatch):
    draw = random.Random(7)
    rows = list(enumerate([t for n, k in ((50, 70), (120, 50)) for t in family(draw, n, k, 3)], 1))
    want = brute(rows)
    for common, most, bits, counted, met in ((2, 10**6, 9, 64, 3), (10**6, 100, 26, 1 << 22, 2048)):
        for name, value in (("COMMON", common), ("MOST", most), ("BITS", bits), ("COUNTED", counted), ("MET", met), ("ROWS", 40 * met), ("HELD", 20 * met)):
            monkeypatch.setattr(jj, name, value)
        assert found(jj.classes(documents(spark, rows))) == want


def test_a_large_family_meets_under_its_original(spark, monkeypatch):
    """Copies that keep all minimum hashes of the original are no better pivots than it: the copies stay in few regions."""
    draw = random.Random(12)
    base = [f"w{k}" for k in range(150)]
    texts = [" ".join(base)]
    for _ in range(120):
        copy = list(base)
        for _ in range(draw.randrange(1, 4)):
            copy[draw.randrange(150)] = f"n{draw.randrange(10**6)}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts, 1))
    draw.shuffle(rows)
    seen = []
    inner = jj.open_pairs

    def watched(keyed, place):
        seen.append(place.select("region").distinct().count())
        return inner(keyed, place)

    monkeypatch.setattr(jj, "open_pairs", watched)
    assert found(jj.classes(documents(spark, rows))) == brute(rows)
    assert seen[0] <= 2


def test_awkward_tables(spark):
    long = " ".join(f"x{k}" for k in range(60_000))
    rows = [(1, long), (2, long + " end"), (None, long), (None, "a b c d e f"), (None, None), (4, "a b c d e f g"), (4, "zz"), (5, "zz"), (4, None), (6, "y" * 2_000_000)]
    assert found(jj.classes(documents(spark, rows))) == brute(rows)
    assert jj.classes(documents(spark, [])).count() == 0


def test_sets_and_first_shares():
    texts = ["A b\u000bc\td  e f", "", "x y", "café b c d e CAFÉ b c d e"]
    sets = jj.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    s = np.unique(np.random.default_rng(1).integers(0, 2**63, 101, dtype=np.uint64))
    none = np.zeros(1 << (jj.BITS - 6), np.uint64)
    assert len(jj.first_share(s, none)) == len(s) - 81 + 1 and len(jj.first_share(s, ~none)) == 21
