import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskloom.llm import order_minhash as omh
from riskloom.llm import words
from tests.llm.helpers import clashing, documents


def kmers(text):
    hashed, at = words.lower_words(pa.array([text]))
    return words.shingles(hashed, 5)


def jaccard(a, b):
    a, b = Counter(kmers(a).tolist()), Counter(kmers(b).tolist())
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def sentence(draw, n):
    return [f"w{draw.randrange(5000)}" for _ in range(n)]


def variants(draw):
    """Families of texts at several distances, and one large family of near copies."""
    out = []
    for family in range(25):
        base = sentence(draw, draw.choice([20, 80, 300]))
        for _ in range(4):
            text = list(base)
            for _ in range(draw.randrange(0, 1 + len(text) // 40)):
                text[draw.randrange(len(text))] = f"n{draw.randrange(10**6)}"
            out.append(" ".join(text))
    base = sentence(draw, 200)
    for k in range(150):
        text = list(base)
        text[k] = f"only{k}"
        out.append(" ".join(text))
    return out


def test_every_link_is_in_one_class_and_no_class_joins_strangers(spark):
    texts = variants(random.Random(8))
    rows = {r.doc_id: r for r in omh.classes(clashing(documents(spark, texts)).repartition(6)).collect()}
    parent = {i: i for i in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in rows:
        for j in range(1, i):
            if jaccard(texts[i - 1], texts[j - 1]) >= omh.SIMILARITY:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert {i: r.class_id for i, r in rows.items()} == {i: root(i) for i in rows}
    assert all((r.n_links > 0) == any(root(r.doc_id) == root(o) and rows[o].text_id != r.text_id for o in rows if o != r.doc_id) for r in rows.values())


def templated(draw):
    """Texts that share one template: pairs, strangers, and a chain in which only neighbours are alike."""
    template, out = sentence(draw, 170), []
    for _ in range(60):
        shared = sentence(draw, 15)
        out += [" ".join(template + shared + [f"n{draw.randrange(10**6)}" for _ in range(15)]) for _ in range(2)]
        out.append(" ".join(template + sentence(draw, 32)))
    walk = [f"c{k}" for k in range(16 * 80 + 50)]
    out += [" ".join(template[:150] + walk[16 * k : 16 * k + 50]) for k in range(80)]
    draw.shuffle(out)
    return out


def test_links_within_large_buckets_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(omh, "BLOCK", 64, raising=False)
    texts = templated(random.Random(4))
    runs = [kmers(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and omh.aligned(runs[i], runs[j]) >= omh.SIMILARITY:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    assert len(set(label)) == 60 + 60 + 1
    rows = {r.doc_id: r.class_id for r in omh.classes(documents(spark, texts).repartition(5)).collect()}
    assert rows == {i: x + 1 for i, x in enumerate(label, 1)}


def test_counts_by_cell_never_rule_out_a_link():
    draw = random.Random(3)
    for n in (3, 40, 400, 30_000):
        a = sentence(draw, n)
        for share in (0.0, 0.01, 0.02, 0.03):
            b = [f"n{draw.randrange(10**6)}" if draw.random() < share else w for w in a] + ["tick", "tock"] * (n // 60)
            x, y = kmers(" ".join(a)), kmers(" ".join(b))
            cells = [omh.cell_counts(k).tobytes() for k in (x, y)]
            rows = pa.table({"id": [2, 1], "n": [len(x), len(y)], "label": [2, 1], "own": [True, False], "block": [0, 0], "cells": cells})
            assert omh.aligned(x, y) < omh.SIMILARITY or omh.compare_counts(rows).num_rows == 1


def test_order_counts():
    a = [f"w{i}" for i in range(400)]
    assert omh.aligned(kmers(" ".join(a)), kmers(" ".join(a))) == 1
    swapped = " ".join(a[200:] + a[:200])
    assert jaccard(" ".join(a), swapped) > 0.9 and omh.aligned(kmers(" ".join(a)), kmers(swapped)) < 0.6
    repeated = kmers("tick tock " * 500)
    assert omh.aligned(repeated, repeated[:-100]) == (len(repeated) - 100) / len(repeated)


def test_sketch_in_column_blocks_equals_whole(monkeypatch):
    values = words.mixed(np.arange(1, 3000, dtype=np.uint64))
    whole = omh.two_smallest(values)
    monkeypatch.setattr(omh, "_COLUMNS", 7)
    assert all((a == b).all() for a, b in zip(whole, omh.two_smallest(values), strict=True))


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = pa.array(["Ab c, d'é x" + "y" * 700, "", "ab  C!", "z"])
    whole, at = words.lower_words(texts)
    assert at.tolist() == [0, 5, 5, 7, 8] and whole[0] == whole[5] and whole[1] == whole[6]
    monkeypatch.setattr(words, "BLOCK", 13)
    assert (words.lower_words(texts)[0] == whole).all()


def test_awkward_rows(spark):
    long = "a b c d e f g " * 9000
    texts = [None, "", "...", "one two", "One, two!", "one three", (None, "one two"), (4, "one two"), long, long + "h"]
    docs = documents(spark, texts)
    rows = sorted(((r.doc_id, r.text_id, r.class_id) for r in omh.classes(docs).collect()), key=repr)
    want = [(1, 1, 1), (2, 1, 1), (3, 3, 3), (4, 4, 4), (4, 4, 4), (5, 5, 4), (6, 6, 6), (9, 9, 9), (10, 10, 9), (None, None, None)]
    assert rows == sorted(want, key=repr)
    kept = omh.drop_near(clashing(docs))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 4, 6, 9, None])
    assert omh.classes(docs.where(F.lit(False))).count() == 0
