import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import lm_scoring as lm
from tests.llm.helpers import clashing, documents


@pytest.fixture(autouse=True)
def quick(monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 60)


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def brute(rows):
    seen = Counter()
    for i, t in rows:
        if not held(i):
            seen.update(tokens(t))
    total, each = sum(seen.values()), math.log10(sum(seen.values()) + len(seen) + 1)
    return [(i, held(i), len(tokens(t)), sum(seen[w] > 0 for w in tokens(t)), total, round(sum(math.log10(seen[w] + 1) - each for w in tokens(t)), 6)) for i, t in rows]


def corpus(n=300):
    draw = random.Random(11)
    out = []
    for i in range(n):
        lang = draw.choice(["xa", "yb"])
        out.append((i, " ".join(f"{lang}{int(draw.expovariate(0.02))}" for _ in range(draw.randint(1, 60)))))
    return out


@pytest.mark.parametrize("head", [5, 100_000])
def test_base_scores_match_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    monkeypatch.setattr(lm, "COUNTED", 50)
    rows = corpus() + [(None, "xa1 new"), (900, None), (901, ""), (902, "A\x0bB\xa0c d \x1c"), (3, "xa1 xa1"), (903, "w" * 90 + " " + "w" * 90)]
    got = lm.score(clashing(documents(spark, rows)).repartition(5)).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == Counter(brute(rows))
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_the_model_beats_counts_on_held_out_texts(spark):
    got = [r for r in lm.score(documents(spark, corpus(600))).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 0.04 * sum(r.n_tokens for r in got)


def test_probabilities_are_normalised_and_follow_the_pairs():
    draw = np.random.default_rng(12)
    truth = draw.dirichlet(np.full(12, 0.3), 12)
    table = lm.train(draw.poisson(truth * 30_000).astype(float), steps=300)
    assert np.allclose((10**table.astype(float)).sum(1), 1, atol=1e-5)
    assert np.abs(10**table - truth).mean() < 0.02


def test_shares_of_a_class_add_up():
    head = [f"t{k}".encode() for k in range(lm.WORDS + 30)]
    number = np.arange(len(head), 0, -1)
    mass = np.zeros(lm.SYMBOLS)
    for t, n in zip(head[lm.WORDS :], number[lm.WORDS :].tolist(), strict=True):
        mass[lm.class_of(t)] += n + 1
    counts = lm.Counts(1, 1, 1, head, number, mass)
    for k in set(counts.symbol()[lm.WORDS :].tolist()):
        own = counts.symbol() == k
        assert np.isclose(((number[own] + 1) / (mass[k] + 1)).sum() + 1 / (mass[k] + 1), 1)


def test_class_masses_from_the_table_match_brute_force(spark):
    rows = corpus(200)
    seen = Counter()
    for _, t in rows:
        seen.update(tokens(t))
    counted = lm.token_counts(documents(spark, rows).select("text")).cache()
    assert {bytes(r.token): r.n for r in counted.collect()} == dict(seen)
    counts = lm.summarize(counted)
    mass = np.zeros(lm.SYMBOLS)
    for t, n in seen.items():
        if t and t not in counts.head[: lm.WORDS]:
            mass[lm.class_of(t)] += n + 1
    assert np.allclose(mass, counts.mass) and counts.total == sum(seen.values()) and counts.distinct == len(seen)


def test_without_training_texts(spark):
    alone = next(i for i in range(100) if held(i))
    row = lm.score(documents(spark, [(alone, "a b")])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert lm.score(documents(spark, ["a"]).where(F.lit(False))).count() == 0
