import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskloom.llm import quality
from tests.llm.helpers import clashing

SCHEMA = "doc_id long, text string, lang string, source string"


def corpus(spark, n=400):
    draw = random.Random(10)
    rows, labels = [], []
    for i in range(n):
        good = draw.random() < 0.8
        text = " ".join(draw.choice("tree house river stone bread light water garden".split()) + str(draw.randrange(99)) for _ in range(50)) + "."
        rows.append((i, text if good else "BUY!! NOW!! " * 30, draw.choice(["en", "fr"]), f"s{i % 7}"))
        labels.append((i, int(good)))
    return rows, labels


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark):
    rows, labels = corpus(spark)
    docs, known = frames(spark, rows, [x for x in labels if x[0] % 2])
    got = {r.doc_id: r.kept for r in quality.classify(clashing(docs), known).collect()}
    assert np.mean([got[i] == bool(q) for i, q in labels if i % 2 == 0]) > 0.98
    kept = quality.keep_good(clashing(docs), known)
    assert kept.columns == clashing(docs).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, k in got.items() if k}


def test_sites_shrink_as_by_hand(spark):
    """Rates of paths and hosts against the same formulas in plain Python."""
    rows, labels = corpus(spark, 120)
    docs, known = frames(spark, rows, labels)
    features = quality.feature_rows(docs)
    model = quality.train(features, known)
    got = {r.path: r for r in quality.sites(features, known, model).collect()}
    good = dict(labels)
    paths, hosts = {}, {}
    for i, _, lang, source in rows:
        for group, key in ((paths, f"{source}/{lang}"), (hosts, source)):
            n, s = group.get(key, (0, 0))
            group[key] = (n + 1, s + good[i])
    overall = (sum(s for _, s in hosts.values()) + 1) / (len(rows) + 2)

    def strength(groups):
        n = sum(g[0] for g in groups)
        spread = sum(g[0] * (g[1] / g[0] - g[2]) ** 2 for g in groups) - sum(g[2] * (1 - g[2]) for g in groups)
        scale = sum(g[0] * g[2] * (1 - g[2]) for g in groups) / n
        return min(quality.STRONGEST, max(quality.WEAKEST, scale / (spread / n) - 1)) if spread > 0 else quality.STRONGEST

    k = strength([(n, s, overall) for n, s in hosts.values()])
    rate = {h: (s + k * overall) / (n + k) for h, (n, s) in hosts.items()}
    k = strength([(n, s, rate[p.split("/")[0]]) for p, (n, s) in paths.items()])
    for p, (n, s) in paths.items():
        h = rate[p.split("/")[0]]
        assert np.isclose(got[p].host_rate, h) and np.isclose(got[p].path_rate, (s + k * h) / (n + k))


def test_a_sparse_site_moves_less_than_a_large_one(spark):
    rows = [(i, "some plain text here", "en", "big") for i in range(200)] + [(200 + i, "some plain text here", "en", "ok") for i in range(200)] + [(400, "some plain text here", "en", "tiny")]
    labels = [(i, 0) for i in range(200)] + [(200 + i, 1) for i in range(200)] + [(400, 0)]
    got = {r.doc_id: r for r in quality.classify(*frames(spark, rows, labels)).collect()}
    assert got[0].path_rate < got[400].path_rate < got[200].path_rate
    assert abs(got[0].path_rate) < 0.05


def test_awkward_rows(spark):
    rows, labels = corpus(spark, 60)
    rows += [(None, None, None, None), (1000, "", None, "s1"), (1001, "x" * 300_000, "en", None), rows[0]]
    docs, known = frames(spark, rows, labels + [(None, 1), (3, None), (4, 1), (4, 0)])
    got = quality.classify(docs, known).collect()
    assert len(got) == len(rows) and all(0 <= r.posterior <= 1 for r in got)
    assert quality.classify(docs.where(F.lit(False)), known).count() == 0
    assert quality.classify(docs, known.where(F.lit(False))).where("kept").count() == len(rows)


def test_features_do_not_depend_on_the_batch():
    texts = ["Ab c!! | 12\nx", "", "é é é", "word " * 2000]
    whole = quality.features(pa.array(texts))
    assert np.allclose(whole, np.concatenate([quality.features(pa.array([t])) for t in texts]))
    assert not whole[1].any()
