import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from riskloom.llm import bpe, token_counts
from tests.llm.helpers import clashing, documents


def brute(spans, sections, rule):
    counts, outside, crossing = [0] * len(sections), 0, 0
    for a, b in spans:
        owner = [next((k for k in reversed(range(len(sections))) if sections[k][0] <= c < sections[k][1]), -1) for c in range(a, b)]
        crossing += owner[0] != owner[-1]
        k = {"first": owner[0], "last": owner[-1], "most": max(dict.fromkeys(owner), key=owner.count)}[rule] if owner[0] != owner[-1] else owner[0]
        if k < 0:
            outside += 1
        else:
            counts[k] += 1
    return counts, outside, crossing


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution_matches_brute_force(rule):
    draw = np.random.default_rng(3)
    for _ in range(300):
        cuts = np.sort(draw.choice(60, 12, replace=False))
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        edges = np.sort(draw.choice(64, 8, replace=False))
        sections = list(zip(edges[::2].tolist(), edges[1::2].tolist())) if draw.random() < 0.5 else list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        arrays = [np.array([s[i] for s in part]) for part in (spans, sections) for i in (0, 1)]
        counts, outside, crossing = token_counts.attributed(*arrays, rule)
        assert (counts.tolist(), outside, crossing) == brute(spans, sections, rule)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_inside_one_another(rule):
    draw = np.random.default_rng(4)
    for _ in range(300):
        cuts = np.sort(draw.choice(60, 12, replace=False))
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        sections = sorted((a, a + int(draw.integers(0, 30))) for a in draw.integers(0, 50, draw.integers(1, 8)).tolist())
        arrays = [np.array([s[i] for s in part]) for part in (spans, sections) for i in (0, 1)]
        counts, outside, crossing = token_counts.attributed(*arrays, rule)
        assert (counts.tolist(), outside, crossing) == brute(spans, sections, rule)
    counts, outside, _ = token_counts.attributed(np.array([50]), np.array([51]), np.array([0, 10]), np.array([100, 20]), rule)
    assert (counts.tolist(), outside) == ([1, 0], 0)


def test_character_spans_match_the_library():
    library, vocabulary = tokenizers.Tokenizer.from_file(bpe.default_path()), bpe.Vocabulary.read(bpe.default_path())
    encoder, decoder = bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)
    for text in ("Hello wörld", "naïve 🤗 日本語 x", "a\n\nb  c"):
        start, end = token_counts.character_spans(text.encode(), decoder.lengths(encoder.encode(text)))
        covered = "".join(text[a:b] for a, b in library.encode(text, add_special_tokens=False).offsets)
        assert len(covered) >= 1 and start[0] == 0 and end[-1] == len(text)
        assert list(zip(start.tolist(), end.tolist()))[0] == library.encode(text, add_special_tokens=False).offsets[0]


def test_fields_add_up(spark):
    texts = ["Title\nbody one\na | b | c\n\n\nend", None, "", (None, "only"), "x\n" * 3000, (1, "again | y")]
    rows = token_counts.by_field(clashing(documents(spark, texts))).collect()
    assert len(rows) == 3 * len(texts)
    total = {}
    for r in rows:
        n, doc, chars = total.get((r.doc_id, r.doc_tokens), (0, r.doc_tokens, 0))
        total[r.doc_id, r.doc_tokens] = (n + r.n_tokens, doc, chars + r.n_chars)
    assert all(n == doc for n, doc, _ in total.values())
    first = {r.field: r for r in rows if r.doc_id == 1 and r.n_sections and r.doc_tokens > 8}
    assert (first["table"].n_sections, first["body"].n_sections) == (1, 4)
    assert sum(r.n_chars for r in rows if r.doc_id == 5) == 6000
    assert token_counts.by_field(documents(spark, ["a"]).where(F.lit(False))).count() == 0


def test_without_sections_all_tokens_are_outside(spark):
    docs = spark.createDataFrame([(1, "a b", None), (2, "a b", [])], "doc_id long, text string, s array<struct<start:int,end:int>>")
    assert [(r.n_tokens, r.n_outside, r.counts) for r in token_counts.count(docs, ["doc_id"], "s").collect()] == [(2, 2, []), (2, 2, [])]
    with pytest.raises(ValueError, match="rule"):
        token_counts.count(docs, ["doc_id"], "s", rule="middle")
