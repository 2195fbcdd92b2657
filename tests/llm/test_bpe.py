import random

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from riskloom.llm import bpe
from tests.llm.helpers import clashing, documents


@pytest.fixture(scope="module")
def tools():
    vocabulary = bpe.Vocabulary.read(bpe.default_path())
    return bpe.Encoder(vocabulary), bpe.Decoder(vocabulary), tokenizers.Tokenizer.from_file(bpe.default_path())


def texts():
    draw = random.Random(4)
    bits = ["a", "b", " ", "\n", "\t", "ä", "the", "ing", "'s", "!!", "12", "<|endoftext|>", "　", "\x85", "\x1c", "🤗", "日本", "ha"]
    out = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 60))) for _ in range(1500)]
    out += ["a" * n for n in range(1, 90)] + ["x" * 30_000, " " * 5000, "ab" * 9000, ""]
    return out + ["".join(map(chr, range(c, c + 40))) for c in range(0, 0x3000, 40)]


def test_encodes_and_decodes_like_the_library(tools):
    encoder, decoder, library = tools
    for text in texts():
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text[:80]
        assert decoder.decode(ids) == text


def test_decodes_any_ids_like_the_library(tools):
    draw = random.Random(5)
    for _ in range(500):
        ids = [draw.randrange(50257) for _ in range(20)]
        assert tools[1].decode(np.array(ids)) == tools[2].decode(ids, skip_special_tokens=False)


def test_unknown_ids_are_skipped(tools):
    assert tools[1].decode(np.array([-1, 64, 10**6])) == tools[2].decode([64])


def test_bounded_tables_do_not_change_results(tools, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 3)
    monkeypatch.setattr(bpe, "PAIRS", 3)
    encoder = bpe.Encoder(tools[0].v)
    for text in texts()[:300]:
        assert encoder.encode(text).tolist() == tools[0].encode(text).tolist()


def test_query_keeps_every_row(spark, tools):
    docs = clashing(documents(spark, ["Hello world", None, "", (None, "no id"), (1, "Hello world"), "z" * 100_000]))
    rows = bpe.round_trip(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in rows) == [(False, 1, 2), (False, 1, 2), (False, 2, 0), (False, 3, 0), (False, 6, len(tools[2].encode("z" * 100_000).ids)), (True, 0, 2)]
    assert bpe.round_trip(docs.where(F.lit(False))).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, [64, None, 65])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in bpe.decode(rows, ["k"]).collect()} == {1: "", 2: "ab"}
