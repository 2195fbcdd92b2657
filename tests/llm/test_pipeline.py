import random

import tokenizers

import corpus_pipeline
from riskloom.llm import bpe
from riskloom.session import shared_dir


def test_stages_act_as_by_hand(spark):
    """A small corpus whose fate is known at each stage."""
    draw = random.Random(13)
    plain = lambda n: " ".join(draw.choice("tree house river stone bread light water garden".split()) + str(draw.randrange(999)) for _ in range(n)) + "."
    question = "the old miller counted every sack of flour twice before the morning bell rang over the valley"
    base = plain(200)
    good = [plain(60) for _ in range(120)]
    texts = dict(enumerate(good)) | {1000 + i: "BUY!! NOW!! " * 25 for i in range(40)}
    texts |= {2000: base, 2001: base, 2002: base.replace("tree", "shrub", 1), 2003: plain(30) + " " + question, 2004: plain(50)}
    folder = shared_dir(spark, "test_pipeline")
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 1000), 0) for i in texts if i < 2000 and i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, question)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "test_stage")
        assert docs.columns == columns
        kept[name] = {r.doc_id for r in docs.collect()}
    clean = {i for i in texts if i < 1000 or i >= 2000}
    assert kept["quality classifier"] == clean
    assert kept["exact dedup"] == clean - {2000}
    assert kept["near dedup"] == clean - {2000, 2002}
    assert kept["decontamination"] == clean - {2000, 2002, 2003}
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    result = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, folder).collect()}
    assert result == {i: len(library.encode(texts[i], add_special_tokens=False).ids) for i in kept["decontamination"]}
