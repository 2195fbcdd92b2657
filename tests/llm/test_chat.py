import random

from pyspark.sql import functions as F

from riskloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(spark, talks):
    return spark.createDataFrame([(c, i, r, t) for c, turns in talks.items() for i, (r, t) in enumerate(turns)], SCHEMA)


def brute(talks):
    kept = {}
    for c, turns in sorted(talks.items()):
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in talks.values()):
            continue
        kept.setdefault(tuple(turns), []).append(c)
    return {min(c): (len(c), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)) for turns, c in kept.items()}


def test_snapshots_collapse_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)
    draw = random.Random(7)
    talks = {}
    for c in range(150):
        if talks and draw.random() < 0.6:
            old = draw.choice(list(talks.values()))
            turns = old[: draw.randint(1, len(old))] + [("user", str(draw.randint(0, 2))) for _ in range(draw.randint(0, 2))]
        else:
            turns = [(draw.choice(["user", "assistant"]), str(draw.randint(0, 3))) for _ in range(draw.randint(1, 9))]
        talks[c] = turns
    rows = conversations(spark, talks).withColumn("length", F.lit("x")).withColumn("block", F.lit("y")).repartition(4)
    got = {}
    for r in sorted(chat.format_chats(rows).collect(), key=lambda r: (r.conv_id, r.part)):
        n, text = got.get(r.conv_id, (r.n_equal, ""))
        got[r.conv_id] = (n, text + r.rendered)
    assert got == brute(talks)


def test_nulls_gaps_and_repeats(spark):
    rows = [(1, None, None, None), (1, 5, "user", "a<|im_end|>b"), (1, 5, "user", "a<|im_end|>b"), (None, 0, "user", "x"), (2, 0, "user", "")]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, SCHEMA)).where("n_turns > 0").collect()}
    assert set(got) == {1, 2}
    text = "".join(r.rendered for r in sorted(chat.format_chats(spark.createDataFrame(rows, SCHEMA)).where("conv_id = 1").collect(), key=lambda r: r.part))
    assert text == "<|im_start|>unknown\n<|im_end|>\n<|im_start|>user\na< |im_end|>b<|im_end|>\n"
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_positions_cut_blocks_whatever_the_turns_are(spark, monkeypatch):
    """Time stamps, equal and null turns: parts hold BLOCK turns each, and equal the sorted turns."""
    monkeypatch.setattr(chat, "BLOCK", 4)
    draw = random.Random(8)
    rows = [(1, 1_700_000_000_000 + 977 * i, "user", f"t{i}") for i in range(30)]
    rows += [(2, None, "user", f"n{draw.random()}") for _ in range(50)] + [(3, 7, None, f"e{i % 9}" * 40) for i in range(40)]
    rows += [(4, -1, "user", "x")]
    got = {}
    for r in chat.format_chats(spark.createDataFrame(rows + rows[:20], SCHEMA).repartition(7)).collect():
        got.setdefault(r.conv_id, {})[r.part] = r
    for c in (1, 2, 3, 4):
        said = sorted({(t if t is not None else -(2**63), r or "unknown", x) for i, t, r, x in rows if i == c})
        parts = [got[c][k] for k in range(len(got[c]))]
        assert [p.n_turns for p in parts] == [min(4, len(said) - k) for k in range(0, len(said), 4)]
        assert {p.length for p in parts} == {len(said)}
        assert "".join(p.rendered for p in parts) == "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for _, r, x in said)


def test_one_conversation_over_several_ranges(spark, monkeypatch):
    """The ranges of a long conversation are numbered on; its snapshots still collapse."""
    monkeypatch.setattr(chat, "BLOCK", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        long = [(1, None, "user", f"{i:05d}") for i in range(900)]
        rows = spark.createDataFrame(long + [(2, *r[1:]) for r in long[:500]] + [(3, *r[1:]) for r in long[100:]], SCHEMA)
        placed = chat.positions(rows.select("conv_id", "turn", "role", "text")).where("conv_id = 1").collect()
        assert sorted((r.position, r.text) for r in placed) == [(i + 1, f"{i:05d}") for i in range(900)]
        got = chat.format_chats(rows).groupBy("conv_id").agg(F.sum("n_turns").alias("n")).collect()
        assert {r.conv_id: r.n for r in got} == {1: 900, 3: 800}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
