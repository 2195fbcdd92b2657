import random

from pyspark.sql import functions as F

from riskloom.llm import decontam
from tests.llm.helpers import clashing, documents

QUESTION = "Today John had 12 apples and then gave Mary 5 kg of them before lunch, how many apples are left"


def items(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts, 1)], "item_id long, text string, window string")


def test_finds_verbatim_and_reparameterised_questions(spark):
    texts = [
        "Long before. " + QUESTION + " and more text after it", QUESTION.replace("John", "Anna").replace("12", "7").replace("kg", "km"),
        QUESTION.replace("Mary", "John"), "Something else entirely, that shares no passage with any of the questions asked here",
        QUESTION.upper(), " ".join(QUESTION.split()[:9]), None, "", "word " * 100_000 + QUESTION,
    ]
    rows = {r.doc_id: r for r in decontam.report(clashing(documents(spark, texts)), items(spark, [QUESTION, None, "a b", QUESTION + " for the next day"])).collect()}
    assert {i for i, r in rows.items() if r.contaminated} == {1, 2, 5, 9}
    assert rows[1].item_id == 1 and rows[1].coverage == 1 and rows[1].n_items == 2
    assert (rows[1].reparameterised, rows[2].reparameterised) == (False, True)
    assert rows[4].n_items == 0 and rows[4].item_id is None


def test_matches_a_verbatim_search(spark):
    draw = random.Random(9)
    sentence = lambda n: " ".join(f"w{draw.randrange(3000)}" for _ in range(n))
    bench = [sentence(draw.randint(5, 40)) for _ in range(40)]
    texts = []
    for k in range(300):
        parts = [sentence(60), *([bench[k % 40]] if k % 3 == 0 else []), sentence(30)]
        texts.append(" . ".join(parts))
    got = {r.doc_id for r in decontam.report(documents(spark, texts).repartition(5), items(spark, bench)).where("contaminated").collect()}
    assert got == {i for i, t in enumerate(texts, 1) if any(b in t for b in bench)}


def test_rows_without_ids_and_empty_tables(spark):
    docs = documents(spark, [(None, QUESTION), (2, QUESTION), (2, QUESTION), (3, "clean text")])
    bench = items(spark, [QUESTION])
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in decontam.drop_contaminated(docs, bench).collect()) == [(False, 3), (True, 0)]
    assert decontam.drop_contaminated(clashing(docs), bench).columns == clashing(docs).columns
    assert decontam.report(docs, bench.where(F.lit(False))).where("contaminated").count() == 0
    assert decontam.report(docs.where(F.lit(False)), bench).count() == 0


def test_copies_in_capitals_and_in_small_letters(spark):
    names = "We saw Anna meet Bert while Carl and Dora told Emil that Fritz would visit Gerda before Hans came home"
    shout = "NO FOOD OR DRINK MAY BE TAKEN INTO THE READING ROOM AT ANY TIME"
    texts = [names.upper(), "Before it. " + names.upper() + " and after", shout.lower(), shout.title(), "AN ENTIRELY DIFFERENT LINE THAT IS ALSO WRITTEN IN CAPITALS THROUGHOUT"]
    assert found(spark, texts, [names, shout]) == {(1, 1), (2, 1), (3, 2), (4, 2)}


def found(spark, texts, bench):
    return {(r.doc_id, r.item_id) for r in decontam.matches(documents(spark, texts), items(spark, bench)).collect()}


def test_case_line_breaks_and_sentence_openers(spark):
    names = "We saw Anna meet Bert while Carl and Dora told Emil that Fritz would visit Gerda before Hans came home"
    shop = "Tom buys 3 apples at the small shop. Tom then gives away all of them except 2 today"
    wrapped = names.replace(" Anna", "\nAnna").replace(" Bert", ' "Bert').replace(" Carl", "\n(Carl").replace(" Dora", "\nDora").replace(" Fritz", "\nFritz").replace(" Hans", "\nHans")
    texts = [names.lower(), wrapped, shop.replace("Tom", "Ann").replace("3", "4"), "Anna and Bert live here, they say, and nothing more of it is known to us"]
    assert found(spark, texts, [names, shop]) == {(1, 1), (2, 1), (3, 2)}


def test_items_of_numbers_and_units(spark):
    bench = ["Anna 3 kg, Ben 4 kg, Carl 5 kg, Dora 6 kg", "What is 12 times 7", "1 2 3 5 8 13 21 34 55 89 144"]
    texts = ["before it " + b + " and after" for b in bench] + ["Anna 3 kg, Ben 9 kg", "What was 12 times 7"]
    assert found(spark, texts, bench) == {(1, 1), (2, 2), (3, 3)}


def test_long_runs_and_single_torn_slots(spark):
    long = " ".join(f"w{k}" for k in range(300))
    count = "then we counted 7 birds in the old tree near the house and after a while we saw 7 birds again in the same tree"
    quote = lambda n: "so it says: " + " ".join(long.split()[100 : 100 + n]) + " and so on"
    texts = [quote(20), quote(13), quote(12), count.replace("7", "9", 1), "nothing of it"]
    assert found(spark, texts, [long, count]) == {(1, 1), (2, 1), (4, 2)}
