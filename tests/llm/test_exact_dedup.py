from collections import Counter

from pyspark.sql import functions as F

from riskloom.llm import exact_dedup
from tests.llm.helpers import clashing, documents


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""]) for i, t in rows)


ROWS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (None, "b"), (None, "c"), (None, "c"), (7, "d"), (7, "d"), (8, "x" * 200_000)]


def test_marks_match_brute_force_with_and_without_frequent_digests(spark):
    rows = ROWS + [(100 + i, "hot") for i in range(500)] + [(1000 + i, f"t{i % 40}") for i in range(200)]
    docs = clashing(documents(spark, rows)).repartition(5)
    for top in (1, 1000):
        got = exact_dedup.mark(docs, top=top).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == brute(rows)


def test_the_summary_finds_a_frequent_value(spark):
    keys = spark.range(20_000).selectExpr("cast(if(id % 4 = 0, -1, id) AS string) AS k").repartition(16)
    assert exact_dedup.frequent(keys, "k", 5, 256).collect()[0].k == "-1"


def test_one_row_of_each_text_stays(spark):
    docs = clashing(documents(spark, ROWS))
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter([(2, "a"), (4, ""), (5, "b"), (None, "c"), (7, "d"), (8, "x" * 200_000)])


def test_empty_table(spark):
    docs = documents(spark, ["a"]).where(F.lit(False))
    assert exact_dedup.mark(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0
