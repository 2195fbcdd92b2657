"""Key filters, digests of builds, day parts, pruned partitions."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from riskloom.operators import exposure, history, joins, keyfilter, keys, maps, trailing
from riskloom.plans import upkeep_queries
from riskloom.session import shared_dir
from riskloom.sources.staged import stored
from tests.conftest import rows

RECORD = ("vendor string, product string, cveId string, datePublished timestamp_ntz, weighted_score double, severity string, "
          + ", ".join(f"{c} boolean" for c in exposure.RISK_COLUMNS.values()))


def final_plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("words", [1, 64, 1 << 16])
def test_filter_loses_no_match(spark, words):
    draw = random.Random(1)
    table = spark.createDataFrame([(draw.choice([None, "a", "b"]), draw.randrange(3000)) for _ in range(2000)], "k string, n int")
    wanted = spark.createDataFrame([("a", i) for i in range(0, 90)] + [(None, 7)], "k string, n long")  # other type
    near, rest = keyfilter.split(table, wanted, ["k", "n"], words)
    assert near.columns == table.columns
    assert rows(near.unionByName(rest)) == rows(table)
    want = {tuple(r) for r in wanted.collect()}
    assert not want & {tuple(r) for r in rest.collect()}
    if words > 64:
        assert near.count() < 200
    assert keyfilter.may_match(table, wanted.where("false"), ["k", "n"], words).count() == 0
    assert keyfilter.key_filter(table, ["k", "n"], dict(table.dtypes), words).count() <= words


def test_search_filters_documents_before_the_shuffle(spark):
    edges = stored(spark.range(5000).selectExpr("'v' || id % 50 AS vendor", "'p' AS product", "'C' || id AS cveId"), "map")
    docs = stored(spark.range(5000).selectExpr("'C' || id AS cveId", "id AS x"), "documents")
    wanted = spark.createDataFrame([("v3", "p"), ("v3", "p"), ("nobody", "p"), (None, None)], "vendor string, product string")
    found = joins.search(wanted, {"nvd": edges, "cvelist": edges.where("false")}, {"nvd": docs, "cvelist": docs})
    assert rows(found, "source", "vendor", "x") == sorted([("nvd", "v3", i) for i in range(3, 5000, 50)], key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_bits" in plan and "strategy=broadcast" in plan


def test_merge_with_filter_equals_brute_force(spark):
    draw = random.Random(2)
    old = {k: draw.choice([None, 1, 2]) for k in range(0, 400)}
    new = {k: draw.choice([None, 1, 2]) for k in draw.sample(range(0, 800), 60)}
    frame = lambda d: spark.createDataFrame(list(d.items()), "k int, x int")
    want = dict(old)
    for k, x in new.items():
        if k not in old or (x is not None and old[k] is not None and x != old[k]):
            want[k] = x
    target = stored(frame(old), "target")
    merged = history.merge_changed(target, frame(new), ["k"], ["x"], ["x"])
    assert {r.k: r.x for r in merged.collect()} == want and merged.count() == len(want)
    assert rows(history.merge_changed(target, frame(new).where("false"), ["k"], ["x"], ["x"])) == rows(target)
    assert rows(history.merge_changed(target.where("false"), frame(new), ["k"], ["x"], ["x"])) == rows(frame(new))
    # The rows that no source row can touch come from the table without an exchange.
    near, rest = keyfilter.split(target, frame(new), ["k"])
    side = rest._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in side and "BroadcastHashJoin" in side


def test_digests_find_changed_edges(spark):
    draw = random.Random(3)
    def build(n):
        return {(f"v{draw.randrange(4)}", f"p{draw.randrange(3)}", f"C{draw.randrange(300)}") for _ in range(n)}
    same = {("hot", "p", f"H{i}") for i in range(3000)}
    new, old = build(700) | same, build(700) | same | {("hot", "p", "gone")}
    frame = lambda s: stored(spark.createDataFrame(sorted(s), "vendor string, product string, cveId string"), "build")
    n, o = frame(new), frame(old)
    got = {tuple(r)[:3]: r.side for r in maps.changed_edges(n, o).collect()}
    assert got == {**{e: 1 for e in new - old}, **{e: 2 for e in old - new}}
    changed = maps.changed_buckets(n, o).where("vendor = 'hot'").collect()
    assert len(changed) == 1  # the other buckets of the hot pair are equal and stay where they are
    assert maps.changed_edges(n, n).count() == 0
    assert maps.changed_edges(n, n.where("false")).count() == len(new)


def records(spark, draw, n):
    made = []
    for _ in range(n):
        day = draw.choice([None, *[dt.datetime(2001, 1, 1) + dt.timedelta(draw.randrange(200), draw.randrange(86400))] * 20])
        flags = [draw.random() < 0.5 for _ in exposure.RISK_COLUMNS]
        made.append((draw.choice(["v1", "v2", None]), draw.choice(["p1", "p2", "p3", None]), draw.choice([None, *[f"C{draw.randrange(90)}"] * 30]),
                     day, draw.choice([None, draw.randrange(100) / 8]), draw.choice(["Critical", "High", "Medium", "Low", ""]), *flags))
    return stored(spark.createDataFrame(made, RECORD), "records")


@pytest.mark.parametrize("level", ["vendor", "product"])
def test_window_from_parts_equals_window_from_records(spark, level):
    df = records(spark, random.Random(4), 2500)
    as_of = F.lit(dt.date(2001, 6, 30))
    late = "coalesce(datePublished >= TIMESTAMP_NTZ'2001-05-01 00:00:00', cveId IS NULL)"
    parts = {lv: upkeep_queries.carried_parts(spark, df, lv, late).drop("month") for lv in ("product", "vendor")}
    for months in (1, 3, 12):
        want = exposure.trailing_table(df, months, level, as_of)
        got = trailing.trailing_from_parts(parts, months, level, as_of)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert rows(got) == rows(want)
    empty = {lv: trailing.day_parts(df.where("false"), trailing.record_ids(df.where("false"), lv), lv) for lv in parts}
    assert trailing.trailing_from_parts(empty, 1, level, as_of).count() == 0


def test_window_reads_parts_of_its_months_only(spark):
    df = records(spark, random.Random(5), 300)
    parts = upkeep_queries.carried_parts(spark, df, "product", "false")
    recent = parts.where(F.col("month") >= F.lit(dt.date(2001, 5, 1)))
    plan = trailing.trailing_from_parts({"product": recent}, 1, "product", F.lit(dt.date(2001, 6, 30)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "seen:bigint" in plan  # parts, no records
    assert re.search(r"PartitionFilters: \[[^]]*month", plan)


def test_numbers_have_no_gaps_and_stay(spark):
    df = records(spark, random.Random(6), 900)
    first = stored(trailing.record_ids(df.where("cveId < 'C5'"), "vendor"), "ids")
    more = stored(trailing.record_ids(df, "vendor", first), "ids")
    whole = first.unionByName(more)
    for r in whole.groupBy("vendor").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"), F.max("id").alias("m")).collect():
        assert r.n == r.d == r.m + 1
    assert whole.count() == df.where("cveId IS NOT NULL").select("vendor", "cveId").distinct().count()


def test_newest_partition_is_pruned_when_the_query_runs(spark):
    path = shared_dir(spark, "partitioned")
    spark.range(40).selectExpr("id", "CAST(id % 4 AS INT) AS year").write.partitionBy("year").parquet(path)
    newest = keys.latest_partition(spark.read.parquet(path), "year")
    assert rows(newest, "id") == sorted([(i,) for i in range(3, 40, 4)], key=repr)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("\n")[0]
    assert "year" in filters.split("]")[0] and "ubquery" in filters
