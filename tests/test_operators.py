"""Aggregates against brute force, hot keys, nulls and plans."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom.functions import fixed
from riskloom.functions.scoring import enrich, severity
from riskloom.operators import history, exposure, keys, maps, quality, running, serving, thresholds
from tests.conftest import rows


@pytest.fixture(scope="module")
def lookup(spark):
    """Lookup-shaped rows with repeats, nulls in every key and one hot vendor, record and pair."""
    rnd = random.Random(5)
    data = []
    for i in range(1500):
        hot = i % 3 == 0
        v = "hot" if hot else rnd.choice(["a", "b", "c", None])
        p = "hot" if hot and i % 2 else rnd.choice(["p", "q", "r", None])
        c = "CVE-hot" if i % 5 == 0 else rnd.choice([f"CVE-{n}" for n in range(40)] + [None])
        vec = "/".join(["CVSS:3.1", "AV:" + rnd.choice("NL"), "PR:" + rnd.choice("NLH"), "UI:" + rnd.choice("NR"), "S:" + rnd.choice("CU"), "C:" + rnd.choice("HL")])
        data.append((v, p, c, dt.datetime(2024, rnd.randint(1, 3), rnd.randint(1, 5)), rnd.choice([None, 0.0, 3.9, 4.0, 7.5, 9.1]), vec, "3.1"))
    df = spark.createDataFrame(data, "vendor string, product string, cveId string, datePublished timestamp, cvssScore double, vectorString string, cvssVersion string")
    return enrich(df.withColumn("severity", severity("cvssScore", ""))).cache()


def brute(records, level):
    """Measures straight from their definition."""
    def n(test, key):
        return len({key(r) for r in records if test(r) and key(r) is not None})

    def pair(r):
        parts = [r.cveId, r.vendor, r.product] if level == "global" else [r.cveId, r.product]
        return None if None in parts else tuple(parts)

    tests = {f"{s}_count": (lambda r, s=s: r.severity == s.capitalize()) for s in fixed.SEVERITIES}
    tests |= {f"{g}_cves": (lambda r, g=g: r["is_network_based" if g == "network" else f"is_{g}"]) for g in fixed.RISK_GROUPS}
    out = {
        "exposure_index": round(float(sum(r.weighted_score for r in records)) + 1e-9, 2),
        "distinct_cves": n(lambda r: True, lambda r: r.cveId),
    }
    for name, t in tests.items():
        out["distinct_" + name] = n(t, lambda r: r.cveId)
        if level != "product":
            out[name] = n(t, pair)
    if level != "product":
        out["total_cves"] = n(lambda r: True, pair)
        out["affected_products"] = n(lambda r: True, lambda r: r.product)
    if level == "global":
        out["affected_vendors"] = n(lambda r: True, lambda r: r.vendor)
    return out


@pytest.mark.parametrize("level", fixed.LEVELS)
def test_measures(lookup, level):
    groups = {}
    dims = exposure.LEVEL_KEYS[level]
    for r in lookup.collect():
        groups.setdefault((r.datePublished.date().replace(day=1), *[r[k] for k in dims]), []).append(r)
    got = exposure.level_table(lookup, "monthly", level).collect()
    assert len(got) == len(groups)
    for g in got:
        want = brute(groups[(g.month_date, *[g[k] for k in dims])], level)
        assert {k: g[k] for k in want} == pytest.approx(want), g


@pytest.mark.parametrize("level", fixed.LEVELS)
def test_unique_input_needs_one_shuffle_less(lookup, level):
    one = keys.first_per_key(lookup, fixed.RECORD_KEY, [F.col("datePublished"), F.col("cvssScore"), F.col("vectorString")]).cache()
    fast, slow = (exposure.level_table(one, "monthly", level, unique=u) for u in (True, False))
    assert rows(fast) == rows(slow)

    def exchanges(df):
        return df._jdf.queryExecution().sparkPlan().toString().count("HashAggregate")

    assert exchanges(fast) < exchanges(slow)


def test_first_row_is_limited_before_the_shuffle(lookup):
    plan = keys.latest_per_key(lookup, fixed.RECORD_KEY, ["datePublished"], ["cvssScore"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_prefix_sum_with_and_without_buckets(spark):
    rnd = random.Random(1)
    data = [("hot" if i % 3 else f"k{i % 7}", i, rnd.randint(-5, 9)) for i in range(900)] + [(None, i, 1) for i in range(5)]
    df = spark.createDataFrame(data, "k string, i int, v int")
    plain = running.prefix_sum(df, ["k"], ["i"], F.col("v"), "s", total="t")
    split = running.prefix_sum(df, ["k"], ["i"], F.col("v"), "s", F.floor(F.col("i") / 50), total="t")
    assert rows(plain) == rows(split)
    sums, want = {}, []
    for k, i, v in data:
        sums[k] = sums.get(k, 0) + v
        want.append((k, i, sums[k]))
    assert rows(split, "k", "i", "s") == sorted(want, key=repr)
    assert {(r.k, r.t) for r in split.collect()} == set(sums.items())


def test_batches_are_full(spark):
    df = spark.range(1003).select(F.col("id").cast("string").alias("a"))
    sizes = sorted(r["count"] for r in running.batch_rows(df, ["a"], 10, per_bucket=16).groupBy("batch").count().collect())
    assert sizes == [3] + [10] * 100


def test_percentiles(spark):
    rnd = random.Random(2)
    values = {"a": [round(rnd.expovariate(0.01), 2) for _ in range(501)], "b": [0.0] * 9 + [5.0], "c": [-3.0, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("a", None)], "level string, exposure_index double")
    for r in thresholds.thresholds(df, F.lit(None).cast("timestamp")).collect():
        s = sorted(values[r.level])
        pick = [s[max(0, math.ceil(len(s) * q) - 1)] for q in (0.25, 0.5, 0.75)]
        assert [r.p25, r.p50, r.p75] == pick and (r.min_val, r.max_val, r.total_count) == (s[0], s[-1], len(s))
        assert r.high_threshold == math.ceil(pick[2])
    approx = {r.level: r for r in thresholds.thresholds(df, F.lit(None).cast("timestamp"), approximate=True).collect()}
    assert approx["b"].p50 == 0.0 and approx["a"].total_count == 501


def test_null_profile(spark):
    df = spark.createDataFrame([(None, 1), ("x", None), (None, None)], "a string, b int")
    stamp = F.lit("2024-01-01 10:00:00").cast("timestamp")
    r = quality.null_profile(df, ["a", "b"], "t", stamp).first()
    assert (r.totalRecords, r.aNulls, r.bPercentNull, r.aPercentNull) == (3, 2, 66.67, 66.67)
    empty = quality.null_profile(df.where("false"), ["a"], "t", stamp).first()
    assert (empty.totalRecords, empty.aNulls, empty.aPercentNull) == (0, 0, 0.0)


def test_observed_rows(spark):
    df, seen = quality.watch_rows(spark.range(7), "n")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7


def test_packed_map_splits_a_hot_pair(spark):
    edges = spark.range(1000).selectExpr("IF(id % 3 > 0, 'hot', 'v' || id) AS vendor", "'p' AS product", "'CVE-' || id AS cveId")
    packed = maps.pack(edges, 100).cache()
    assert packed.where("vendor = 'hot'").count() == 7
    assert packed.agg(F.max(F.size("cves"))).first()[0] < 200
    assert rows(packed.selectExpr("vendor", "product", "explode(cves)")) == rows(edges)


def test_diff_builds(spark):
    s = "vendor string, product string, cveId string, source string"
    old = spark.createDataFrame([("a", "p", "1", "n"), ("b", "p", "1", "n"), ("c", "p", "1", "n"), ("gone", "p", "9", "n"), ("m", "p", "7", "n"), ("x", "p", "1", "n")], s)
    new = spark.createDataFrame([("a", "p", "1", "n"), ("b", "p", "1", "n"), ("b", "p", "2", "n"), ("fresh", "p", "3", "n"), ("m", "p", "7", "n"), ("x", "p", "1", "c"), ("c", "p", "2", "n")], s)
    touched = spark.createDataFrame([("7",), ("9",)], "cveId string")
    assert [r[0] for r in rows(maps.diff_builds(new, old, touched), "vendor")] == ["b", "c", "fresh", "gone", "m", "x"]


def test_pick_build(spark):
    now = dt.datetime(2024, 1, 31)
    hours = {"far": [1, 24, 80, 200], "near": [1, 24], "one": [5]}
    meta = spark.createDataFrame([(c, now - dt.timedelta(hours=h), 1) for c, hs in hours.items() for h in hs], "collection string, ts timestamp, count long")
    two = meta.where("collection <> 'one'")
    got = {r.collection: r for r in maps.pick_build(two, F.lit(now).cast("timestamp"), 72.0).collect()}
    assert got["far"].previous_ts == now - dt.timedelta(hours=80) and got["far"].newest_ts == now - dt.timedelta(hours=1)
    assert got["near"].previous_ts == now - dt.timedelta(hours=24)
    with pytest.raises(Exception, match="need two builds for one"):
        maps.pick_build(meta, F.lit(now).cast("timestamp"), 72.0).collect()


@pytest.mark.parametrize("grain", fixed.GRAINS)
@pytest.mark.parametrize("level", fixed.LEVELS)
def test_level_of_sums_equals_level_table(lookup, grain, level):
    """Nulls in keys and dates, a hot vendor and record; daily and monthly tables of some months only."""
    one = keys.first_per_key(lookup, fixed.RECORD_KEY, [F.col("datePublished"), F.col("cvssScore"), F.col("vectorString")])
    one = one.withColumn("datePublished", F.expr("IF(cveId = 'CVE-7', NULL, datePublished)")).cache()
    own = F.coalesce(F.month("datePublished") != 2, F.lit(True))
    facts = exposure.day_facts(one, own)
    got = exposure.level_of_sums(exposure.day_sums(facts), exposure.record_counts(facts), grain, level)
    want = exposure.level_table(one if grain == "yearly" else one.where(own), grain, level, unique=True)
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want) and got.count() > 1


def test_record_counts_group_no_record_twice(lookup):
    """Facts are placed twice, by record and vendor and by record; grains and levels don't place them again."""
    plan = exposure.record_counts(exposure.day_facts(lookup))._jdf.queryExecution().executedPlan().toString()
    placed = [line for line in plan.splitlines() if "Exchange hashpartitioning(cveId" in line]
    assert len(placed) <= 4 and sum("_g#" in line for line in placed) == 0  # the first placing, twice planned, is run once


def test_serving_layouts():
    assert len(serving.serving_tables()) == 20
    time, dims = serving.layout("daily_vendor_running")
    assert time == "date_published" and dims["cumulative_exposure_index"] == "double" and dims["vendor"] == "string"
    assert serving.layout("exposure_index_thresholds")[1]["low_threshold"] == "bigint"
    assert "affected_vendors" in serving.layout("monthly_global")[1] and "affected_products" not in serving.layout("yearly_product")[1]


def test_no_plan_collects_a_level_in_one_task(lookup):
    """Level tables never funnel rows through a single partition."""
    for level in fixed.LEVELS:
        plan = exposure.level_table(lookup, "daily", level)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("share", [0.2, 1e-4, 2.0])
def test_hot_join(spark, how, share):
    left = spark.range(600).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 AND id < 300 THEN NULL ELSE 'k' || id % 50 END AS k", "id AS v")
    right = spark.range(30).selectExpr("IF(id = 0, 'hot', 'k' || id) AS k", "id AS w")
    assert rows(keys.hot_join(left, right, ["k"], how, share)) == rows(left.join(right, ["k"], how))


def test_hot_join_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    right = spark.createDataFrame([(None, 7)], "k string, w int")
    for share in (1e-4, 2.0):
        assert rows(keys.hot_join(left, right, ["k"], "left", share)) == [("a", 3, None), (None, 1, 7), (None, 2, 7)]
    assert {r.v: r.repeated for r in keys.mark_duplicates(left, ["k"]).collect()} == {1: True, 2: True, 3: False}
    assert rows(keys.duplicate_keys(left, ["k"])) == [(None,)]


def test_hot_join_deals_hot_rows_and_broadcasts_keys_only(spark):
    """Hot rows go to several tasks, and no column of the right side is broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(4000).selectExpr("0 AS k", "id AS v")
        right = spark.range(5).selectExpr("id AS k", "'wide' AS w")
        joined = keys.hot_join(left, right, ["k"], "inner")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1
        broadcasts = [line for line in plan.splitlines() if "BroadcastExchange" in line]
        assert broadcasts and not any("w#" in line for line in broadcasts)
        assert joined.count() == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_collect_distinct_keeps_every_key(spark):
    data = [("a", ["x", "y"], []), ("a", ["y"], None), ("b", [], None), ("c", None, ["z"]), (None, ["n"], ["m"]), (None, None, ["m"])]
    df = spark.createDataFrame(data, "k string, p array<string>, q array<string>")
    got = {r.k: (r.one, r.two) for r in keys.collect_distinct(df, ["k"], {"one": "p", "two": "q"}).collect()}
    assert got == {"a": (["x", "y"], []), "b": ([], []), "c": ([], ["z"]), None: (["n"], ["m"])}


def test_warehouse_sync_keeps_long_keys_apart(spark):
    long = "x" * 1024
    df = spark.createDataFrame([(long + "1", 1), (long + "2", 2), ("short", 3)], "vendor string, n int").withColumn("currentFlag", F.lit(True))
    assert rows(history.sync_full(df, ["vendor"]), "n") == [(3,)]
    assert rows(history.sync_rejects(df, ["vendor"]), "n") == [(1,), (2,)]
