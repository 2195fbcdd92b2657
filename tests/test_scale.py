"""Work and files of registered queries that must not grow faster than their tables."""

import datetime as dt

import pytest

from riskloom.functions import fixed
from riskloom.operators import keys
from riskloom.plans import queries as registry, upkeep_queries
from riskloom.sources import sinks
from riskloom.sources.staged import stored
from tests.conftest import rows


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """Folder with a small lineitem table."""
    folder = tmp_path_factory.mktemp("lines")
    made = [
        (k // 5, k % 9, k % 4, k % 7 + 1, float(k % 50), 10.0 * k, (k % 10) / 100, 0.03, "RAN"[k % 3], "OF"[k % 2],
         dt.datetime(1999 + k % 3, 1 + k % 12, 1 + k % 28))
        for k in range(200)
    ]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"
    df = spark.createDataFrame(made, names + ", l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    df.coalesce(2).write.parquet(str(folder / "lineitem.parquet"))
    return str(folder)


def optimized(df) -> str:
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_compressed_and_bounded(spark, tmp_path):
    df = spark.createDataFrame([(i, "x" * 500, "ab"[i % 2]) for i in range(20)], "i int, text string, v string")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    sinks.write_documents(df.coalesce(1), str(tmp_path / "d"), ["v"], per_file=4)
    files = list((tmp_path / "d").glob("v=*/*.json.gz"))
    assert len(files) == 6 and len(list((tmp_path / "d").glob("v=*/*.json"))) == 0
    assert sum(f.stat().st_size for f in files) < 20 * 500 / 4
    back = spark.read.schema(df.schema).json(str(tmp_path / "d"))
    assert rows(back, *df.columns) == rows(df)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_documents_read_back_from_archives(spark, lines, monkeypatch):
    written = []
    monkeypatch.setattr(sinks, "write_documents", lambda *a, real=sinks.write_documents: (written.append(a[1]), real(*a)))
    assert registry.QUERIES["src2_read_ingest_documents"](spark, lines).count() == 200
    assert len(written) == 1


def test_shards_grow_with_the_rows(spark, tmp_path):
    df = spark.range(20)
    sinks.write_ndjson_shards(df, str(tmp_path / "few"), 3, per_file=10)
    sinks.write_ndjson_shards(df, str(tmp_path / "many"), 3, gzip=True, per_file=4)
    assert [len(list((tmp_path / n).glob("part-*"))) for n in ("few", "many")] == [3, 5]
    assert rows(spark.read.schema("id long").json(str(tmp_path / "many"))) == rows(df)


@pytest.mark.parametrize("name", ["nst2_cna_adp_cvss", "nst3_collect_cwe_cna"])
def test_documents_are_parsed_once(spark, lines, name):
    assert optimized(registry.QUERIES[name](spark, lines)).count("from_json(") == 1


def test_carried_windows_write_touched_months_only(spark):
    cols = "vendor string, product string, cveId string, datePublished timestamp_ntz, severity string, weighted_score double"
    flags = "".join(f", {f} boolean" for f in fixed.RISK_FLAGS)
    made = [
        ("v", f"p{k % 3}", f"C{k}", dt.datetime(2001, 1 + k % 6, 1 + k % 28), "High", 1.0, *[k % 2 == 0] * len(fixed.RISK_FLAGS))
        for k in range(300)
    ]
    df = spark.createDataFrame(made, cols + flags).repartition(4)
    after = upkeep_queries.carried_parts(spark, df, "vendor", "datePublished >= DATE'2001-06-10'")
    folders = {}
    for name in after.inputFiles():
        folder, month = name.split("/month=")
        folders.setdefault(month.split("/")[0], []).append(folder)
    # The first state has one file a month, the touched month one more, written later.
    assert {m: len(f) for m, f in folders.items()} == {f"2001-0{m}-01": 2 if m == 6 else 1 for m in range(1, 7)}
    assert len({f for m in range(1, 6) for f in folders[f"2001-0{m}-01"]}) == 1
    assert after.where("word IS NULL").count() == df.selectExpr("to_date(datePublished)").distinct().count()


@pytest.mark.parametrize("grain, level", [("daily", "vendor"), ("monthly", "global")])
def test_refreshed_levels_sort_and_count_rows_that_were_dealt_out(spark, lines, grain, level):
    plan = optimized(registry.QUERIES[f"cdc7_refresh_levels_{grain}_{level}"](spark, lines))
    # Both the rows of the old lookup and the affected rows after the change.
    assert plan.count("RebalancePartitions") >= 2


def test_sketches_do_not_parse_vectors(spark, lines, monkeypatch):
    plans = []
    monkeypatch.setattr(upkeep_queries, "stored", lambda df, name, real=upkeep_queries.stored: (plans.append(optimized(df)), real(df, name))[1])
    assert registry.QUERIES["agg11_thresholds_sketched"](spark, lines).count() == 9
    used = "".join(line for p in plans for line in p.split("\n") if "Relation [" not in line)
    assert "l_shipdate" in used and "l_returnflag" not in used  # of the columns read, only the flags need that one


def test_consolidate_reads_unique_keys_without_a_join(spark):
    """Without broadcasts, as over large tables: only rows that the key filter lets through are shuffled."""
    kind = "k int, n int, a array<struct<i:int,t:string>>"
    data = [(k, 1, [(2, "x"), (1, None), (2, "x")]) for k in range(50)] + [(7, 2, [(3, "z")]), (None, 1, [(1, "b")]), (None, 3, None)]
    big = stored(spark.createDataFrame(data, kind), "big")
    (path,) = {f.rpartition("/")[0].removeprefix("file://") for f in big.inputFiles()}
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "2000"}
    before = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        out = keys.consolidate_first(big, ["k"], ["n"], ["a"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.k: (r.n, [tuple(e) for e in r.a]) for r in out.collect()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert plan.count(path) == 1 and "LeftAnti" not in plan and "LeftSemi" not in plan
    assert len(got) == 51 and got[7] == (2, [(1, None), (2, "x"), (3, "z")])
    assert got[8] == (1, [(1, None), (2, "x")]) and got[None] == (3, [(1, "b")])
