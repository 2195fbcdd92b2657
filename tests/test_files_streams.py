"""Readers, writers, maintenance and streams."""

import datetime as dt
import gzip
import json
import time

import pytest
from pyspark.sql import functions as F

from riskloom.operators.keys import latest_partition
from riskloom.sources import feeds, records, sinks
from riskloom.streaming import epss, kev, messages
from tests.conftest import rows


def test_ingest_documents_and_latest_folder(spark, tmp_path):
    for day, vendor in (("2024-01-01", "a"), ("2024-02-01", "b")):
        folder = tmp_path / day / vendor
        folder.mkdir(parents=True)
        with gzip.open(folder / "x.json.gz", "wt") as f:
            f.write(json.dumps({"vendor": vendor, "product": "p", "cveDataAvailable": True, "cvelistv5": [["CVE-1", {"a": 1}]]}))
    newest = records.latest_folder(spark, str(tmp_path))
    assert newest.endswith("2024-02-01")
    (r,) = records.read_ingest_documents(spark, newest + "/*/*.json.gz").collect()
    assert r.vendor == "b" and r.cvelistv5 == [["CVE-1", '{"a": 1}']]
    with pytest.raises(FileNotFoundError):
        records.latest_folder(spark, str(tmp_path / "2024-01-01"))


def test_latest_table_and_partition(spark):
    for day in ("2024_01_01", "2024_01_03"):
        sinks.save_table(spark.range(2), f"staging_{day}", mode="overwrite")
    sinks.save_table(spark.range(3), "staging_2024_01_03")
    assert records.latest_table(spark, r"^staging_\d{4}_\d{2}_\d{2}$") == "staging_2024_01_03"
    assert spark.table("staging_2024_01_03").count() == 5
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "d int, v string")
    assert rows(latest_partition(df, "d"), "v") == [("b",), ("c",)]


def test_cvelist_skips_broken_files(spark, tmp_path):
    (tmp_path / "2024" / "1xxx").mkdir(parents=True)
    (tmp_path / "2024" / "1xxx" / "CVE-2024-1.json").write_text('{"cveMetadata":\n {"cveId": "CVE-2024-1"}}')
    (tmp_path / "2024" / "CVE-2024-2.json").write_text("{broken")
    (tmp_path / "delta.json").write_text('{"cveMetadata": {"cveId": "no"}}')
    assert rows(records.read_cvelist(spark, str(tmp_path)), "cveMetadata.cveId") == [("CVE-2024-1",)]


def test_file_names(spark):
    df = spark.createDataFrame([("s3://b/acme_cve_tool_raw_2025-03-02_19-55-48.json",), ("s3://b/other.json",)], "source_file string")
    out = records.metadata_from_filename(df)
    assert rows(out, "vendor", "product", "ingestionTimestamp") == [("", "", None), ("acme", "tool", dt.datetime(2025, 3, 2, 19, 55, 48))]
    assert records.unreadable_names(out).first()[0] == 1


def test_gunzip(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    (src / "v").mkdir(parents=True)
    with gzip.open(src / "v" / "a.json.gz", "wt") as f:
        f.write('{"a": 1}\n{"a": 2}\n')
    (src / "w").mkdir()
    with gzip.open(src / "w" / "a.json.gz", "wt") as f:
        f.write('{"a": 3}\n')
    (src / "b.json.gz").write_bytes(b"\x1f\x8b not gzip")
    done = records.gunzip_files(spark, str(src), str(dst))
    assert rows(done, "file", "ok") == [("b.json", False), ("v/a.json", True), ("w/a.json", True)]
    assert rows(spark.read.json(f"{dst}/file=v%2Fa.json"), "a") == [(1,), (2,)]
    assert rows(spark.read.json(f"{dst}/file=w%2Fa.json"), "a") == [(3,)]


def test_epss_reader(spark, tmp_path):
    path = tmp_path / "epss.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("#model_version:v1\ncve,epss,percentile\nCVE-1,0.5,0.9\nCVE-2,bad,0.1\n")
    good, bad = feeds.read_epss(spark, str(path), F.lit("2024-01-01").cast("date"))
    assert rows(good) == [("CVE-1", 0.5, 0.9, dt.date(2024, 1, 1))]
    assert bad.count() == 1


def kev_file(folder, name, *items):
    doc = {"vulnerabilities": [{"cveID": c, "dateAdded": d, "product": p} for c, d, p in items]}
    (folder / name).write_text(json.dumps(doc, indent=1))


def test_kev_reader(spark, tmp_path):
    kev_file(tmp_path, "k.json", ("CVE-1", "2024-01-01", "x"), ("CVE-2", "2024-01-02", "y"))
    got = feeds.kev_rows(feeds.read_kev(spark, str(tmp_path)))
    assert rows(got, "cveId", "day", "notes") == [("CVE-1", dt.date(2024, 1, 1), None), ("CVE-2", dt.date(2024, 1, 2), None)]


def test_kev_lists(spark, tmp_path):
    """New entries only; the state is the last published list, so a returning entry is sent again."""
    lists, out, state, ck = (tmp_path / n for n in ("lists", "out", "state", "ck"))
    lists.mkdir()
    one, two, three = ("CVE-1", "d1", "a"), ("CVE-2", "d2", "b"), ("CVE-3", "d3", "c")
    for i, items in enumerate([(one, two), (one, two), (one, three), (one, two, three)]):
        kev_file(lists, f"{i}.json", *items)
        stream = spark.readStream.schema("vulnerabilities array<struct<cveID:string,vendorProject:string,product:string,vulnerabilityName:string,"
                                         "dateAdded:string,shortDescription:string,requiredAction:string,dueDate:string,knownRansomwareCampaignUse:string,notes:string>>")
        items_df = stream.option("multiLine", True).json(str(lists)).select(F.inline("vulnerabilities"))
        kev.kev_stream(items_df, str(out), str(state), str(ck)).awaitTermination()
        time.sleep(0.01)
    got = spark.read.parquet(str(out))
    assert rows(got, "cveId", "batch") == [("CVE-1", 0), ("CVE-2", 0), ("CVE-2", 3), ("CVE-3", 2)]
    again = spark.createDataFrame([(one[0], None, one[2], None, one[1], None, None, None, None, None)], feeds.fixed.KEV_ITEM_SCHEMA)
    before = rows(got)
    kev.publish_list(again, 9, str(out), str(state))
    assert rows(spark.read.parquet(str(out))) == before


def test_epss_replaced_only_when_changed(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def scores(*data):
        return spark.createDataFrame([(c, e, 0.1, dt.date(2024, 1, 1)) for c, e in data], "cveId string, epss double, percentile double, date date")

    assert epss.replace_scores(scores(("a", 0.1), ("b", 0.2)), out, state)
    assert not epss.replace_scores(scores(("b", 0.2), ("a", 0.1)), out, state)
    assert epss.replace_scores(scores(("a", 0.1), ("a", 0.1), ("b", 0.2)), out, state)
    assert epss.replace_scores(scores(("c", 0.3)), out, state)
    assert rows(sinks.read_version(spark, out), "cveId") == [("c",)]


def test_messages_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = "message_id string, body string, at timestamp"
    for bounded in (False, True):
        out, ck = str(tmp_path / f"out{bounded}"), str(tmp_path / f"ck{bounded}")
        for i, ids in enumerate((["a", "b", "a"], ["b", "c"])):
            lines = [json.dumps({"message_id": m, "body": m * 2, "at": "2024-01-01T00:00:00Z"}) for m in ids]
            (src / f"{bounded}-{i}.json").write_text("\n".join(lines))
            stream = messages.dedupe_messages(feeds.file_stream(spark, str(src), schema), time="at" if bounded else None)
            kev.append_stream(stream, out, ck).awaitTermination()
        assert rows(spark.read.parquet(out), "message_id", "body") == [("a", "aa"), ("b", "bb"), ("c", "cc")]


def test_csv_and_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, [("x", i)]) for i in range(20)], "a int, b array<struct<k:string,v:int>>")
    sinks.export_csv(df, str(tmp_path / "csv"), single_file=True)
    back = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "csv"))
    assert back.count() == 20 and back.where("a = '3'").first().b == '[{"k":"x","v":3}]'
    assert len(list((tmp_path / "csv").glob("part-*"))) == 1
    for gz in (False, True):
        path = tmp_path / f"nd{gz}"
        sinks.write_ndjson_shards(df, str(path), 3, gzip=gz)
        assert len(list(path.glob("part-*.gz" if gz else "part-*.txt"))) == 3
        assert rows(spark.read.schema(df.schema).json(str(path)), "a") == rows(df, "a")


def test_serving_export_by_day(spark, tmp_path):
    df = spark.createDataFrame([("daily_global", 5, 0.0, 1.0, 2.0, 3.0, 4.0, 1.0, 2.0, 3.0, dt.datetime(2024, 1, 2))],
                               "level string, total_count long, min_val double, p25 double, p50 double, p75 double, max_val double, "
                               "low_threshold double, med_threshold double, high_threshold double, run_ts timestamp")
    sinks.export_serving(df, "exposure_index_thresholds", str(tmp_path / "s"), by_day=True)
    (r,) = spark.read.parquet(str(tmp_path / "s")).collect()
    assert (r.rows, r.high_threshold, str(r.day)) == (1, 3, "2024-01-02")


def test_export_new_files(spark, tmp_path):
    table, out, state = (str(tmp_path / n) for n in ("t", "o", "s"))
    spark.range(3).write.parquet(table)
    with pytest.raises(RuntimeError, match="backfill"):
        sinks.export_new_files(spark, table, out, state, backfill=False)
    sinks.export_new_files(spark, table, out, state, backfill=True)
    sinks.export_new_files(spark, table, out, state, backfill=False)
    assert spark.read.parquet(out).count() == 3
    spark.range(3, 5).write.mode("append").parquet(table)
    sinks.export_new_files(spark, table, out, state, backfill=False)
    assert rows(spark.read.parquet(out)) == [(i,) for i in range(5)]


def test_overwrite_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string"), path, ["d"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, "b"), (8, "c")], "v int, d string"), path, ["d"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (8, "c"), (9, "b")]


def test_versions_and_compaction(spark, tmp_path):
    root, broken = str(tmp_path / "t"), str(tmp_path / "none")
    df = spark.range(1000).selectExpr("id", "id % 3 AS d")
    assert sinks.swap_table(df.repartition(20), root, ["d"]) == "v00000001"
    failed = sinks.compact(spark, {broken: [], root: ["d"]})
    assert list(failed) == [broken]
    assert sinks.versions(spark, root) == ["v00000001", "v00000002"]
    assert rows(sinks.read_version(spark, root), "id") == rows(df, "id")
    assert len(list((tmp_path / "t" / "v00000002").rglob("*.parquet"))) == 3
    for _ in range(3):
        sinks.swap_table(df, root)
    assert sinks.expire_versions(spark, root, keep=2) == ["v00000001", "v00000002", "v00000003"]
    assert sinks.read_version(spark, root).count() == 1000
