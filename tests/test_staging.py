"""Documents to staging, master and lookup rows."""

import json

import pytest

from riskloom.plans import staging
from riskloom.sources import records, sinks
from tests.conftest import rows

TS = "2025-03-02T19:55:48.000000+00:00"


def v31(score, vector="CVSS:3.1/AV:N"):
    return {"cvssV3_1": {"version": "3.1", "vectorString": vector, "baseScore": score}}


def cwe(i, lang="en", text="t"):
    return {"descriptions": [{"cweId": i, "description": text, "lang": lang, "type": "CWE"}]}


def cna(metrics=None, types=None, adp=None, texts=(("en", "cna"),), published="2024-01-02T03:04:05Z"):
    body = {"descriptions": [{"lang": a, "value": b} for a, b in texts]}
    if metrics is not None:
        body["metrics"] = metrics
    if types is not None:
        body["problemTypes"] = types
    body["impacts"] = [{"capecId": "CAPEC-1", "descriptions": [{"lang": "en", "value": "cap"}, {"lang": "fr", "value": "x"}]}]
    doc = {"cveMetadata": {"datePublished": published, "dateUpdated": "2024-02-01T00:00:00Z"}, "containers": {"cna": body}}
    if adp is not None:
        doc["containers"]["adp"] = adp
    return json.dumps(doc)


def nvd(metrics=None, texts=(("en", "<b>nvd</b> text"),), weak=None):
    doc = {"id": "x", "published": "2023-12-31T00:00:00.000", "lastModified": "2024-03-01T00:00:00.000", "vulnStatus": "Analyzed",
           "descriptions": [{"lang": a, "value": b} for a, b in texts]}
    if metrics is not None:
        doc["metrics"] = metrics
    if weak is not None:
        doc["weaknesses"] = [{"source": "s", "type": "P", "description": [{"lang": lang, "value": v} for lang, v in weak]}]
    return json.dumps(doc)


def metric(version, score, vector="v"):
    return {"source": "s", "type": "Primary", "cvssData": {"version": version, "vectorString": vector, "baseScore": score},
            "exploitabilityScore": 1.0, "impactScore": 2.0}


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    lines = [
        ("a", [[" cve-1é ", cna([v31(5.0)], [cwe("CWE-1")])]], [["CVE-1", nvd({"cvssMetricV2": [metric("2.0", 7.5)], "cvssMetricV31": [metric("3.1", 9.8), metric("3.1", 9.8)]}, weak=[("en", "CWE-79"), ("en", "NVD-CWE-noinfo"), ("fr", "CWE-2")])]]),
        ("b", [["CVE-2", cna([v31(5.0), {}], adp=[{"metrics": [v31(6.0)], "problemTypes": [cwe("CWE-3", "en-US", "adp")]}, {"metrics": [{}, v31(6.5)]}])]], []),
        ("c", [["CVE-3", cna([v31(4.0)], adp=[{"metrics": [v31(9.0)]}])]], []),
        ("d", [["CVE-4", cna(None, adp=[{"metrics": [v31(8.0)]}])]], []),
        ("e", [["CVE-5", cna(None, [cwe("CWE-1", text="a"), cwe("CWE-1", text="b")], published="bad")]], []),
        ("f", [], [["CVE-6", nvd(None, texts=(("fr", "non"),))]]),
        ("g", [], [["CVE-7", nvd({}, texts=(("en", "one"), ("en", "two")))]]),
        ("h", [["only-id"]], []),
    ]
    path = tmp_path_factory.mktemp("ndjson") / "batch.json"
    out = [json.dumps({"ingestionDate": "2025-03-02", "ingestionTimestamp": TS, "vendor": v, "product": "p", "cveDataAvailable": bool(c or n),
                       "cvelistv5": c, "fkie_nvd": n}) for v, c, n in lines]
    out += ["{broken", json.dumps({"vendor": "z", "product": "p", "cveDataAvailable": False, "cvelistv5": [], "fkie_nvd": []})]
    path.write_text("\n".join(out), encoding="utf-8")
    return staging.normalize(records.read_ingest_ndjson(spark, str(path))).cache()


def by(staged, vendor):
    return staged.where(f"vendor = '{vendor}'").collect()


def test_one_row_per_record(staged):
    assert [r[0] for r in rows(staged, "vendor")] == list("abcdefgh")


def test_both_sides_merge(staged):
    (r,) = by(staged, "a")
    assert r.cveId == "CVE-1"
    assert sorted(c.baseScore for c in r.cvssData) == [7.5, 9.8]
    assert [(c.cweId, c.cweDescription) for c in r.cweData] == [("CWE-1", "t"), ("CWE-79", None)]
    assert r.Descriptions == "nvd text" and r.vulnStatus == "Analyzed"
    assert str(r.datePublished) == "2024-01-02 03:04:05"
    assert [(c.capecId, c.capecDescription) for c in r.capecData] == [("CAPEC-1", "cap")]


def test_adp_scores_fill_gaps_only(staged):
    assert sorted(c.baseScore for c in by(staged, "b")[0].cvssData) == [5.0, 6.0, 6.5]
    assert [c.baseScore for c in by(staged, "c")[0].cvssData] == [4.0]
    assert [c.baseScore for c in by(staged, "d")[0].cvssData] == [8.0]


def test_cwe_of_one_side_survives(staged):
    assert [c.cweId for c in by(staged, "b")[0].cweData] == ["CWE-3"]
    (r,) = by(staged, "e")
    assert [(c.cweId, c.cweDescription) for c in r.cweData] == [("CWE-1", "b")]
    assert r.datePublished is None and r.cvssData is None


def test_nvd_without_english_or_metrics_stays(staged):
    (f,), (g,) = by(staged, "f"), by(staged, "g")
    assert f.Descriptions is None and f.cvssData is None
    assert g.Descriptions == "one"


def test_drop_unscored(spark, staged):
    envelope = spark.createDataFrame([("v", "p", None, None, None, [["CVE-1", nvd(None)]])],
                                     "vendor string, product string, ingestionTimestamp timestamp, ingestionDate date, cvelistv5 array<array<string>>, fkie_nvd array<array<string>>")
    assert staging.normalize(envelope).count() == 1
    assert staging.normalize(envelope, drop_unscored=True).count() == 0


def test_lookup(staged):
    lookup = {r.vendor: r for r in staging.build_lookup(staging.master_rows(staged)).collect()}
    assert lookup["A"].cvssScore == 9.8 and lookup["A"].severity == "Critical" and lookup["A"].cweData == "t, CWE-79"
    assert lookup["E"].severity == "" and lookup["E"].vectorString == "" and lookup["E"].dateReserved == ""
    assert lookup["A"].lastModified == "2024-03-01 00:00:00 UTC"


def test_envelope(spark):
    df = spark.createDataFrame([(TS, "v", "p", None, [["a", "b"]]), (TS, "v", "q", [], None)],
                               "ingestionTimestamp string, vendor string, product string, cvelistv5 array<array<string>>, fkie_nvd array<array<string>>")
    assert rows(sinks.build_envelope(df), "ingestionDate", "product", "cveDataAvailable") == [("2025-03-02", "p", True), ("2025-03-02", "q", False)]


def test_greatest_text_of_each_cwe(spark):
    entry = "array<struct<cweId:string,cweDescription:string>>"
    df = spark.createDataFrame(
        [(1, [("CWE-2", "a"), ("CWE-1", None), ("CWE-2", "b")], [("CWE-2", None), ("CWE-1", None), ("CWE-10", "c")]), (2, None, []), (3, None, [("CWE-3", None)])],
        f"id int, cna {entry}, nvd {entry}",
    ).withColumn("every", staging._all_cwe("cna", "nvd")).select("id", staging._merged_cwe("every").alias("cwe"))
    got = {r.id: r.cwe and [tuple(e) for e in r.cwe] for r in df.collect()}
    assert got == {1: [("CWE-1", None), ("CWE-10", "c"), ("CWE-2", "b")], 2: None, 3: [("CWE-3", None)]}
