"""Scores, vectors and names at their edges."""

from pyspark.sql import functions as F

from riskloom.functions import fixed, scoring, text
from tests.conftest import rows

V31 = "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H"
V2 = "AV:N/AC:L/Au:N/C:P/I:P/A:C"
V4 = "CVSS:4.0/AV:N/AC:L/AT:N/PR:N/UI:N/VC:H/VI:H/VA:H/SC:N/SI:N/SA:N"


def test_severity_cut_points(spark):
    df = spark.createDataFrame([(s,) for s in (10.0, 9.0, 8.9, 7.0, 6.9, 4.0, 3.9, 0.0, None)], "s double")
    got = [r[0] for r in df.select(scoring.severity("s")).collect()]
    assert got == ["Critical", "Critical", "High", "High", "Medium", "Medium", "Low", "Low", None]
    assert df.where("s IS NULL").select(scoring.severity("s", "")).first()[0] == ""


def test_weights(spark):
    df = spark.createDataFrame([(10.0,), (8.0,), (5.0,), (2.0,), (None,)], "s double").withColumn("v", scoring.severity("s", ""))
    assert [float(r[0]) for r in df.select(scoring.weighted_score("s", "v")).collect()] == [10.0, 6.0, 2.5, 0.5, 0.0]


def test_vector_metrics_are_whole_parts(spark):
    df = spark.createDataFrame([(V31, "3.1"), (V2, "2.0"), (V4, "4.0"), ("", ""), (None, None)], "v string, ver string")
    out = [r.asDict() for r in df.select(*[c.alias(n) for n, c in scoring.parse_vector("v", "ver").items()]).collect()]
    assert (out[0]["C"], out[0]["I"], out[0]["S"], out[0]["PR"]) == ("H", "H", "C", "N")
    assert (out[1]["C"], out[1]["A"], out[1]["Au"], out[1]["PR"]) == ("P", "C", "N", "")
    assert (out[2]["C"], out[2]["I"], out[2]["A"], out[2]["S"], out[2]["UI"]) == ("", "", "", "", "N")
    assert set(out[3].values()) == {""}
    assert out[4]["AV"] is None and out[4]["PR"] == ""


def test_legacy_matching_finds_longer_names(spark):
    df = spark.createDataFrame([(V31,)], "v string")
    assert df.select(scoring.vector_metric("v", "C", legacy=True)).first()[0] == "L"
    assert df.select(scoring.vector_metric("v", "S", legacy=True)).first()[0] == "3.1"


def test_flags(spark):
    df = spark.createDataFrame([(1, V31, "3.1"), (2, V2, "2.0"), (3, V4, "4.0"), (4, None, None)], "i int, vectorString string, cvssVersion string")
    out = {r.i: r for r in scoring.risk_flags(df).collect()}
    assert out[1].is_fully_critical and out[1].is_scope_changed
    assert out[2].is_no_ui and out[2].is_low_priv and not out[2].is_fully_critical
    assert out[3].is_network_based and not out[3].is_high_conf and not out[3].is_fully_critical
    assert [out[4][f] for f in fixed.RISK_FLAGS] == [False] * 8
    legacy = {r.i: r for r in scoring.risk_flags(df, legacy=True).collect()}
    assert not legacy[1].is_fully_critical


def test_choose_cvss(spark):
    kind = f"c array<{fixed.CVSS_STRUCT}>"

    def e(vec, base):
        return ("s", "t", "3.1", vec, base, None, None)

    data = [([e("a", 5.0), e("b", 9.0), e("c", 9.0)],), ([e("a", None), None],), ([],), (None,), ([e("n", None), e("z", 0.0)],)]
    got = [r[0] for r in spark.createDataFrame(data, kind).select(scoring.choose_cvss("c").alias("x")).collect()]
    assert got[0].vectorString == "b"
    assert got[1] is None
    assert got[2].version == "" and got[2].baseScore is None
    assert got[3].version == ""
    assert got[4].baseScore == 0.0


def test_choose_cvss_searches_once(spark):
    """The search for the best entry is written once, not once per field and once for its test."""
    df = spark.createDataFrame([([],)], f"c array<{fixed.CVSS_STRUCT}>").select(scoring.choose_cvss("c").alias("x"))
    assert df._jdf.queryExecution().analyzed().toString().count("array_max") == 1


def test_names(spark):
    df = spark.createDataFrame(
        [(" acme\\_corp ", " *** N/A *** ", "---"), ("X_y", " Foo ", ".a b/ü"), (None, "", None)], "a string, b string, c string"
    )
    got = rows(df.select(text.clean_name("a"), text.sanitize_key_field("b"), text.safe_path("c")))
    assert ("Acme Corp", None, "file") in got
    assert ("X Y", "foo", "a_b/file") in got
    assert (None, None, None) in got


def test_message_id_length(spark):
    df = spark.createDataFrame([("v" * 300, "p"), ("v", "p é")], "v string, p string")
    ids = [r[0] for r in df.select(text.safe_message_id("v", "p")).collect()]
    assert len(ids[0]) == 80 and ids[1].startswith("v_p__-")


def test_cpe_keeps_escaped_colons(spark):
    df = spark.createDataFrame([("cpe:2.3:a:ve\\:n:prod:1.0:*",), ("cpe:2.3",)], "c string")
    got = [tuple(r[0]) for r in df.select(text.cpe_fields("c")).collect()]
    assert got == [("ve\\:n", "prod"), (None, None)]
    parts = df.select(text.cpe_browse_parts("c").alias("p")).select("p.*").collect()
    assert parts[0].remainder == "1.0:*" and parts[1].remainder is None


def test_bad_timestamps_become_null(spark):
    df = spark.createDataFrame([("2025-01-02T03:04:05.100Z",), ("nope",), (None,)], "t string")
    got = [r[0] for r in df.select(text.compact_timestamp(text.parse_timestamp("t"))).collect()]
    assert got == ["2025-01-02 03:04:05.1 UTC", "", ""]
    assert df.select(F.count(text.parse_timestamp("t"))).first()[0] == 1
