"""Adapter: the driver's order lines as vulnerability records.

The same column texts build the Spark view and the DuckDB view of the checks. Only
`lineitem` is read, so the adapter adds no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions.scoring import enrich, severity

_NET = "CASE l_returnflag WHEN 'R' THEN 'N' WHEN 'A' THEN 'A' ELSE 'L' END"
_HIGH = "CASE WHEN l_quantity > 25 THEN 'H' ELSE 'L' END"
_FULL = "CASE WHEN l_discount > 0.05 THEN 'H' ELSE 'N' END"
_OPEN = "CASE l_linestatus WHEN 'O' THEN 'N' ELSE 'S' END"
_PRIV = "CASE WHEN l_tax < 0.02 THEN 'N' WHEN l_tax < 0.05 THEN 'L' ELSE 'H' END"
_UI = "CASE l_linestatus WHEN 'O' THEN 'N' ELSE 'R' END"
_SCOPE = "CASE WHEN l_discount < 0.04 THEN 'C' ELSE 'U' END"

COLUMNS = {
    "cveId": "'CVE-' || CAST(year(l_shipdate) AS STRING) || '-' "
    "|| CAST(CAST(floor(l_orderkey / 16) AS BIGINT) AS STRING)",
    "vendor": "'V' || CAST(l_suppkey % 20 AS STRING)",
    "product": "'P' || CAST(l_partkey % 12 AS STRING)",
    "datePublished": "l_shipdate",
    "lastModified": "l_shipdate + l_linenumber * INTERVAL '1' DAY",
    "cvssScore": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity / 5 AS DECIMAL(4,1)) END",
    "cvssVersion": "CASE l_linenumber WHEN 7 THEN '' WHEN 4 THEN '2.0' WHEN 6 THEN '4.0' ELSE '3.1' END",
    "vectorString": "CASE l_linenumber WHEN 7 THEN '' "
    f"WHEN 4 THEN 'AV:' || {_NET} || '/AC:L/Au:' || {_OPEN} || '/C:' || {_HIGH} || '/I:P/A:' || {_FULL} "
    f"WHEN 6 THEN 'CVSS:4.0/AV:' || {_NET} || '/AC:L/AT:N/PR:' || {_PRIV} || '/UI:' || {_UI} || '/VC:H/VI:N/VA:L' "
    f"ELSE 'CVSS:3.1/AV:' || {_NET} || '/AC:H/PR:' || {_PRIV} || '/UI:' || {_UI} || '/S:' || {_SCOPE} "
    f"|| '/C:' || {_HIGH} || '/I:N/A:' || {_FULL} END",
    "line": "l_linenumber",
    "orderKey": "l_orderkey",
    "status": "l_linestatus",
    "flag": "l_returnflag",
    "price": "l_extendedprice",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record-shaped rows with severity."""
    lines = table(spark, sf_dir, "lineitem")
    df = lines.selectExpr(*[f"{text} AS {name}" for name, text in COLUMNS.items()])
    return df.withColumn("severity", severity("cvssScore", missing=""))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with risk flags and weighted score."""
    return enrich(records(spark, sf_dir))


def columns_sql() -> str:
    """The same adapter as a DuckDB query text."""
    return "SELECT " + ", ".join(f"{t} AS {n}" for n, t in COLUMNS.items()) + " FROM lineitem"
