"""Readers, writers, staging and streams over data that Spark derives from the tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.plans import check_sql as sql, feed, staging
from riskloom.plans.expression_queries import _CNA, _NVD
from riskloom.plans.registry import add, flat
from riskloom.functions import fixed
from riskloom.sources import parts
from riskloom.sources.staged import stored
from riskloom.session import shared_dir
from riskloom.sources import feeds, paths, records, sinks
from riskloom.streaming import epss, kev, messages

_TS = "2025-03-02T19:55:48.000000+00:00"
_META = (
    "named_struct('cveId', cveId, 'datePublished', CAST(datePublished AS STRING), "
    "'dateUpdated', CAST(lastModified AS STRING))"
)


def envelopes(spark: SparkSession, sf_dir: str, by: str | None = None) -> DataFrame:
    """One ingest record per line, documents as JSON text. Lines 1-4 carry a CNA document,
    lines 3-6 an NVD document, line 7 none. `by`: the lines are placed by a column while they are narrow."""
    cna = f"to_json(struct({_META} AS cveMetadata, ({_CNA}).containers AS containers))"
    nvd = f"to_json({_NVD})"
    lines = feed.records(spark, sf_dir)
    rows = (sinks.balanced(lines, by) if by else lines).selectExpr(
        f"'{_TS}' AS ingestionTimestamp", "vendor", "product",
        f"IF(line <= 4, array(array(lower(cveId) || ' ', {cna})), array()) AS cvelistv5",
        f"IF(line BETWEEN 3 AND 6, array(array(cveId, {nvd})), array()) AS fkie_nvd",
    )
    return sinks.build_envelope(rows)


def _ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "ndjson")
    sinks.write_ndjson_shards(envelopes(spark, sf_dir), path, 8, gzip=True)
    return records.read_ingest_ndjson(spark, path)


_IDS_SQL = (
    "CASE WHEN line <= 4 THEN lower(cveId) || ' ' END AS cna, CASE WHEN line BETWEEN 3 AND 6 THEN cveId END AS nvd, "
    "CASE WHEN line BETWEEN 3 AND 6 THEN 'cpe:2.3:a:' || vendor || ':' || product || ':1' END AS source"
)


def _read_back(spark, sf_dir):
    return flat(_ids(_ndjson(spark, sf_dir)).select("vendor", "product", "ingestionDate", "cna", "nvd", "source"))


def _ids(df: DataFrame) -> DataFrame:
    """The rows with the id of either document and a digest of the NVD document's text."""
    first = lambda c, k: F.try_element_at(F.try_element_at(c, F.lit(1)), F.lit(k))
    vendor = F.get_json_object(first("fkie_nvd", 2), "$.configurations[0].nodes[0].cpeMatch[0].criteria")
    return df.withColumns({"cna": first("cvelistv5", 1), "nvd": first("fkie_nvd", 1), "source": vendor})


add(
    "src1_ndjson_round_trip", _read_back,
    f"WITH {sql.RECORDS} SELECT vendor, product, '2025-03-02' AS ingestionDate, {_IDS_SQL} FROM records WHERE line < 7",
)
add(
    "snk10_build_envelope",
    lambda s, d: _ids(envelopes(s, d)).select("vendor", "product", "ingestionDate", "cveDataAvailable", "cna", "nvd", "source"),
    f"WITH {sql.RECORDS} SELECT vendor, product, '2025-03-02' AS ingestionDate, line < 7 AS cveDataAvailable, {_IDS_SQL} FROM records",
)


def _staging(spark, sf_dir):
    def joined(arr, *parts):
        return F.array_join(F.transform(arr, lambda e: F.concat_ws("|", *[e[p].cast("string") for p in parts])), ",")

    rows = staging.normalize(_as_ingest(envelopes(spark, sf_dir)))
    return flat(rows.select(
        "vendor", "product", "cveId", "vulnStatus", "datePublished", "dateUpdated", "lastModified", "Descriptions",
        joined("cvssData", "version", "vectorString", "baseScore").alias("cvss"),
        joined("cweData", "cweId", "cweDescription").alias("cwe"),
        joined("capecData", "capecId", "capecDescription").alias("capec"),
    ))


def _as_ingest(df: DataFrame) -> DataFrame:
    return df.where("cveDataAvailable").withColumn("ingestionTimestamp", F.to_timestamp("ingestionTimestamp")).withColumn(
        "ingestionDate", F.to_date("ingestionDate"))


_STAGING_SQL = f"""WITH {sql.RECORDS},
c AS (SELECT * FROM (SELECT vendor, product, cveId, datePublished, lastModified, row_number() OVER
   (PARTITION BY vendor, product, cveId ORDER BY lastModified DESC, datePublished DESC) AS rn FROM records WHERE line <= 4) WHERE rn = 1),
n AS (SELECT * FROM (SELECT vendor, product, cveId, lastModified, CASE WHEN line <> 1 THEN vendor END AS text, row_number() OVER
   (PARTITION BY vendor, product, cveId ORDER BY lastModified DESC) AS rn FROM records WHERE line BETWEEN 3 AND 6) WHERE rn = 1),
ce AS (SELECT DISTINCT vendor, product, cveId, '3.1|cna|' || line || '.0' AS e, line AS s, 1 AS k FROM records WHERE line <= 4 AND flag <> 'R'
   UNION SELECT DISTINCT vendor, product, cveId, '3.1|adp|' || line || '.5', line, 0 FROM records WHERE line <= 4 AND flag IN ('R', 'A') AND line <> 3),
ne AS (SELECT DISTINCT vendor, product, cveId, flag, '2.0|a|' || line || '.0' AS e, line AS s, 0 AS k FROM records WHERE line BETWEEN 3 AND 6
   UNION SELECT DISTINCT vendor, product, cveId, flag, '3.1|b|' || (line + 1) || '.0', line + 1, 1 FROM records WHERE line BETWEEN 3 AND 6 AND line <> 4),
cj AS (SELECT vendor, product, cveId, string_agg(e, ',' ORDER BY k, s) AS cvss FROM ce GROUP BY ALL),
nj AS (SELECT vendor, product, cveId, string_agg(e, ',' ORDER BY flag, k, s) AS cvss FROM ne GROUP BY ALL),
w AS (SELECT vendor, product, cveId, 'CWE-' || line AS id, vendor AS t FROM records WHERE line <= 4
   UNION ALL SELECT vendor, product, cveId, 'CWE-' || (line + 10), product FROM records WHERE line <= 4 AND line <> 3 AND status <> 'O'
   UNION ALL SELECT vendor, product, cveId, 'CWE-' || line, NULL FROM records WHERE line BETWEEN 3 AND 6 AND line <> 5),
wj AS (SELECT vendor, product, cveId, string_agg(concat_ws('|', id, t), ',' ORDER BY id) AS cwe FROM
   (SELECT vendor, product, cveId, id, max(t) AS t FROM w GROUP BY ALL) GROUP BY ALL),
pj AS (SELECT vendor, product, cveId, string_agg(DISTINCT 'CAPEC-' || line || '|' || vendor, ',' ORDER BY 'CAPEC-' || line || '|' || vendor) AS capec
   FROM records WHERE line <= 4 GROUP BY ALL),
k AS (SELECT vendor, product, cveId FROM c UNION SELECT vendor, product, cveId FROM n)
SELECT k.vendor, k.product, k.cveId, CASE WHEN n.cveId IS NOT NULL THEN 'Analyzed' END AS vulnStatus,
 c.datePublished::VARCHAR AS datePublished, c.lastModified::VARCHAR AS dateUpdated, n.lastModified::VARCHAR AS lastModified, n.text AS "Descriptions",
 CASE WHEN nj.cvss IS NOT NULL THEN nj.cvss ELSE cj.cvss END AS cvss, wj.cwe, pj.capec
FROM k LEFT JOIN c USING (vendor, product, cveId) LEFT JOIN n USING (vendor, product, cveId) LEFT JOIN cj USING (vendor, product, cveId)
 LEFT JOIN nj USING (vendor, product, cveId) LEFT JOIN wj USING (vendor, product, cveId) LEFT JOIN pj USING (vendor, product, cveId)"""
add("nst1_normalize_staging", _staging, _STAGING_SQL)
add(
    "nst10_unwind_configs",
    lambda s, d: _configs(s, d),
    f"WITH {sql.RECORDS} SELECT cveId, 'cpe:2.3:a:' || vendor || ':' || product || ':1' AS criteria FROM records",
)


def _configs(spark, sf_dir):
    from riskloom.functions import nested

    docs = feed.records(spark, sf_dir).selectExpr("cveId", f"({_NVD}).configurations AS configurations")
    return nested.unwind_configs(docs, "configurations", ["cveId"])


def _lookup(spark, sf_dir):
    rows = staging.master_rows(staging.normalize(_as_ingest(envelopes(spark, sf_dir))))
    return staging.build_lookup(rows).groupBy("severity", "cvssVersion").agg(
        F.count("*").alias("n"), F.countDistinct("vendor").alias("vendors"))


_LOOKUP_SQL = f"""WITH {sql.RECORDS},
e AS (SELECT vendor, product, cveId, '3.1' AS ver, line::DOUBLE AS score, '' AS src FROM records WHERE line <= 4 AND flag <> 'R'
   UNION ALL SELECT vendor, product, cveId, '3.1', line + 0.5, '' FROM records WHERE line <= 4 AND flag IN ('R', 'A') AND line <> 3),
n AS (SELECT vendor, product, cveId, '2.0' AS ver, line::DOUBLE AS score, flag AS src FROM records WHERE line BETWEEN 3 AND 6
   UNION ALL SELECT vendor, product, cveId, '3.1', line + 1, flag FROM records WHERE line BETWEEN 3 AND 6 AND line <> 4),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vendor, product, cveId ORDER BY score DESC, src, ver) AS rn
   FROM (SELECT * FROM n UNION ALL SELECT * FROM e ANTI JOIN n USING (vendor, product, cveId))) WHERE rn = 1),
k AS (SELECT DISTINCT vendor, product, cveId FROM records WHERE line <= 6)
SELECT CASE WHEN score >= 9 THEN 'Critical' WHEN score >= 7 THEN 'High' WHEN score >= 4 THEN 'Medium' WHEN score IS NOT NULL THEN 'Low' ELSE '' END AS severity,
 coalesce(ver, '') AS cvssVersion, count(*) AS n, count(DISTINCT vendor) AS vendors FROM k LEFT JOIN best USING (vendor, product, cveId) GROUP BY ALL"""
add("lookup_from_staging", _lookup, _LOOKUP_SQL)


# --- files --------------------------------------------------------------------------------
def _partitions(spark, sf_dir):
    path = shared_dir(spark, "partitions")
    rows = feed.records(spark, sf_dir).selectExpr("vendor", "line", "price", "CAST(year(datePublished) AS INT) AS y")
    sinks.write_table(rows, path, ["y"])
    newer = spark.read.parquet(path).where("y >= 2000").withColumn("price", F.col("price") + 1)
    again = shared_dir(spark, "partitions-new")
    sinks.write_table(newer, again)
    sinks.overwrite_partitions(spark.read.parquet(again), path, ["y"])
    return spark.read.parquet(path).groupBy("vendor", "y").agg(
        F.count("*").alias("n"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total"))


add(
    "snk2_overwrite_partitions", _partitions,
    f"WITH {sql.RECORDS} SELECT vendor, year(datePublished)::INTEGER AS y, count(*) AS n, sum((price + CASE WHEN year(datePublished) >= 2000 THEN 1 ELSE 0 END)"
    "::DECIMAL(18,2))::DOUBLE AS total FROM records GROUP BY ALL",
)


def _orders(spark, sf_dir, where="true"):
    return feed.table(spark, sf_dir, "orders").where(where).select("o_orderkey", "o_orderstatus", "o_orderpriority")


_ORDERS_SQL = "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"


def _compacted(spark, sf_dir):
    """Orders in parts by status; those written in several small files are rewritten."""
    root = shared_dir(spark, "compact")
    made = parts.current(spark, root).next()
    rows = _orders(spark, sf_dir).withColumn("part", F.col("o_orderstatus"))
    parts.write(rows.where("part = 'F'"), root, made, "orders")
    parts.write(rows.where("part <> 'F'"), root, made, "orders", [], files=12)
    parts.commit(spark, root, made)
    if {p for _, p in parts.compact(spark, root)} != {"O", "P"}:
        raise RuntimeError("only parts in small files are rewritten")
    return parts.read(spark, root, parts.current(spark, root), "orders").drop("part")


add("snk7_compact", _compacted, _ORDERS_SQL)


# --- streams ------------------------------------------------------------------------------
def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = feed.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _run(rows: DataFrame, spark: SparkSession, name: str, partitions=()) -> DataFrame:
    out = shared_dir(spark, name)
    kev.append_stream(rows, out, shared_dir(spark, name + "-state"), partitions).awaitTermination()
    return spark.read.parquet(out)


def _lists(spark, sf_dir):
    """Four published lists: all but one group, the same, one group gone and another new, the gone one
    back. What is new against the list before is sent."""
    out, state = shared_dir(spark, "kev-lists"), shared_dir(spark, "kev-lists-state")
    items = feed.table(spark, sf_dir, "events").selectExpr(
        "user_id % 4 AS g", "'CVE-' || user_id AS cveID", "CAST(to_date(ts) AS STRING) AS dateAdded", "event_type AS product").distinct()
    items = stored(items.groupBy("g", "cveID", "dateAdded").agg(F.min("product").alias("product")), "kev-items")
    missing = [c for c in fixed.KEV_FIELDS if c not in items.columns]
    items = items.withColumns({c: F.lit(None).cast("string") for c in missing})
    for batch, where in enumerate(("g <> 1", "g <> 1", "g <> 2", "true")):
        kev.publish_list(items.where(where).drop("g"), batch, out, state)
    sent = spark.read.option("basePath", out).parquet(*[f"{out}/batch={b}" for b in (0, 2, 3)])
    return sent.select("cveId", "dateAdded", "product", F.col("batch").cast("int").alias("batch"))


add(
    "str1_publish_list", _lists,
    "WITH i AS (SELECT user_id % 4 AS g, 'CVE-' || user_id AS \"cveId\", ts::DATE::VARCHAR AS \"dateAdded\", min(event_type) AS product FROM events GROUP BY ALL) "
    "SELECT * EXCLUDE g, CASE WHEN g = 1 THEN 2 ELSE 0 END AS batch FROM i UNION ALL SELECT * EXCLUDE g, 3 FROM i WHERE g = 2",
)


def _kev(spark, sf_dir):
    items = _events(spark, sf_dir).selectExpr("'CVE-' || user_id AS cveID", "CAST(to_date(ts) AS STRING) AS dateAdded")
    return _run(kev.kev_distinct(items), spark, "kev").select("cveID", "dateAdded", "hash")


add(
    "str1_kev_stream", _kev,
    "SELECT DISTINCT 'CVE-' || user_id AS \"cveID\", ts::DATE::VARCHAR AS \"dateAdded\", sha256('CVE-' || user_id || ts::DATE::VARCHAR) AS hash FROM events",
)


def _epss(spark, sf_dir):
    raw = _events(spark, sf_dir).selectExpr("'CVE-' || event_id AS cve", "CAST(value AS STRING) AS epss", "IF(event_type = 'error', 'x', '0.5') AS percentile")
    # Two days' files in one trigger: the newer counts.
    day = F.explode(F.array(F.lit("2024-01-30"), F.lit("2024-01-31"))).alias("day")
    both = raw.select("*", day).withColumn("epss", F.when(F.col("day") == "2024-01-31", F.col("epss")).otherwise(F.lit("0.1")))
    good, _ = feeds.epss_rows(both, F.col("day").cast("date"))
    out, state = shared_dir(spark, "epss"), shared_dir(spark, "epss-hash")
    epss.epss_stream(good, out, state, shared_dir(spark, "epss-state")).awaitTermination()
    return flat(sinks.read_version(spark, out))


add(
    "str2_epss_stream", _epss,
    "SELECT 'CVE-' || event_id AS \"cveId\", value AS epss, 0.5::DOUBLE AS percentile, '2024-01-31' AS date FROM events "
    "WHERE event_type <> 'error' AND value IS NOT NULL",
)


def _typed(spark, sf_dir):
    text = _events(spark, sf_dir).selectExpr(
        "to_json(struct('CVE-' || event_id AS cveID, CAST(to_date(ts) AS STRING) AS dateAdded, event_type AS product)) AS value")
    rows = feeds.kev_rows(feeds.json_events(text, fixed.KEV_ITEM_SCHEMA))
    return flat(_run(rows, spark, "typed", ["day"]).select("cveId", "dateAdded", "product", F.col("day").cast("date").alias("day")))


add(
    "str3_typed_ingest", _typed,
    "SELECT 'CVE-' || event_id AS \"cveId\", ts::DATE::VARCHAR AS \"dateAdded\", event_type AS product, ts::DATE::VARCHAR AS day FROM events",
)
add(
    "str4_dedupe_messages",
    lambda s, d: _run(
        messages.dedupe_messages(_events(s, d).selectExpr("user_id || '-' || event_type AS message_id", "event_type AS body")), s, "messages"),
    "SELECT DISTINCT user_id || '-' || event_type AS message_id, event_type AS body FROM events",
)


# --- more files ---------------------------------------------------------------------------
def _csv(spark, sf_dir):
    path = shared_dir(spark, "csv")
    rows = _orders(spark, sf_dir).withColumn("marks", F.array("o_orderstatus", "o_orderpriority"))
    sinks.export_csv(rows, path)
    schema = "o_orderkey bigint, o_orderstatus string, o_orderpriority string, marks string"
    back = spark.read.schema(schema).option("header", True).option("escape", "\\").csv(path)
    return back.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.from_json("marks", "array<string>").getItem(1).alias("mark"))


add("snk4_export_csv", _csv, "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderpriority AS mark FROM orders")


def _parquet(spark, sf_dir):
    path = shared_dir(spark, "parquet")
    sinks.export_parquet(_orders(spark, sf_dir), path, sort=["o_orderkey"])
    return spark.read.parquet(path)


add("snk4_export_parquet", _parquet, _ORDERS_SQL)


def _new_files(spark, sf_dir, again):
    table, out, state = (shared_dir(spark, "export-" + n) for n in ("table", "out", "state"))
    sinks.write_table(_orders(spark, sf_dir, "o_orderstatus <> 'P'"), table)
    sinks.export_new_files(spark, table, out, state, backfill=True)
    sinks.write_table(_orders(spark, sf_dir, "o_orderstatus = 'P'"), table)
    sinks.export_new_files(spark, table, out, state, backfill=again)
    return spark.read.parquet(out)


add("snk6_export_new_files", partial(_new_files, again=False), _ORDERS_SQL)
add("snk6_repeated_backfill", partial(_new_files, again=True), _ORDERS_SQL)


def _swapped(spark, sf_dir):
    root = shared_dir(spark, "swap")
    sinks.swap_table(_orders(spark, sf_dir), root, ["o_orderstatus"])
    current = sinks.read_version(spark, root)
    sinks.swap_table(current.withColumn("o_orderkey", F.col("o_orderkey") + 1), root, ["o_orderstatus"])
    return sinks.read_version(spark, root).select("o_orderkey", "o_orderstatus", "o_orderpriority")


add("snk8_swap_table", _swapped, _ORDERS_SQL.replace("o_orderkey,", "o_orderkey + 1 AS o_orderkey,"))


def _epss_file(spark, sf_dir):
    path = shared_dir(spark, "epss-csv")
    raw = feed.table(spark, sf_dir, "events").selectExpr(
        "'CVE-' || event_id AS cve", "IF(event_type = 'error', 'x', CAST(value AS STRING)) AS epss", "'0.25' AS percentile")
    raw.write.option("header", True).option("compression", "gzip").csv(path)
    good, bad = feeds.read_epss(spark, path, F.lit("2024-01-31").cast("date"))
    return flat(good.withColumn("readable", F.lit(True)).unionByName(bad.withColumn("readable", F.lit(False))))


add(
    "src6_read_epss", _epss_file,
    "SELECT 'CVE-' || event_id AS \"cveId\", CASE WHEN event_type <> 'error' THEN value END AS epss, 0.25::DOUBLE AS percentile, "
    "'2024-01-31' AS date, event_type <> 'error' AND value IS NOT NULL AS readable FROM events",
)


def _kev_documents(spark, sf_dir):
    path = shared_dir(spark, "kev-documents")
    item = "named_struct('cveID', '{p}-' || o_orderkey, 'dateAdded', CAST(to_date(o_orderdate) AS STRING), 'product', o_orderpriority)"
    docs = feed.table(spark, sf_dir, "orders").selectExpr(f"array({item.format(p='CVE')}, {item.format(p='CVX')}) AS vulnerabilities")
    docs.write.json(path)
    return flat(feeds.kev_rows(feeds.read_kev(spark, path, multi_line=False)).select("cveId", "product", "dateAdded", "day", "notes"))


add(
    "src5_read_kev", _kev_documents,
    "SELECT p || o_orderkey AS \"cveId\", o_orderpriority AS product, o_orderdate::DATE::VARCHAR AS \"dateAdded\", "
    "o_orderdate::DATE::VARCHAR AS day, NULL::VARCHAR AS notes FROM orders, (VALUES ('CVE-'), ('CVX-')) v(p)",
)
_NAME = "'s3://b/' || vendor || '_cve_' || product || IF(line = 1, '_raw.json', '_raw_2025-03-0' || line || '_19-55-48.json')"
add(
    "src9_metadata_from_filename",
    lambda s, d: flat(records.metadata_from_filename(
        feed.records(s, d).selectExpr("vendor AS real_vendor", "orderKey", "line", "price", f"{_NAME} AS source_file")).drop("source_file")),
    f"WITH {sql.RECORDS} SELECT vendor AS real_vendor, orderKey, line, price, CASE WHEN line = 1 THEN '' ELSE vendor END AS vendor, "
    "CASE WHEN line = 1 THEN '' ELSE product END AS product, CASE WHEN line <> 1 THEN '2025-03-0' || line || ' 19:55:48' END AS ingestionTimestamp, "
    "CASE WHEN line <> 1 THEN '2025-03-0' || line END AS ingestionDate FROM records",
)


def _gunzip(spark, sf_dir):
    src, dst = shared_dir(spark, "zipped"), shared_dir(spark, "unzipped")
    # Several archives in one folder per status, as many as the scan has parts.
    for status in "FOP":
        chosen = _orders(spark, sf_dir, f"o_orderstatus = '{status}'").select("o_orderkey", "o_orderpriority")
        chosen.write.option("compression", "gzip").json(f"{src}/{status}")
    done = records.gunzip_files(spark, src, dst)
    rows = spark.read.schema("o_orderkey bigint, o_orderpriority string, file string").json(dst)
    rows = rows.withColumn("file", F.url_decode("file")).join(done, "file")
    return rows.select("o_orderkey", F.substring("file", 1, 1).alias("o_orderstatus"), "o_orderpriority", F.when(F.col("ok"), 0).otherwise(1).alias("failed"))


add("src10_gunzip_files", _gunzip, _ORDERS_SQL.replace(" FROM", ", 0 AS failed FROM").replace("0 AS", "0::INTEGER AS"))
add(
    "src2_read_ingest_documents",
    lambda s, d: _documents(s, d),
    f"WITH {sql.RECORDS} SELECT vendor, product, line < 7 AS cveDataAvailable, {_IDS_SQL} FROM records",
)


def _documents(spark, sf_dir):
    path = shared_dir(spark, "documents")
    sinks.write_documents(envelopes(spark, sf_dir, "vendor"), path, ["vendor"])
    found = records.read_ingest_documents(spark, f"{path}/*/*.json.gz")
    folder = F.regexp_extract(F.col("_metadata.file_path"), "vendor=([^/]+)/", 1)
    return _ids(found.withColumn("vendor", folder)).select("vendor", "product", "cveDataAvailable", "cna", "nvd", "source")


def _cvelist(spark, sf_dir):
    """One document per file in dated folders; files of other names and broken ones are skipped."""
    root = shared_dir(spark, "cvelist")
    orders = feed.table(spark, sf_dir, "orders")
    doc = "to_json(named_struct('cveMetadata', named_struct('cveId', 'CVE-' || o_orderkey, 'datePublished', o_orderpriority)))"
    orders.selectExpr(f"{doc} AS value", "year(o_orderdate) AS y").write.partitionBy("y").text(root)
    paths.rename_children(spark, root, "part-", "CVE-", ".json")
    return records.read_cvelist(spark, root, multi_line=False).select("cveMetadata.cveId", F.col("cveMetadata.datePublished").alias("priority"))


add("src7_read_cvelist", _cvelist, "SELECT 'CVE-' || o_orderkey AS \"cveId\", o_orderpriority AS priority FROM orders")
