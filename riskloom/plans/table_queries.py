"""Joins, aggregates, windows, maps and merges over whole tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions import fixed, text
from riskloom.functions.scoring import enrich
from riskloom.operators import exposure, history, joins, keys, maps, quality, running, serving
from riskloom.plans import check_sql as sql, feed, level_queries, store  # noqa: F401  (level tables first)
from riskloom.plans.registry import CHECKS, QUERIES, add, flat
from riskloom.session import shared_dir
from riskloom.sources import sinks
from riskloom.sources.staged import stored

KEY = fixed.RECORD_KEY
SLIM = "vendor product cveId datePublished lastModified cvssScore flag orderKey line price".split()
DATA = [c for c in SLIM if c not in KEY]
RUN_TS = "2002-01-01 00:00:00"
_MODIFIED = "CASE WHEN line = 6 THEN NULL ELSE lastModified END"


def slim(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    made = {"cvssScore": "CAST(cvssScore AS DOUBLE)", "lastModified": _MODIFIED}
    return feed.records(spark, sf_dir).where(where).selectExpr(*[f"{made.get(c, c)} AS {c}" for c in SLIM])


SLIM_SQL = sql.RECORDS + (
    f", slim AS (SELECT vendor, product, cveId, datePublished, {_MODIFIED} AS lastModified, "
    "CAST(cvssScore AS DOUBLE) AS cvssScore, flag, orderKey, line, price, status FROM records)"
)
DATES = "datePublished::VARCHAR AS datePublished, lastModified::VARCHAR AS lastModified"
SHOW = f"vendor, product, cveId, {DATES}, cvssScore, flag, orderKey, line, price"


def latest(df: DataFrame, by: list[str] = KEY) -> DataFrame:
    return keys.latest_per_key(df, by, ["lastModified"])


def _latest_sql(where: str, by: list[str] = KEY) -> str:
    ties = [c for c in SLIM if c not in by and c != "lastModified"]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in ties)
    return (
        f"(SELECT {', '.join(SLIM)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(by)} "
        f"ORDER BY lastModified DESC NULLS LAST, {order}) AS rn FROM slim WHERE {where}) WHERE rn = 1)"
    )


OLD, NEW = "status = 'F'", "status = 'O'"
T_SQL, S_SQL = f"t AS {_latest_sql(OLD)}", f"s AS {_latest_sql(NEW)}"
TS = f"WITH {SLIM_SQL}, {T_SQL}, {S_SQL}"


def target(spark, sf_dir) -> DataFrame:
    return latest(slim(spark, sf_dir, OLD))


def source(spark, sf_dir) -> DataFrame:
    return latest(slim(spark, sf_dir, NEW))


# --- windows and duplicates ---------------------------------------------------------------
add(
    "win2_most_complete_per_key",
    lambda s, d: flat(keys.most_complete_per_key(slim(s, d), KEY)),
    f"WITH {SLIM_SQL} SELECT {SHOW} FROM (SELECT *, row_number() OVER (PARTITION BY vendor, product, cveId "
    "ORDER BY (lastModified IS NOT NULL)::INT + (cvssScore IS NOT NULL)::INT DESC, "
    + ", ".join(f"{c} ASC NULLS LAST" for c in DATA)
    + ") AS rn FROM slim) WHERE rn = 1",
)
add(
    "win3_latest_per_key",
    lambda s, d: flat(latest(slim(s, d))),
    f"WITH {SLIM_SQL} SELECT {SHOW} FROM {_latest_sql('true')}",
)
add(
    "agg16_duplicate_keys",
    lambda s, d: keys.duplicate_keys(slim(s, d), KEY),
    f"WITH {SLIM_SQL} SELECT vendor, product, cveId FROM slim GROUP BY ALL HAVING count(*) > 1",
)


def _split(spark, sf_dir):
    """A share that only some keys reach, so that both ways of the join carry rows."""
    rows = stored(slim(spark, sf_dir).withColumn("vendor", F.expr("nullif(vendor, 'V3')")), "rows")
    return flat(keys.mark_duplicates(rows, KEY, share=2.5e-4))


add(
    "jn3_split_duplicates", _split,
    f"WITH {SLIM_SQL}, x AS (SELECT * REPLACE (nullif(vendor, 'V3') AS vendor) FROM slim) SELECT {SHOW}, "
    "count(*) OVER (PARTITION BY vendor, product, cveId) > 1 AS repeated FROM x",
)
add(
    "exp16_risk_flags",
    lambda s, d: feed.enriched(s, d).select("orderKey", "line", "price", *fixed.RISK_FLAGS),
    f"WITH {sql.ENRICHED} SELECT orderKey, line, price, {', '.join(fixed.RISK_FLAGS)} FROM enriched",
)


# --- joins --------------------------------------------------------------------------------
def _merge(spark, sf_dir):
    def side(df, p):
        vectors = F.expr("IF(line < 3, array(), array(flag, CAST(line AS STRING)))")
        return df.select(*KEY, F.col("datePublished").alias(p + "Date"), F.col("flag").alias(p + "Text"), vectors.alias(p + "Cvss"))

    out = joins.merge_sources(
        side(target(spark, sf_dir), "cna"), side(source(spark, sf_dir), "nvd"), KEY,
        cna_first={"datePublished": ("cnaDate", "nvdDate")},
        nvd_first={"descriptions": ("cnaText", "nvdText")},
        nvd_nonempty={"cvssData": ("cnaCvss", "nvdCvss")},
    )
    return flat(out.withColumn("cvssData", F.array_join("cvssData", ",")))


add(
    "jn1_merge_sources", _merge,
    TS + " SELECT vendor, product, cveId, coalesce(t.datePublished, s.datePublished)::VARCHAR AS datePublished, "
    "coalesce(s.flag, t.flag) AS descriptions, CASE WHEN s.line >= 3 THEN s.flag || ',' || s.line "
    "WHEN t.line IS NULL THEN NULL WHEN t.line < 3 THEN '' ELSE t.flag || ',' || t.line END AS cvssData "
    "FROM t FULL OUTER JOIN s USING (vendor, product, cveId)",
)


def _cwe_members(spark, sf_dir, where):
    return slim(spark, sf_dir, where).selectExpr(*KEY, "'CWE-' || line AS cwe", "IF(line = 5, NULL, flag) AS label")


def _cwe_text(df):
    entry = F.transform("cweData", lambda x: F.concat_ws("=", x["cweId"], x["cweDescription"]))
    return df.withColumn("cweData", F.array_join(entry, ","))


_CWE_SQL = (
    "cwe AS (SELECT {k}, string_agg(concat_ws('=', cwe, label), ',' ORDER BY cwe) AS cweData FROM "
    "(SELECT {k}, 'CWE-' || line AS cwe, max(CASE WHEN line <> 5 THEN flag END) AS label FROM slim WHERE {w} "
    "GROUP BY {k}, line) GROUP BY {k})"
)
add(
    "agg2_dedupe_cwe",
    lambda s, d: _cwe_text(joins.collect_cwe(
        joins.dedupe_cwe(_cwe_members(s, d, "true"), ["cveId"], "cwe", "label"), ["cveId"], "cwe", "label", "cweData")),
    f"WITH {SLIM_SQL}, {_CWE_SQL.format(k='cveId', w='true')} SELECT * FROM cwe",
)
add(
    "jn2_attach_cwe",
    lambda s, d: flat(_cwe_text(joins.attach(
        target(s, d),
        joins.collect_cwe(joins.dedupe_cwe(_cwe_members(s, d, "flag = 'R'"), KEY, "cwe", "label"), KEY, "cwe", "label", "cweData"),
        KEY))),
    TS + ", " + _CWE_SQL.format(k="vendor, product, cveId", w="flag = 'R'")
    + f" SELECT {SHOW}, cweData FROM t LEFT JOIN cwe USING (vendor, product, cveId)",
)
add(
    "agg1_collect_distinct",
    lambda s, d: keys.collect_distinct(
        slim(s, d).selectExpr(
            "nullif(cveId, 'CVE-1995-3') AS cveId", "IF(line = 1, NULL, IF(line > 4, array(), array(flag, vendor))) AS marks", "array('L' || line) AS lines"),
        ["cveId"], {"marks": "marks", "lines": "lines"},
    ).select("cveId", F.array_join("marks", ",").alias("marks"), F.array_join("lines", ",").alias("lines")),
    f"WITH {SLIM_SQL}, k AS (SELECT * REPLACE (nullif(cveId, 'CVE-1995-3') AS cveId) FROM slim), "
    "m AS (SELECT DISTINCT cveId, unnest([flag, vendor]) AS x FROM k WHERE line BETWEEN 2 AND 4), "
    "a AS (SELECT cveId, string_agg(x, ',' ORDER BY x) AS marks FROM m GROUP BY cveId), "
    "b AS (SELECT cveId, string_agg(DISTINCT 'L' || line, ',' ORDER BY 'L' || line) AS lines FROM k GROUP BY cveId) "
    "SELECT b.cveId, coalesce(marks, '') AS marks, lines FROM b LEFT JOIN a ON a.cveId IS NOT DISTINCT FROM b.cveId",
)
add(
    "agg3_consolidate_first",
    lambda s, d: flat(keys.consolidate_first(
        slim(s, d).withColumn("cvssData", F.expr("array(flag, 'L' || line)")), KEY, ["lastModified"], ["cvssData"]
    ).withColumn("cvssData", F.array_join("cvssData", ","))),
    f"WITH {SLIM_SQL}, m AS (SELECT DISTINCT vendor, product, cveId, unnest([flag, 'L' || line]) AS x FROM slim), "
    "a AS (SELECT vendor, product, cveId, string_agg(x, ',' ORDER BY x) AS cvssData FROM m GROUP BY ALL), "
    "f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vendor, product, cveId ORDER BY lastModified DESC NULLS LAST, "
    + ", ".join(f"{c} DESC NULLS LAST" for c in DATA if c != "lastModified")
    + f") AS rn FROM slim) WHERE rn = 1) SELECT {SHOW}, cvssData FROM f JOIN a USING (vendor, product, cveId)",
)
add(
    "jn4_delete_matching",
    lambda s, d: flat(joins.delete_matching(target(s, d), slim(s, d, NEW), KEY)),  # one row per key
    TS + f" SELECT {SHOW} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.vendor = t.vendor AND s.product = t.product AND s.cveId = t.cveId)",
)
add(
    "jn5_insert_missing",
    lambda s, d: flat(joins.insert_missing(target(s, d), source(s, d), KEY)),
    TS + f" SELECT {SHOW} FROM t UNION ALL SELECT {SHOW} FROM s ANTI JOIN t USING (vendor, product, cveId)",
)
_SET = "datePublished lastModified cvssScore flag".split()
add(
    "jn6_update_from",
    lambda s, d: flat(joins.update_from(target(s, d), source(s, d), KEY, _SET)),
    TS + " SELECT vendor, product, cveId, "
    + ", ".join(
        f"(CASE WHEN s.line IS NOT NULL THEN s.{c} ELSE t.{c} END){'' if c in ('cvssScore', 'flag') else '::VARCHAR'} AS {c}"
        for c in _SET
    )
    + ", t.orderKey, t.line, t.price FROM t LEFT JOIN s USING (vendor, product, cveId)",
)
add(
    "jn7_newer_than",
    lambda s, d: flat(joins.newer_than(
        slim(s, d), "datePublished", feed.table(s, d, "orders").where("o_orderpriority = '1-URGENT'"), "o_orderdate")),
    f"WITH {SLIM_SQL} SELECT {SHOW} FROM slim, (SELECT max(o_orderdate) AS wm FROM orders WHERE o_orderpriority = '1-URGENT') "
    "WHERE datePublished > wm",
)
_HASH = "md5(concat_ws('||', flag, CAST(line AS STRING)))"
add(
    "jn10_changed_keys",
    lambda s, d: joins.changed_keys(
        source(s, d).withColumn("row_hash", text.row_hash("flag", "line")),
        target(s, d).withColumn("row_hash", text.row_hash("flag", "line")), KEY),
    TS + f", a AS (SELECT *, {_HASH} AS h FROM t), b AS (SELECT *, {_HASH} AS h FROM s) "
    "SELECT vendor, product, cveId, a.h AS old_hash, b.h AS new_hash FROM a JOIN b USING (vendor, product, cveId) WHERE a.h <> b.h",
)


def _search(spark, sf_dir):
    requests = feed.table(spark, sf_dir, "supplier").selectExpr(
        "'V' || (s_suppkey % 20) AS vendor", "'P' || (s_nationkey % 12) AS product")
    nvd, cl = slim(spark, sf_dir, OLD), slim(spark, sf_dir, NEW)
    docs = {
        "nvd": latest(nvd, ["cveId"]).select("cveId", "cvssScore", "orderKey"),
        "cvelist": latest(cl.where("line <> 2"), ["cveId"]).select("cveId", "cvssScore", "orderKey"),
    }
    # Maps and documents are written tables in the pipeline.
    edges = {n: stored(df.select(*KEY).distinct(), "map") for n, df in (("nvd", nvd), ("cvelist", cl))}
    return joins.search(requests, edges, {n: stored(df, "documents") for n, df in docs.items()})


add(
    "jn11_search", _search,
    f"WITH {SLIM_SQL}, req AS (SELECT DISTINCT 'V' || (s_suppkey % 20) AS vendor, 'P' || (s_nationkey % 12) AS product "
    f"FROM supplier), nd AS {_latest_sql(OLD, ['cveId'])}, "
    f"cd AS {_latest_sql(NEW + ' AND line <> 2', ['cveId'])} "
    "SELECT vendor, product, cveId, nd.cvssScore, nd.orderKey, 'nvd' AS source FROM "
    f"(SELECT DISTINCT vendor, product, cveId FROM slim WHERE {OLD}) JOIN req USING (vendor, product) "
    "JOIN (SELECT cveId, cvssScore, orderKey FROM nd) nd USING (cveId) UNION ALL "
    "SELECT vendor, product, cveId, cd.cvssScore, cd.orderKey, 'cvelist' FROM "
    f"(SELECT DISTINCT vendor, product, cveId FROM slim WHERE {NEW}) JOIN req USING (vendor, product) "
    "JOIN (SELECT cveId, cvssScore, orderKey FROM cd) cd USING (cveId)",
)
_DOC = ["cveId", "cvssScore", "orderKey"]
add(
    "jn12_get_record",
    lambda s, d: joins.get_record(
        slim(s, d, "flag = 'R'"), latest(slim(s, d, NEW), ["cveId"]).select(*_DOC), latest(slim(s, d, OLD), ["cveId"]).select(*_DOC)),
    f"WITH {SLIM_SQL}, ids AS (SELECT DISTINCT cveId FROM slim WHERE flag = 'R'), a AS {_latest_sql(NEW, ['cveId'])}, "
    f"b AS {_latest_sql(OLD, ['cveId'])} SELECT ids.cveId, CASE WHEN a.cveId IS NULL THEN b.cvssScore ELSE a.cvssScore END AS cvssScore, "
    "coalesce(a.orderKey, b.orderKey) AS orderKey, CASE WHEN a.cveId IS NULL THEN 2 ELSE 1 END AS source "
    "FROM ids LEFT JOIN a ON a.cveId = ids.cveId LEFT JOIN b ON b.cveId = ids.cveId",
)

# --- quality and counts -------------------------------------------------------------------
_PROFILE = dict(zip(fixed.PROFILE_COLUMNS, (
    "nullif(vendor, 'V3')", "product", "cveId", "CASE WHEN line IN (2, 3) THEN flag END", "CASE WHEN flag = 'R' THEN flag END",
    "nullif(status, 'F')", "nullif(vectorString, '')", "datePublished", "CASE WHEN line < 5 THEN datePublished END",
    "CASE WHEN line <> 4 THEN lastModified END", "CASE WHEN price > 40000 THEN datePublished END", _MODIFIED,
    "CASE WHEN price > 20000 THEN cvssVersion END",
), strict=True))
_STAMP = f"{sql.AS_OF} 12:00:00"
add(
    "agg13_null_profile",
    lambda s, d: flat(quality.null_profile(
        feed.records(s, d).selectExpr(*[f"{e} AS {c}" for c, e in _PROFILE.items()]),
        list(_PROFILE), "staging_2001_06_30", F.lit(_STAMP).cast("timestamp"))),
    f"WITH {sql.RECORDS}, p AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _PROFILE.items())} FROM records) SELECT "
    f"'{sql.AS_OF}' AS dqcheckDate, '{_STAMP}' AS dqcheckTimestamp, 'staging_2001_06_30' AS stagingTableName, count(*) AS totalRecords, "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}Nulls, round(CAST(100.0 * count(*) FILTER ({c} IS NULL) / count(*) AS DECIMAL(20,6)), 2)::DOUBLE AS {c}PercentNull"
        for c in _PROFILE
    ) + " FROM p",
)
add(
    "agg14_rows_per_vendor",
    lambda s, d: quality.rows_per(slim(s, d), "vendor"),
    f"WITH {SLIM_SQL} SELECT vendor, count(*) AS row_count FROM slim GROUP BY vendor",
)
add(
    "agg14_top_vendors",
    lambda s, d: quality.top(quality.rows_per(slim(s, d), "vendor"), "row_count", 10, ["vendor"]),
    f"WITH {SLIM_SQL} SELECT vendor, count(*) AS row_count FROM slim GROUP BY vendor ORDER BY 2 DESC, 1 LIMIT 10",
)
add(
    "agg15_distinct_per_vendor_top",
    lambda s, d: quality.top(quality.distinct_per(slim(s, d), "vendor", "cveId", "distinct_cves"), "distinct_cves", 50, ["vendor"]),
    f"WITH {SLIM_SQL} SELECT vendor, count(DISTINCT cveId) AS distinct_cves FROM slim GROUP BY vendor ORDER BY 2 DESC, 1 LIMIT 50",
)
add(
    "srt1_top_scores",
    lambda s, d: flat(quality.top(slim(s, d).where("cvssScore IS NOT NULL"), "cvssScore", 50, ["cveId", "orderKey", "line", "price"])),
    f"WITH {SLIM_SQL} SELECT {SHOW} FROM slim WHERE cvssScore IS NOT NULL ORDER BY cvssScore DESC, cveId, orderKey, line, price LIMIT 50",
)
add(
    "agg21_row_checks",
    lambda s, d: quality.row_checks({"raw": slim(s, d), "current": target(s, d), "scored": slim(s, d, "cvssScore IS NOT NULL")}),
    f"WITH {SLIM_SQL}, {T_SQL} SELECT 'raw' AS stage, count(*) AS rows FROM slim UNION ALL SELECT 'current', count(*) FROM t "
    "UNION ALL SELECT 'scored', count(cvssScore) FROM slim",
)
add(
    "set2_union_by_name",
    lambda s, d: slim(s, d, OLD).select(*KEY, "line").unionByName(slim(s, d, NEW).select("line", *reversed(KEY))),
    f"WITH {SLIM_SQL} SELECT vendor, product, cveId, line FROM slim",
)
add(
    "set4_distinct",
    lambda s, d: slim(s, d).select("vendor", "product", F.month("datePublished").alias("m")).distinct(),
    f"WITH {SLIM_SQL} SELECT DISTINCT vendor, product, month(datePublished)::INTEGER AS m FROM slim",
)

# --- vendor/product maps ------------------------------------------------------------------
_RAW_V = "CASE WHEN line = 1 THEN ' ' || vendor || ' ' WHEN line = 2 THEN lower(vendor) WHEN vendor = 'V7' THEN 'N/A' ELSE vendor END"
# Two builds of the map: one from either half of the rows.
_NEW_B, _OLD_B = "status = 'O'", "status = 'F'"


def edges(spark, sf_dir, where="true"):
    raw = feed.records(spark, sf_dir).where(where).selectExpr(f"{_RAW_V} AS v", "product", "cveId")
    return maps.build_map(raw, "v", "product", "cveId")


def _edges_sql(where: str, extra: str = "") -> str:
    return (
        f"(SELECT DISTINCT lower(trim({_RAW_V})) AS vendor, lower(product) AS product, cveId{extra} "
        f"FROM records WHERE ({where}) AND lower(trim({_RAW_V})) <> 'n/a')"
    )


MAP_SQL = f"WITH {sql.RECORDS}, e AS {_edges_sql('true')}, n AS {_edges_sql(_NEW_B)}, o AS {_edges_sql(_OLD_B)}"
add("agg17_vendor_product_map", edges, MAP_SQL + " SELECT vendor, product, cveId FROM e")
add(
    "agg17_map_sizes",
    lambda s, d: maps.map_sizes(edges(s, d)),
    MAP_SQL + " SELECT vendor, product, count(*) AS cve_count FROM e GROUP BY ALL",
)
add(
    "agg17_packed_map",
    lambda s, d: maps.pack(stored(edges(s, d), "edges"), 100).select("vendor", "product", F.explode("cves").alias("cveId")),
    MAP_SQL + " SELECT vendor, product, cveId FROM e",
)
def _meta(spark, sf_dir):
    def build(where, day):
        return maps.build_meta(edges(spark, sf_dir, where), "nvd_ts", F.lit(day).cast("timestamp"))

    known = stored(build(_OLD_B, "2000-12-20"), "meta")  # meta tables are written tables
    new = stored(build(_NEW_B, "2001-01-01").unionByName(build("true", "2000-12-20")), "meta")
    return flat(maps.record_build(known, new))


add(
    "agg18_build_meta",
    _meta,
    MAP_SQL + " SELECT 'nvd_ts' AS collection, '2000-12-20 00:00:00' AS ts, count(DISTINCT (vendor, product)) AS count FROM o "
    "UNION ALL SELECT 'nvd_ts', '2001-01-01 00:00:00', count(DISTINCT (vendor, product)) FROM n",
)
add(
    "agg19_cpe_hierarchy",
    lambda s, d: maps.cpe_hierarchy(slim(s, d).selectExpr("'cpe:2.3:a:' || vendor || ':' || product || IF(line = 1, '', ':' || flag || ':*') AS name"), "name"),
    f"WITH {SLIM_SQL} SELECT DISTINCT 'prefix:cpe' AS index_key, 'a' AS member FROM slim UNION SELECT 'a', vendor FROM slim "
    "UNION SELECT 'v:' || vendor, product FROM slim UNION SELECT 'p:' || product, flag || ':*' FROM slim WHERE line <> 1",
)
add(
    "agg20_browse_vendors",
    lambda s, d: maps.browse_vendors(edges(s, d, OLD), edges(s, d, NEW)),
    MAP_SQL + " SELECT DISTINCT vendor FROM e",
)
add(
    "agg20_browse_products",
    lambda s, d: maps.browse_products("v1", edges(s, d, OLD), edges(s, d, NEW)),
    MAP_SQL + " SELECT DISTINCT product FROM e WHERE vendor = 'v1'",
)
add(
    "jn8_lookup_previous_build",
    lambda s, d: maps.pair_changes(edges(s, d, _NEW_B), edges(s, d, _OLD_B)),
    MAP_SQL + ", j AS (SELECT vendor, product, cveId, n.x AS a, o.x AS b FROM (SELECT *, 1 AS x FROM n) n "
    "FULL OUTER JOIN (SELECT *, 1 AS x FROM o) o USING (vendor, product, cveId)) "
    "SELECT vendor, product, count(a) AS new_count, count(b) AS old_count, count(*) FILTER (b IS NULL) AS added, "
    "count(*) FILTER (a IS NULL) AS removed FROM j GROUP BY ALL",
)


def _diff(spark, sf_dir):
    def build(where):
        raw = feed.records(spark, sf_dir).where(where).selectExpr(f"{_RAW_V} AS v", "product", "cveId", "status AS source")
        return maps.build_map(raw, "v", "product", "cveId", ["source"])

    modified = feed.records(spark, sf_dir).where("line = 5").select("cveId")
    return maps.diff_builds(stored(build(_NEW_B), "build"), build(_OLD_B), modified)  # a written build


_DIFF_SQL = (
    f"WITH {sql.RECORDS}, n AS {_edges_sql(_NEW_B, ', status')}, o AS {_edges_sql(_OLD_B, ', status')} "
    "SELECT vendor, product FROM n ANTI JOIN o USING (vendor, product, cveId, status) UNION "
    "SELECT vendor, product FROM o ANTI JOIN n USING (vendor, product, cveId, status) UNION "
    "SELECT vendor, product FROM n WHERE cveId IN (SELECT cveId FROM records WHERE line = 5)"
)
add("cdc1_diff_builds", _diff, _DIFF_SQL)


def _messages(spark, sf_dir):
    """Changed pairs as messages, and whether each batch has the size it should have."""
    sent = stored(maps.pair_messages(stored(_diff(spark, sf_dir), "changed"), F.lit("2025-03-02T00:00:00Z")), "messages")
    sizes = sent.groupBy("batch").agg(F.count("*").alias("size"))
    full = F.col("size") == fixed.BATCH_SIZE
    ends = sizes.agg(F.count_if(~full).alias("short")).withColumn("short", F.col("short") <= 1)
    return sent.select("message_id", "body").crossJoin(F.broadcast(ends))  # one row


add(
    "cdc1_pair_messages", _messages,
    f"WITH d AS ({_DIFF_SQL}) SELECT substr(regexp_replace(vendor || '_' || product, '[^A-Za-z0-9_-]', '_', 'g'), 1, 67) || '-' "
    "|| substr(sha256(vendor || '_' || product), 1, 12) AS message_id, '{\"vendor\":\"' || vendor || '\",\"product\":\"' || product || "
    "'\",\"ingestionTimestamp\":\"2025-03-02T00:00:00Z\"}' AS body, true AS short FROM d",
)
add(
    "srt2_pick_build",
    lambda s, d: flat(maps.pick_build(
        feed.table(s, d, "events").selectExpr("event_type AS collection", "date_trunc('hour', ts) AS ts").distinct(),
        F.lit("2024-01-30 20:30:00").cast("timestamp_ntz"), fixed.BUILD_BUFFER_HOURS)),
    "SELECT event_type AS collection, count(DISTINCT date_trunc('hour', ts)) AS builds, max(date_trunc('hour', ts))::VARCHAR AS newest_ts, "
    "coalesce(max(date_trunc('hour', ts)) FILTER (date_trunc('hour', ts) <= TIMESTAMP '2024-01-30 20:30:00' - INTERVAL 72 HOUR), "
    "min(date_trunc('hour', ts)))::VARCHAR AS previous_ts FROM events GROUP BY event_type",
)


def _batches(spark, sf_dir):
    """Every key with the size of its batch, and whether it is in one batch only."""
    rows = stored(slim(spark, sf_dir).select(*KEY).distinct(), "keys")  # read again while numbering
    numbered = stored(running.batch_rows(rows, KEY, fixed.BATCH_SIZE, per_bucket=1000), "batches")
    sizes = numbered.groupBy("batch").agg(F.count("*").alias("rows"))
    full = sizes.agg(F.count_if(F.col("rows") == fixed.BATCH_SIZE).alias("full_batches"), F.count("*").alias("batches"))
    own = numbered.groupBy(*KEY).agg(F.count("*").alias("found"))
    return own.crossJoin(F.broadcast(full))  # one row


add(
    "win4_batch_rows", _batches,
    f"WITH {SLIM_SQL}, k AS (SELECT DISTINCT vendor, product, cveId FROM slim), n AS (SELECT count(*) AS n FROM k) "
    "SELECT k.*, 1::BIGINT AS found, CAST(n // 10 AS BIGINT) AS full_batches, CAST(ceil(n / 10) AS BIGINT) AS batches FROM k, n",
)

# --- history and merges -------------------------------------------------------------------
MASTER = [*SLIM, "validFrom", "validTo", "currentFlag"]
_CUR = f"{OLD} AND flag <> 'N'"
_CLOSED = f"{OLD} AND flag = 'N'"


def master(spark, sf_dir) -> DataFrame:
    current = latest(slim(spark, sf_dir, _CUR)).selectExpr(*SLIM, "datePublished AS validFrom", "CAST(NULL AS TIMESTAMP_NTZ) AS validTo", "true AS currentFlag")
    closed = slim(spark, sf_dir, _CLOSED).selectExpr(*SLIM, "datePublished AS validFrom", "datePublished + INTERVAL '9' DAY AS validTo", "false AS currentFlag")
    return current.unionByName(closed)


def whole_master(spark, sf_dir) -> DataFrame:
    """History from all rows: the newest of each key is current, the others are closed."""
    rows = slim(spark, sf_dir).withColumn("validFrom", F.col("datePublished"))
    ranked = rows.withColumn("currentFlag", F.expr(
        "row_number() OVER (PARTITION BY vendor, product, cveId ORDER BY lastModified DESC NULLS LAST, "
        + ", ".join(f"{c} ASC NULLS LAST" for c in DATA if c != "lastModified") + ") = 1"))
    return ranked.selectExpr(*SLIM, "validFrom", "IF(currentFlag, NULL, datePublished + INTERVAL '9' DAY) AS validTo", "currentFlag")


_WHOLE_SQL = (
    f"WITH {SLIM_SQL}, m AS (SELECT *, datePublished AS validFrom, CASE WHEN currentFlag THEN NULL ELSE datePublished + INTERVAL '9' DAY END AS validTo "
    "FROM (SELECT *, row_number() OVER (PARTITION BY vendor, product, cveId ORDER BY lastModified DESC NULLS LAST, "
    + ", ".join(f"{c} ASC NULLS LAST" for c in DATA if c != "lastModified") + ") = 1 AS currentFlag FROM slim))"
)
_MASTER_SQL = (
    f"WITH {SLIM_SQL}, s AS {_latest_sql(NEW)}, c AS (SELECT *, datePublished AS validFrom, NULL::TIMESTAMP AS validTo, true AS currentFlag "
    f"FROM {_latest_sql(_CUR)}), h AS (SELECT {', '.join(SLIM)}, datePublished AS validFrom, datePublished + INTERVAL '9' DAY AS validTo, "
    f"false AS currentFlag FROM slim WHERE {_CLOSED}), m AS (SELECT * FROM c UNION ALL SELECT * FROM h)"
)
_VALID = "validFrom::VARCHAR AS validFrom, validTo::VARCHAR AS validTo, currentFlag"


def _scd2_sql(changed: str, start: str) -> str:
    cols = ", ".join(f"{{a}}.{c}" for c in SLIM)
    return _MASTER_SQL + (
        f", j AS (SELECT c.*, coalesce({changed}, false) AS changed, {start} AS start FROM c LEFT JOIN s "
        "ON c.vendor = s.vendor AND c.product = s.product AND c.cveId = s.cveId), "
        f"r AS (SELECT {', '.join(SLIM)}, validFrom, CASE WHEN changed THEN start ELSE validTo END AS validTo, NOT changed AS currentFlag FROM j "
        f"UNION ALL SELECT {cols.format(a='s')}, {start}, NULL, true FROM s LEFT JOIN c "
        f"ON c.vendor = s.vendor AND c.product = s.product AND c.cveId = s.cveId WHERE c.cveId IS NULL OR ({changed}) "
        f"UNION ALL SELECT * FROM h) SELECT {SHOW}, {_VALID} FROM r"
    )


add(
    "cdc2_scd2_merge",
    lambda s, d: flat(history.scd2_merge(master(s, d), slim(s, d, NEW), KEY, F.lit(RUN_TS).cast("timestamp_ntz"))),
    _scd2_sql("s.lastModified IS NOT NULL AND (c.lastModified IS NULL OR c.lastModified < s.lastModified)", f"TIMESTAMP '{RUN_TS}'"),
)


def _scd2_hash(spark, sf_dir):
    names = ("validFrom", "validTo", "currentFlag")
    out = history.scd2_merge_by_hash(
        master(spark, sf_dir).withColumn("row_hash", text.row_hash("flag", "line")),
        slim(spark, sf_dir, NEW).withColumn("row_hash", text.row_hash("flag", "line")),
        KEY, F.col("datePublished"), "lastModified", names)
    return flat(out.select(*MASTER))


add("cdc3_scd2_by_hash", _scd2_hash, _scd2_sql(
    "s.cveId IS NOT NULL AND md5(concat_ws('||', s.flag, s.line::VARCHAR)) <> md5(concat_ws('||', c.flag, c.line::VARCHAR))",
    "s.datePublished"))
add(
    "cdc4_merge_changed",
    lambda s, d: flat(history.merge_changed(target(s, d), slim(s, d, NEW), KEY, ["lastModified", "cvssScore"], ["lastModified"])),
    TS + ", j AS (SELECT t.cveId AS tk, s.cveId AS sk, s.cveId IS NOT NULL AND (t.cveId IS NULL OR "
    "coalesce(s.lastModified <> t.lastModified OR s.cvssScore <> t.cvssScore, false)) AS take, "
    + ", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in SLIM)
    + " FROM t FULL OUTER JOIN s ON t.vendor = s.vendor AND t.product = s.product AND t.cveId = s.cveId), r AS (SELECT "
    + ", ".join(f"CASE WHEN take THEN s_{c} ELSE t_{c} END AS {c}" for c in SLIM)
    + f" FROM j) SELECT {SHOW} FROM r",
)
_WM = "TIMESTAMP '2000-06-01 00:00:00'"


def _sync(spark, sf_dir):
    known = stored(master(spark, sf_dir), "master")  # master and warehouse table are written tables
    stamp = F.lit(RUN_TS).cast("timestamp_ntz")
    merged = stored(history.scd2_merge(known, slim(spark, sf_dir, NEW), KEY, stamp), "master")
    before = history.sync_full(known.where("validFrom <= TIMESTAMP_NTZ '2000-06-01 00:00:00'"))
    return flat(history.sync_incremental(before, merged, history.next_watermark(before, stamp)))


_SCD_BODY = _scd2_sql("s.lastModified IS NOT NULL AND (c.lastModified IS NULL OR c.lastModified < s.lastModified)", f"TIMESTAMP '{RUN_TS}'")
_SCD_R = _SCD_BODY[: _SCD_BODY.rindex(" SELECT ")]
add(
    "cdc5_sync_current", _sync,
    _SCD_R + f", b AS (SELECT * FROM m WHERE currentFlag AND validFrom <= {_WM}), w AS (SELECT max(validFrom) AS wm FROM b), "
    "n AS (SELECT * EXCLUDE rn FROM (SELECT r.*, row_number() OVER (PARTITION BY vendor, product, cveId ORDER BY validFrom DESC, "
    + ", ".join(f"{c} ASC NULLS LAST" for c in [*DATA, "validTo", "currentFlag"])
    + ") AS rn FROM r, w WHERE validFrom > wm) WHERE rn = 1), "
    "z AS (SELECT * FROM n UNION ALL SELECT * FROM b ANTI JOIN n USING (vendor, product, cveId)) "
    f"SELECT {SHOW}, {_VALID} FROM z",
)
add(
    "cdc5_sync_full",
    lambda s, d: flat(history.sync_full(whole_master(s, d))),
    _WHOLE_SQL + f" SELECT {SHOW}, {_VALID} FROM m WHERE currentFlag",
)
_LONG = "CASE WHEN line = 2 THEN repeat('x', 1024) || vendor ELSE vendor END"


def _long_keys(spark, sf_dir, mode):
    """Vendors that differ only behind the width of their column: rejected, not merged, either way."""
    known = stored(whole_master(spark, sf_dir).withColumn("vendor", F.expr(_LONG)), "master")
    if mode == "full":
        held = history.sync_full(known)
    else:
        before = history.sync_full(known.where("validFrom <= TIMESTAMP_NTZ '2000-06-01 00:00:00'"))
        held = history.sync_incremental(before, known.where("currentFlag"), history.next_watermark(before))
    rejects = history.sync_rejects(known)
    return flat(held.withColumn("held", F.lit(True)).unionByName(rejects.withColumn("held", F.lit(False))))


for _mode in ("full", "incremental"):
    add(
        f"cdc5_long_keys_{_mode}", partial(_long_keys, mode=_mode),
        _WHOLE_SQL + f", l AS (SELECT * REPLACE ({_LONG} AS vendor) FROM m) SELECT {SHOW}, {_VALID}, line <> 2 AS held FROM l WHERE currentFlag",
    )
add(
    "cdc6_refresh_lookup",
    lambda s, d: flat(history.refresh_lookup(target(s, d), source(s, d).withColumn("extra", F.lit(1)))),
    TS + f" SELECT {SHOW} FROM s UNION ALL SELECT {SHOW} FROM t ANTI JOIN s USING (vendor, product, cveId)",
)
add(
    "cdc8_advance_watermark",
    lambda s, d: flat(history.next_watermark(whole_master(s, d), F.lit(RUN_TS).cast("timestamp_ntz"))),
    _WHOLE_SQL + " SELECT max(validFrom)::VARCHAR AS last_run_ts FROM m",
)


def _levels_after(spark, sf_dir, grain, level):
    """Levels of the old lookup, refreshed for the updated keys only. Lines are dealt out evenly while they are
    narrow, rows of the lookup before they are counted: what a task sorts or counts has a bounded size."""
    rows = enrich(sinks.balanced(feed.records(spark, sf_dir)))
    cols = [*KEY, "datePublished", "lastModified", "severity", "weighted_score", *fixed.RISK_FLAGS, "flag", "orderKey", "line", "price"]
    # Lookup, updates and level tables are written tables in the pipeline.
    old = stored(keys.latest_per_key(rows.where(OLD).select(*cols), KEY, ["lastModified"]), "lookup")
    updates = stored(keys.latest_per_key(rows.where(NEW).select(*cols), KEY, ["lastModified"]), "updates")
    lookup = history.refresh_lookup(old, updates)
    replaced = old.join(keys.key_set(updates, KEY), KEY, "left_semi")
    touched = exposure.touched_grains(grain, updates, replaced)
    before = exposure.level_table(sinks.balanced(old), grain, level, unique=True)
    return flat(exposure.refresh_level(before, lookup, touched, grain, level, unique=True))


_LV_COLS = "vendor product cveId datePublished lastModified severity weighted_score".split() + fixed.RISK_FLAGS + "flag orderKey line price".split()
_LV_TIES = ", ".join(f"{c} ASC NULLS LAST" for c in _LV_COLS if c not in KEY and c != "lastModified")


def _after_sql(grain: str, level: str) -> str:
    def newest(where: str) -> str:
        return (
            f"(SELECT {', '.join(_LV_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY vendor, product, cveId ORDER BY lastModified DESC NULLS LAST, "
            f"{_LV_TIES}) AS rn FROM enriched WHERE {where}) WHERE rn = 1)"
        )

    return (
        f"WITH {sql.ENRICHED}, a AS {newest(OLD)}, b AS {newest(NEW)}, "
        "z AS (SELECT * FROM b UNION ALL SELECT * FROM a ANTI JOIN b USING (vendor, product, cveId)) "
        + sql.level_select(grain, level, source="z")
    )


for _g, _lv in (("daily", "global"), ("daily", "vendor"), ("monthly", "product"), ("monthly", "global"), ("yearly", "vendor")):
    add(f"cdc7_refresh_levels_{_g}_{_lv}", partial(_levels_after, grain=_g, level=_lv), _after_sql(_g, _lv))

# --- sources and serving ------------------------------------------------------------------
add(
    "src3_latest_partition",
    lambda s, d: flat(keys.latest_partition(slim(s, d), "datePublished")),
    f"WITH {SLIM_SQL} SELECT {SHOW} FROM slim WHERE datePublished = (SELECT max(datePublished) FROM slim)",
)
add(
    "src4_read_current",
    lambda s, d: flat(history.read_current(whole_master(s, d))),
    _WHOLE_SQL + f" SELECT {SHOW}, {_VALID}, year(datePublished)::INTEGER AS year_published, datePublished::DATE::VARCHAR AS date_published FROM m WHERE currentFlag",
)
add(
    "src8_upsert_documents",
    lambda s, d: joins.upsert_documents(
        feed.table(s, d, "documents").where("lang <> 'de'"),
        feed.table(s, d, "documents").where("n_chars % 3 = 0").selectExpr("doc_id", "'new: ' || text AS text", "upper(lang) AS lang", "source", "n_chars + 1 AS n_chars"),
        "doc_id", ["n_chars"]),
    "SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN 'new: ' || text ELSE text END AS text, source, CASE WHEN n_chars % 3 = 0 THEN upper(lang) ELSE lang END AS lang, CASE WHEN n_chars % 3 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars "
    "FROM documents WHERE lang <> 'de' OR n_chars % 3 = 0",
)


def _serving(spark, sf_dir, table, make):
    """The table in its serving layout, exported and read back."""
    path = shared_dir(spark, "serving")
    sinks.export_serving(make(spark, sf_dir), table, path)
    return flat(spark.read.parquet(path))


def _serving_sql(table: str, inner: str) -> str:
    time, dims = serving.layout(table)
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE"}
    return (
        f"SELECT {time}::TIMESTAMP::VARCHAR AS __time, "
        + ", ".join(f"CAST({c} AS {kinds[t]}) AS {c}" for c, t in dims.items())
        + f", 1::BIGINT AS rows FROM ({inner})"
    )


def _serve(table: str, make, inner: str) -> None:
    add(f"snk5_serving_{table}", partial(_serving, table=table, make=make), _serving_sql(table, inner))


for _g in fixed.GRAINS:
    for _lv in fixed.LEVELS:
        _serve(f"{_g}_{_lv}", partial(lambda s, d, g, lv: exposure.level_table(feed.enriched(s, d), g, lv), g=_g, lv=_lv), sql.level_sql(_g, _lv))
# Tables that are registered on their own, in serving layout.
for _table, _name in (
    *((f"daily_{lv}_running", f"win1_running_{lv}") for lv in fixed.LEVELS),
    *((f"trailing_{w}_{lv}", f"agg10_trailing_{w}_{lv}") for w in ("12mo", "1mo") for lv in ("vendor", "product")),
    ("exposure_index_thresholds", "agg11_thresholds"),
):
    _serve(_table, QUERIES[_name], CHECKS[_name])
_TEXTS = {c: "flag" for c in fixed.LOOKUP_COLUMNS} | {c: c for c in (*KEY, "datePublished", "cvssVersion", "vectorString")} | {
    "cvssScore": "CAST(cvssScore AS DOUBLE)", "impactScore": "CAST(line AS DOUBLE)", "exploitabilityScore": "CAST(price AS DOUBLE)",
    "year_published": "CAST(year(datePublished) AS INT)", "date_published": "CAST(datePublished AS DATE)", "vulnStatus": "status",
}
_LOOKUP = [f"{e} AS {c}" for c, e in _TEXTS.items()]
_serve("lookup", lambda s, d: feed.records(s, d).selectExpr(*_LOOKUP), f"WITH {sql.RECORDS} SELECT {', '.join(_LOOKUP)} FROM records")
_KEV = {c: "event_type" for c in fixed.KEV_FIELDS} | {"cveID": "'CVE-' || event_id", "dateAdded": "CAST(CAST(ts AS DATE) AS STRING)", "notes": "CAST(NULL AS STRING)"}
_KEV_ROWS = [f"{e} AS {'cveId' if c == 'cveID' else c}" for c, e in _KEV.items()]
_serve("kev_feed", lambda s, d: feed.table(s, d, "events").selectExpr(*_KEV_ROWS), f"SELECT {', '.join(_KEV_ROWS)} FROM events")
_EPSS_ROWS = ["'CVE-' || event_id AS cveId", "value AS epss", "value / 2 AS percentile", "CAST(ts AS DATE) AS date"]
_serve("epss_scores", lambda s, d: feed.table(s, d, "events").selectExpr(*_EPSS_ROWS), f"SELECT {', '.join(_EPSS_ROWS)} FROM events")


# --- stored history -----------------------------------------------------------------------
def _store_merge(spark, sf_dir):
    """Two batches merged into the stored history, the second one twice."""
    root = shared_dir(spark, "history")
    for where, day in ((OLD, "2002-01-01"), (NEW, "2002-01-02"), (NEW, "2002-01-03")):
        store.merge_into(spark, root, slim(spark, sf_dir, where), F.lit(f"{day} 00:00:00").cast("timestamp"))
    return flat(store.read_master(spark, root))


_NEWER = "s.lastModified IS NOT NULL AND (t.lastModified IS NULL OR t.lastModified < s.lastModified)"
_ON = "t.vendor = s.vendor AND t.product = s.product AND t.cveId = s.cveId"
add(
    "cdc2_store_merge", _store_merge,
    TS + f", r AS (SELECT t.*, TIMESTAMP '2002-01-01' AS validFrom, CASE WHEN {_NEWER} THEN TIMESTAMP '2002-01-02' END AS validTo, "
    f"NOT coalesce({_NEWER}, false) AS currentFlag FROM t LEFT JOIN s ON {_ON} UNION ALL "
    f"SELECT s.*, TIMESTAMP '2002-01-02', NULL, true FROM s LEFT JOIN t ON {_ON} WHERE t.cveId IS NULL OR ({_NEWER})) SELECT {SHOW}, {_VALID} FROM r",
)
