"""Scalar and nested expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskloom.functions import fixed, nested, scoring, text
from riskloom.plans import check_sql as sql
from riskloom.plans.registry import add_columns

LINE = "orderKey line price"


def _lines(columns: str, base: str = sql.RECORDS, source: str = "records") -> str:
    return f"WITH {base} SELECT orderKey, line, price, {columns} FROM {source}"


# DuckDB keeps the letter below in upper case where Spark writes two.
add_columns(
    "exp1_normalize_cve_id", "documents", "doc_id",
    {"id": lambda: text.normalize_cve_id("source"), "body": lambda: F.md5(text.normalize_cve_id("text"))},
    r"SELECT doc_id, regexp_replace(upper(trim(source)), '[^\x00-\x7F]', '', 'g') AS id, "
    r"md5(regexp_replace(upper(replace(trim(text), 'ß', 'SS')), '[^\x00-\x7F]', '', 'g')) AS body FROM documents",
)
add_columns(
    "exp2_strip_html", "pages", "page_id", {"text": lambda: text.strip_html("html")},
    "SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS text FROM pages",
)
add_columns(
    "exp3_clean_name", "part", "p_partkey",
    {"name": lambda: text.clean_name(F.expr(r"concat('_', replace(p_name, ' ', '_'), '\\\\ ')"))},
    "SELECT p_partkey, array_to_string(list_transform(string_split(trim(replace(p_name, '_', ' ')), ' '), "
    "lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name FROM part",
)
_RAW = (
    "CASE WHEN c_nationkey = 3 THEN ' *** N/A *** ' WHEN c_nationkey = 4 THEN 'n/a' "
    "WHEN c_nationkey = 5 THEN '  ' ELSE ' ' || c_mktsegment || ' ' END"
)
add_columns(
    "exp4_sanitize_key_field", "customer", "c_custkey",
    {"name": lambda: text.sanitize_key_field(F.expr(_RAW))},
    f"SELECT c_custkey, CASE WHEN lower(trim({_RAW})) NOT IN ('', 'n/a', '*** n/a ***') "
    f"THEN lower(trim({_RAW})) END AS name FROM customer",
)
_PART = "regexp_replace(regexp_replace({x}, '[^A-Za-z0-9._-]', '_', 'g'), '^[._-]+', '')"
add_columns(
    "exp5_safe_path", "pages", "page_id",
    {"component": lambda: text.safe_path_component("url"), "path": lambda: text.safe_path("url")},
    f"SELECT page_id, coalesce(nullif({_PART.format(x='url')}, ''), 'file') AS component, "
    f"array_to_string(list_transform(string_split(url, '/'), lambda p: coalesce(nullif({_PART.format(x='p')}, ''), 'file')), '/') AS path "
    "FROM pages",
)
add_columns(
    "exp6_safe_message_id", "pages", "page_id",
    {"message_id": lambda: text.safe_message_id("url", F.col("page_id").cast("string"))},
    "SELECT page_id, substr(regexp_replace(url || '_' || page_id, '[^A-Za-z0-9_-]', '_', 'g'), 1, 67) || '-' "
    "|| substr(sha256(url || '_' || page_id), 1, 12) AS message_id FROM pages",
)
_STAMP = "CASE WHEN line = 1 THEN 'not a date' ELSE replace(CAST(datePublished AS STRING), ' ', 'T') || '.250' END"
add_columns(
    "exp7_parse_timestamps", "records", LINE,
    {"stamp": lambda: text.parse_timestamp(F.expr(_STAMP))},
    _lines(f"CAST(try_cast({_STAMP} AS TIMESTAMP) AS VARCHAR) AS stamp"),
)
add_columns(
    "exp8_compact_timestamp", "events", "event_id",
    {"stamp": lambda: text.compact_timestamp("ts"), "none": lambda: text.compact_timestamp(F.expr("IF(user_id < 9, NULL, ts)"))},
    "SELECT event_id, ts::VARCHAR || ' UTC' AS stamp, "
    "CASE WHEN user_id < 9 THEN '' ELSE ts::VARCHAR || ' UTC' END AS none FROM events",
)
add_columns(
    "exp9_severity", "records", LINE,
    {"master": lambda: scoring.severity("cvssScore"), "lookup": lambda: scoring.severity("cvssScore", "")},
    _lines("nullif(severity, '') AS master, severity AS lookup"),
)
add_columns(
    "exp10_weighted_score", "records", LINE,
    {"weighted": lambda: scoring.weighted_score("cvssScore", "severity").cast("double")},
    _lines("CAST(weighted_score AS DOUBLE) AS weighted", sql.ENRICHED, "enriched"),
)


def _entries(*scores: str) -> Column:
    """CVSS entries built from line columns, one per score text."""
    made = [
        "named_struct('source', flag, 'type', status, 'version', cvssVersion, 'vectorString', "
        f"'v{i}', 'baseScore', CAST({s} AS DOUBLE), 'impactScore', CAST(line AS DOUBLE), "
        f"'exploitabilityScore', CAST({i} AS DOUBLE))"
        for i, s in enumerate(scores)
    ]
    return F.expr(f"IF(line = 2, array(), array({', '.join(made)}))").cast(f"array<{fixed.CVSS_STRUCT}>")


_SCORES = ("cvssScore", "IF(line = 3, NULL, price / 10000)", "line")
_BEST = "greatest(cvssScore::DOUBLE, CASE WHEN line <> 3 THEN price / 10000 END, line::DOUBLE)"
_PICK = (
    f"CASE WHEN line = 2 THEN '' WHEN cvssScore::DOUBLE = {_BEST} THEN 'v0' "
    f"WHEN line <> 3 AND price / 10000 = {_BEST} THEN 'v1' ELSE 'v2' END"
)
add_columns(
    "exp11_choose_cvss", "records", LINE,
    {
        "score": lambda: scoring.choose_cvss(_entries(*_SCORES))["baseScore"],
        "vector": lambda: scoring.choose_cvss(_entries(*_SCORES))["vectorString"],
        "unscored": lambda: scoring.choose_cvss(_entries("NULL"))["version"],
    },
    _lines(
        f"CASE WHEN line <> 2 THEN {_BEST} END AS score, {_PICK} AS vector, "
        "CASE WHEN line = 2 THEN '' END AS unscored"
    ),
)
add_columns(
    "exp12_lookup_fields", "records", LINE,
    {
        n: (lambda n=n: scoring.lookup_fields(scoring.choose_cvss(_entries("cvssScore")))[n])
        for n in ("cvssScore", "cvssVersion", "source", "sourceType", "vectorString", "impactScore", "exploitabilityScore")
    },
    _lines(
        "CASE WHEN line NOT IN (2, 7) THEN cvssScore::DOUBLE END AS cvssScore, "
        "CASE WHEN line = 2 THEN '' WHEN line <> 7 THEN cvssVersion END AS cvssVersion, "
        "CASE WHEN line IN (2, 7) THEN '' ELSE flag END AS source, "
        "CASE WHEN line IN (2, 7) THEN '' ELSE status END AS sourceType, "
        "CASE WHEN line IN (2, 7) THEN '' ELSE 'v0' END AS vectorString, "
        "CASE WHEN line NOT IN (2, 7) THEN line::DOUBLE END AS impactScore, "
        "CASE WHEN line NOT IN (2, 7) THEN 0.0::DOUBLE END AS exploitabilityScore"
    ),
)
_LABELS = (
    "IF(line = 5, NULL, array(named_struct('cweId', 'CWE-' || line, 'cweDescription', IF(flag = 'R', ' ', flag)), "
    "named_struct('cweId', 'CWE-' || status, 'cweDescription', IF(status = 'O', NULL, vendor))))"
)
add_columns(
    "exp13_join_labels", "records", LINE,
    {"labels": lambda: scoring.join_labels(F.expr(_LABELS), "cweId", "cweDescription")},
    _lines(
        "CASE WHEN line = 5 THEN '' ELSE (CASE WHEN flag = 'R' THEN 'CWE-' || line ELSE flag END) || ', ' "
        "|| (CASE WHEN status = 'O' THEN 'CWE-O' ELSE vendor END) END AS labels"
    ),
)
add_columns(
    "exp14_to_json", "records", LINE,
    {"cvssData": lambda: F.to_json(F.expr("array(named_struct('source', flag, 'version', cvssVersion))"))},
    _lines("""'[{"source":"' || flag || '","version":"' || cvssVersion || '"}]' AS cvssData"""),
)
_METRICS = ("AV", "AC", "C", "I", "A", "PR", "UI", "S", "Au")
add_columns(
    "exp15_parse_vector", "records", LINE,
    {f"m_{m}": (lambda m=m: scoring.parse_vector("vectorString", "cvssVersion")[m]) for m in _METRICS},
    _lines(", ".join(f"m_{m}" for m in _METRICS), sql.PARSED, "parsed"),
)
add_columns(
    "exp15_parse_vector_legacy", "records", LINE,
    {m: (lambda m=m: scoring.vector_metric("vectorString", m, legacy=True)) for m in ("C", "I", "S")},
    _lines(", ".join(f"coalesce(regexp_extract(vectorString, '{m}:([^/]+)', 1), '') AS {m}" for m in ("C", "I", "S"))),
)
add_columns(
    "exp17_completeness", "records", LINE,
    {"n": lambda: scoring.completeness(["cveId", "cvssScore", "severity", "status"])},
    _lines("3 + CASE WHEN cvssScore IS NULL THEN 0 ELSE 1 END AS n"),
)
_CPE = r"concat('cpe:2.3:a:', lower(vendor), ':', IF(line = 1, 'a\\:b', lower(product)), IF(line = 6, '', ':1.0:*:x'))"
add_columns(
    "exp18_cpe_fields", "records", LINE,
    {f"cpe_{n}": (lambda n=n: text.cpe_fields(F.expr(_CPE))[n]) for n in ("vendor", "product")},
    _lines(r"lower(vendor) AS cpe_vendor, CASE WHEN line = 1 THEN 'a\:b' ELSE lower(product) END AS cpe_product"),
)
add_columns(
    "exp19_cpe_browse_parts", "records", LINE,
    {n: (lambda n=n: text.cpe_browse_parts(F.expr(_CPE))[n]) for n in ("prefix", "version", "cpetype", "remainder")},
    _lines("'cpe' AS prefix, '2.3' AS version, 'a' AS cpetype, CASE WHEN line <> 6 THEN '1.0:*:x' END AS remainder"),
)
add_columns(
    "exp20_empty_to_null", "records", LINE,
    {"n": lambda: F.size(text.empty_to_null(F.expr("IF(line < 3, array(), array(flag, status))")))},
    _lines("CASE WHEN line >= 3 THEN 2 END AS n"),
)
add_columns(
    "exp21_reorder_struct", "records", LINE,
    {
        "entry": lambda: F.to_json(
            nested.reorder_struct(
                F.expr("array(named_struct('b', status, 'a', flag, 'c', line))"), [("a", "string"), ("b", "string")]
            )
        )
    },
    _lines("""'[{"a":"' || flag || '","b":"' || status || '"}]' AS entry"""),
)
_TEXTS = (
    "array(named_struct('lang', IF(line = 1, 'fr', 'en-US'), 'value', vendor), "
    "named_struct('lang', IF(flag = 'R', 'en', 'de'), 'value', product))"
)
add_columns(
    "exp22_english_only", "records", LINE,
    {
        "n": lambda: F.size(nested.english_only(F.expr(_TEXTS))),
        "n_exact": lambda: F.size(nested.english_only(F.expr(_TEXTS), exact=True)),
        "first": lambda: nested.first_english(F.expr(_TEXTS)),
    },
    _lines(
        "CASE WHEN line <> 1 THEN 1 ELSE 0 END + CASE WHEN flag = 'R' THEN 1 ELSE 0 END AS n, "
        "CASE WHEN flag = 'R' THEN 1 ELSE 0 END AS n_exact, "
        "CASE WHEN line <> 1 THEN vendor WHEN flag = 'R' THEN product END AS first"
    ),
)
add_columns(
    "exp23_date_parts", "records", LINE,
    {
        "y": lambda: F.year("datePublished"), "m": lambda: F.month("datePublished"), "d": lambda: F.to_date("datePublished"),
        "month_date": lambda: F.expr("make_date(year(datePublished), month(datePublished), 1)"),
        "year_ago": lambda: F.add_months(F.to_date("datePublished"), -12),
    },
    _lines(
        "year(datePublished)::INTEGER AS y, month(datePublished)::INTEGER AS m, datePublished::DATE::VARCHAR AS d, "
        "make_date(year(datePublished), month(datePublished), 1)::VARCHAR AS month_date, "
        "(datePublished - INTERVAL 12 MONTH)::DATE::VARCHAR AS year_ago"
    ),
)
add_columns(
    "exp24_row_hash", "records", LINE,
    {"h": lambda: text.row_hash("cveId", F.nullif(F.col("flag"), F.lit("R")), "lastModified")},
    _lines("md5(concat_ws('||', cveId, nullif(flag, 'R'), lastModified::VARCHAR)) AS h"),
)
add_columns(
    "exp25_kev_key", "records", LINE,
    {"h": lambda: text.kev_key("cveId", F.to_date("datePublished").cast("string"))},
    _lines("sha256(cveId || datePublished::DATE::VARCHAR) AS h"),
)
add_columns(
    "exp26_narrow_types", "documents", "doc_id",
    {"body": lambda: text.narrow("text", 128), "chars": lambda: text.narrow("n_chars", 3)},
    "SELECT doc_id, substr(text, 1, 128) AS body, substr(n_chars::VARCHAR, 1, 3) AS chars FROM documents",
)
add_columns(
    "exp27_round2", "lineitem", "l_orderkey l_linenumber l_partkey l_suppkey",
    {"v": lambda: text.round2(F.expr("IF(l_linenumber = 7, NULL, CAST(l_extendedprice AS DECIMAL(14,4)) / 3)"))},
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 7 THEN 0.0 ELSE "
    "round(round(l_extendedprice * 100)::BIGINT::DECIMAL(18,0) / 3::DECIMAL(1,0), 0)::DOUBLE / 100 END AS v FROM lineitem",
)
add_columns(
    "exp28_message_payload", "records", LINE,
    {"body": lambda: text.message_payload("vendor", "product", F.col("datePublished").cast("string"))},
    _lines(
        """'{"vendor":"' || vendor || '","product":"' || product || '","ingestionTimestamp":"' """
        """|| datePublished::VARCHAR || '"}' AS body"""
    ),
)


# Nested documents made of line columns ----------------------------------------------------
def _doc(fields: str, schema: str) -> Column:
    """A document that goes through JSON text like a fetched one."""
    return F.from_json(F.to_json(F.expr(fields)), schema)


_CNA = """named_struct('containers', named_struct(
 'cna', named_struct(
   'impacts', array(named_struct('capecId', 'CAPEC-' || line, 'descriptions',
      array(named_struct('lang', 'en', 'value', vendor), named_struct('lang', 'fr', 'value', product)))),
   'metrics', IF(flag = 'R', array(), array(
      named_struct('cvssV3_1', named_struct('version', '3.1', 'vectorString', 'cna', 'baseScore', line * 1.0D)),
      IF(flag = 'A', named_struct('cvssV3_1', CAST(NULL AS STRUCT<version: STRING, vectorString: STRING, baseScore: DOUBLE>)),
         named_struct('cvssV3_1', named_struct('version', '3.1', 'vectorString', 'cna', 'baseScore', line * 1.0D))))),
   'problemTypes', array(named_struct('descriptions', array(
      named_struct('cweId', 'CWE-' || line, 'description', vendor, 'lang', 'en', 'type', 'CWE'),
      named_struct('cweId', 'CWE-99', 'description', vendor, 'lang', 'fr', 'type', 'CWE'))))),
 'adp', IF(line = 3, NULL, array(named_struct(
   'problemTypes', array(named_struct('descriptions', array(
      named_struct('cweId', IF(status = 'O', NULL, 'CWE-' || (line + 10)), 'description', product, 'lang', 'en-US', 'type', 'CWE')))),
   'metrics', array(named_struct('cvssV3_1',
      named_struct('version', '3.1', 'vectorString', 'adp', 'baseScore', line + 0.5D))))))))"""
_CNA_DOC = {"doc": lambda: _doc(_CNA, fixed.CNA_SCHEMA)}
# The lists that CWEs are in; the rest of the text is skipped while parsing.
_CWE_DOC = {"doc": lambda: _doc(_CNA, f"containers struct<cna:struct<problemTypes:{nested.PROBLEM_TYPE}>,adp:array<struct<problemTypes:{nested.PROBLEM_TYPE}>>>")}
add_columns(
    "nst2_cna_adp_cvss", "records", LINE,
    {
        "entries": lambda: F.array_join(
            F.transform(
                nested.cna_adp_cvss(F.col("doc")["containers"]),
                lambda e: F.concat(e["vectorString"], F.lit(":"), e["baseScore"].cast("string")),
            ),
            ",",
        )
    },
    _lines(
        "concat_ws(',', CASE WHEN flag <> 'R' THEN 'cna:' || line || '.0' END, "
        "CASE WHEN flag IN ('R', 'A') AND line <> 3 THEN 'adp:' || line || '.5' END) AS entries"
    ),
    first=_CNA_DOC,
)
add_columns(
    "nst3_collect_cwe_cna", "records", LINE,
    {
        "cwes": lambda: F.array_join(
            F.transform(
                nested.collect_cwe_cna(F.col("doc")["containers"]),
                lambda e: F.concat(e["cweId"], F.lit("="), e["cweDescription"]),
            ),
            ",",
        )
    },
    _lines(
        "concat_ws(',', 'CWE-' || line || '=' || vendor, CASE WHEN status <> 'O' AND line <> 3 "
        "THEN 'CWE-' || (line + 10) || '=' || product END) AS cwes"
    ),
    first=_CWE_DOC,
)
add_columns(
    "nst4_collect_capec", "records", LINE,
    {
        "capecs": lambda: F.array_join(
            F.transform(
                nested.collect_capec(F.col("doc")["containers"]["cna"]["impacts"]),
                lambda e: F.concat(e["capecId"], F.lit("="), e["capecDescription"]),
            ),
            ",",
        )
    },
    _lines("'CAPEC-' || line || '=' || vendor AS capecs"),
    first=_CNA_DOC,
)
add_columns(
    "nst5_alt_cvss_entry", "records", LINE,
    {
        "entry": lambda: F.to_json(
            nested.bare_cvss(F.expr("named_struct('version', cvssVersion, 'vectorString', flag, 'baseScore', line * 1.0D)"))
        )
    },
    _lines("""'{"version":"' || cvssVersion || '","vectorString":"' || flag || '","baseScore":' || line || '.0}' AS entry"""),
)
_NVD = """named_struct('id', cveId, 'lastModified', CAST(lastModified AS STRING), 'vulnStatus', 'Analyzed',
 'descriptions', array(named_struct('lang', 'es', 'value', product), named_struct('lang', IF(line = 1, 'es', 'en'), 'value', vendor)),
 'metrics', map(
   'cvssMetricV2', array(named_struct('source', flag, 'type', 'Primary', 'impactScore', 2.0D, 'exploitabilityScore', 3.0D,
      'cvssData', named_struct('version', '2.0', 'vectorString', 'a', 'baseScore', line * 1.0D))),
   'cvssMetricV31', IF(line = 4, NULL, array(
      named_struct('source', flag, 'type', 'Primary', 'impactScore', 2.0D, 'exploitabilityScore', 3.0D,
        'cvssData', named_struct('version', '3.1', 'vectorString', 'b', 'baseScore', line + 1.0D)),
      named_struct('source', flag, 'type', 'Primary', 'impactScore', 2.0D, 'exploitabilityScore', 3.0D,
        'cvssData', named_struct('version', '3.1', 'vectorString', 'b', 'baseScore', line + 1.0D))))),
 'weaknesses', IF(line = 5, NULL, array(
   named_struct('description', array(named_struct('lang', 'en', 'value', 'CWE-' || line), named_struct('lang', 'en', 'value', 'NVD-CWE-noinfo'))),
   named_struct('description', array(named_struct('lang', 'en', 'value', 'CWE-' || line), named_struct('lang', 'fr', 'value', 'CWE-1'))))),
 'configurations', array(named_struct('nodes', array(
   named_struct('cpeMatch', array(named_struct('criteria', 'cpe:2.3:a:' || vendor || ':' || product || ':1')))))))"""
_NVD_DOC = {"doc": lambda: _doc(_NVD, fixed.NVD_SCHEMA)}
add_columns(
    "nst6_flatten_metrics_map", "records", LINE,
    {
        "entries": lambda: F.array_join(
            F.array_sort(
                F.transform(
                    nested.flatten_metrics_map(F.col("doc")["metrics"]),
                    lambda e: F.concat(e["version"], F.lit(":"), e["baseScore"].cast("string")),
                )
            ),
            ",",
        )
    },
    _lines(
        "concat_ws(',', '2.0:' || line || '.0', CASE WHEN line <> 4 THEN '3.1:' || (line + 1) || '.0' END) AS entries"
    ),
    first=_NVD_DOC,
)
add_columns(
    "nst7_collect_cwe_nvd", "records", LINE,
    {
        "cwes": lambda: F.array_join(
            F.transform(nested.collect_cwe_nvd(F.col("doc")["weaknesses"]), lambda e: e["cweId"]), ","
        )
    },
    _lines("CASE WHEN line = 5 THEN '' ELSE 'CWE-' || line END AS cwes"),
    first=_NVD_DOC,
)
_NEW = "array(flag, status, vendor)"
_OLD = "IF(line = 1, NULL, array(flag, 'O', product))"
add_columns(
    "nst8_array_set_ops", "records", LINE,
    {
        n: (lambda n=n: (lambda c: c if n == "changed" else F.size(c))(nested.set_changes(F.expr(_NEW), F.expr(_OLD))[n]))
        for n in ("all_ids", "added", "removed", "changed")
    },
    _lines(
        "len(list_distinct([flag, status, vendor] || o))::INTEGER AS all_ids, "
        "len(list_filter([flag, status, vendor], lambda x: NOT list_contains(o, x)))::INTEGER AS added, "
        "len(list_filter(o, lambda x: NOT list_contains([flag, status, vendor], x)))::INTEGER AS removed, "
        "len(list_filter([flag, status, vendor], lambda x: NOT list_contains(o, x))) + "
        "len(list_filter(o, lambda x: NOT list_contains([flag, status, vendor], x))) > 0 AS changed",
        sql.RECORDS + ", both_sets AS (SELECT *, CASE WHEN line = 1 THEN [] ELSE [flag, 'O', product] END AS o FROM records)",
        "both_sets",
    ),
)
add_columns(
    "nst9_first_english", "records", LINE,
    {"description": lambda: nested.first_english(F.col("doc")["descriptions"])},
    _lines("CASE WHEN line <> 1 THEN vendor END AS description"),
    first=_NVD_DOC,
)
