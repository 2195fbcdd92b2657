"""DuckDB query texts that the registered queries are checked against.

They state each result in the plainest way (count distinct, joins, windows), on purpose
unlike the plans of the library.
"""

from __future__ import annotations

from riskloom.plans import feed

AS_OF = "2001-06-30"
CUT = "1999-01-01"


def _metric(name: str) -> str:
    return f"coalesce(regexp_extract(vectorString, '(^|/){name}:([^/]+)', 2), '')"


FEED = f"feed AS ({feed.columns_sql()})"
RECORDS = (
    FEED + ", records AS (SELECT *, CASE WHEN cvssScore >= 9 THEN 'Critical' WHEN cvssScore >= 7 THEN 'High' "
    "WHEN cvssScore >= 4 THEN 'Medium' WHEN cvssScore IS NOT NULL THEN 'Low' ELSE '' END AS severity FROM feed)"
)
PARSED = RECORDS + ", parsed AS (SELECT *, " + ", ".join(
    f"{_metric(m)} AS m_{m}" for m in ("AV", "AC", "C", "I", "A")
) + ", " + ", ".join(
    f"CASE WHEN cvssVersion <> '2.0' THEN {_metric(m)} ELSE '' END AS m_{m}" for m in ("PR", "UI", "S")
) + f", CASE WHEN cvssVersion = '2.0' THEN {_metric('Au')} ELSE '' END AS m_Au FROM records)"
FLAGS = PARSED + """, flags AS (SELECT *,
 m_AV = 'N' AS is_network_based,
 (cvssVersion <> '2.0' AND m_UI = 'N') OR (cvssVersion = '2.0' AND m_Au = 'N') AS is_no_ui,
 (cvssVersion <> '2.0' AND m_PR IN ('L', 'N')) OR (cvssVersion = '2.0' AND m_Au = 'N') AS is_low_priv,
 cvssVersion <> '2.0' AND m_S = 'C' AS is_scope_changed,
 m_C = 'H' AS is_high_conf, m_I = 'H' AS is_high_int, m_A = 'H' AS is_high_avail FROM parsed)"""
ENRICHED = FLAGS + """, enriched AS (SELECT *,
 is_network_based AND is_no_ui AND is_low_priv AND (is_scope_changed OR cvssVersion = '2.0')
   AND (is_high_conf OR is_high_int OR is_high_avail) AS is_fully_critical,
 CASE severity WHEN 'Critical' THEN cvssScore * 1.00 WHEN 'High' THEN cvssScore * 0.75
   WHEN 'Medium' THEN cvssScore * 0.50 WHEN 'Low' THEN cvssScore * 0.25 ELSE 0 END AS weighted_score
 FROM flags)"""

_CONDITIONS = {
    "critical_count": "severity = 'Critical'",
    "high_count": "severity = 'High'",
    "medium_count": "severity = 'Medium'",
    "low_count": "severity = 'Low'",
    "network_cves": "is_network_based",
    "no_ui_cves": "is_no_ui",
    "low_priv_cves": "is_low_priv",
    "fully_critical_cves": "is_fully_critical",
}
_KEYS = {"global": [], "vendor": ["vendor"], "product": ["vendor", "product"]}
_PAIR = {"global": "cveId || '|' || vendor || '|' || product", "vendor": "cveId || '|' || product"}
INDEX = "coalesce(CAST(round(sum(weighted_score), 2) AS DOUBLE), 0.0) AS exposure_index"


def measures(level: str) -> str:
    out = [
        INDEX,
        "coalesce(CAST(round(sum(weighted_score) FILTER (is_network_based), 2) AS DOUBLE), 0.0) AS network_exposure_index",
        "count(DISTINCT cveId) AS distinct_cves",
    ]
    for name, cond in _CONDITIONS.items():
        out.append(f"count(DISTINCT cveId) FILTER ({cond}) AS distinct_{name}")
    if level != "product":
        pair = _PAIR[level]
        out.append("count(DISTINCT product) AS affected_products")
        out.append(f"count(DISTINCT {pair}) AS total_cves")
        for name, cond in _CONDITIONS.items():
            out.append(f"count(DISTINCT {pair}) FILTER ({cond}) AS {name}")
    if level == "global":
        out.append("count(DISTINCT vendor) AS affected_vendors")
    return ", ".join(out)


_GRAIN = {
    "daily": (["year(datePublished)", "CAST(datePublished AS DATE)"], ["year_published", "date_published"]),
    "monthly": (
        ["year(datePublished)", "month(datePublished)", "date_trunc('month', datePublished)"],
        ["year_published", "month_published", "month_date"],
    ),
    "yearly": (["year(datePublished)", "date_trunc('year', datePublished)"], ["year_published", "year_date"]),
}


def _typed(expr: str, name: str) -> str:
    if name.endswith("_published") and not name.startswith("date"):
        return f"CAST({expr} AS INTEGER) AS {name}"
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR) AS {name}"


def level_select(grain: str, level: str, what: str | None = None, source: str = "enriched") -> str:
    exprs, names = _GRAIN[grain]
    keys = _KEYS[level]
    cols = [*keys, *[_typed(e, n) for e, n in zip(exprs, names)]]
    return (
        f"SELECT {', '.join(cols)}, {what or measures(level)} FROM {source} "
        f"GROUP BY {', '.join([*keys, *exprs])}"
    )


def level_sql(grain: str, level: str) -> str:
    return f"WITH {ENRICHED} {level_select(grain, level)}"


def trailing_sql(months: int, level: str) -> str:
    keys = _KEYS[level]
    start = f"CAST(DATE '{AS_OF}' - INTERVAL '{months}' MONTH AS DATE)"
    return (
        f"WITH {ENRICHED} SELECT {', '.join(keys)}, {measures(level)}, "
        f"CAST({start} AS VARCHAR) AS window_start, '{AS_OF}' AS window_end "
        f"FROM enriched WHERE datePublished >= {start} GROUP BY {', '.join(keys)}"
    )


def running_sql(level: str) -> str:
    part = f"PARTITION BY {', '.join(_KEYS[level])} " if _KEYS[level] else ""
    return (
        f"WITH {ENRICHED}, daily AS ({level_select('daily', level)}) SELECT *, "
        f"CAST(round(sum(CAST(exposure_index AS DECIMAL(28,2))) OVER ({part}ORDER BY date_published "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS DOUBLE) AS cumulative_exposure_index FROM daily"
    )


def _all_levels() -> str:
    parts = [
        f"SELECT '{g}_{lv}' AS level, exposure_index FROM ({level_select(g, lv, INDEX)})"
        for g in _GRAIN for lv in _KEYS
    ]
    return f"{ENRICHED}, idx AS ({' UNION ALL '.join(parts)})"


def union_levels_sql() -> str:
    return f"WITH {_all_levels()} SELECT level, exposure_index FROM idx"


_STATS = """, stats AS (SELECT level, count(*) AS total_count, min(exposure_index) AS min_val,
 quantile_disc(exposure_index, 0.25) AS p25, quantile_disc(exposure_index, 0.5) AS p50,
 quantile_disc(exposure_index, 0.75) AS p75, max(exposure_index) AS max_val FROM idx GROUP BY level),
 cuts AS (SELECT *, ceil(p25) AS low_threshold, ceil(p50) AS med_threshold, ceil(p75) AS high_threshold FROM stats)"""


def thresholds_sql() -> str:
    return (
        f"WITH {_all_levels()}{_STATS} SELECT level, total_count, min_val, p25, p50, p75, max_val, "
        f"low_threshold, med_threshold, high_threshold, '{AS_OF} 00:00:00' AS run_ts FROM cuts"
    )


def threshold_ranges_sql() -> str:
    return f"""WITH {_all_levels()}{_STATS}, filled AS (
 SELECT i.level,
  count(*) FILTER (exposure_index = 0) AS cnt_none,
  count(*) FILTER (exposure_index > 0 AND exposure_index <= low_threshold) AS cnt_low,
  count(*) FILTER (exposure_index > low_threshold AND exposure_index <= med_threshold) AS cnt_moderate,
  count(*) FILTER (exposure_index > med_threshold AND exposure_index <= high_threshold) AS cnt_high,
  count(*) FILTER (exposure_index > high_threshold) AS cnt_critical
 FROM idx i JOIN cuts c ON i.level = c.level GROUP BY i.level)
SELECT level, total_count, min_val, round(p25, 2) AS p25, round(p50, 2) AS median, round(p75, 2) AS p75, max_val,
 low_threshold, med_threshold, high_threshold, cnt_none, cnt_low, cnt_moderate, cnt_high, cnt_critical,
 'None = 0' AS range_info,
 'Low = 1 … ' || CAST(low_threshold AS BIGINT) AS range_low,
 'Moderate = ' || CAST(low_threshold + 1 AS BIGINT) || ' … ' || CAST(med_threshold AS BIGINT) AS range_moderate,
 'High = ' || CAST(med_threshold + 1 AS BIGINT) || ' … ' || CAST(high_threshold AS BIGINT) AS range_high,
 'Critical = > ' || CAST(high_threshold AS BIGINT) AS range_critical
FROM cuts JOIN filled USING (level)"""


def join_thresholds_sql() -> str:
    return f"""WITH {_all_levels()}{_STATS}
SELECT level, exposure_index, low_threshold, med_threshold, high_threshold FROM idx JOIN cuts USING (level)"""
