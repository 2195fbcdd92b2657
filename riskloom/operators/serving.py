"""Typed projections for the serving store."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.functions import fixed
from riskloom.operators.exposure import LEVEL_KEYS, measure_names

# Time column per table and the extra text dimensions (fixed values).
TIME_COLUMN = {
    "lookup": "datePublished",
    "daily": "date_published",
    "monthly": "month_date",
    "yearly": "year_date",
    "trailing": "window_end",
    "thresholds": "run_ts",
    "kev_feed": "dateAdded",
    "epss_scores": "date",
}


def _measures(level: str) -> dict[str, str]:
    return {m: "double" if m.endswith("exposure_index") else "bigint" for m in measure_names(level)}


def layout(table: str) -> tuple[str, dict[str, str]]:
    """(time column, dimension -> type) of one of the 20 serving tables.

    Names: `lookup`, `exposure_index_thresholds`, `<grain>_<level>`,
    `daily_<level>_running`, `trailing_<12mo|1mo>_<vendor|product>`, `kev_feed`, `epss_scores`.
    """
    if table == "kev_feed":
        return TIME_COLUMN[table], {"cveId" if c == "cveID" else c: "string" for c in fixed.KEV_FIELDS}
    if table == "epss_scores":
        return TIME_COLUMN[table], {"cveId": "string", "epss": "double", "percentile": "double"}
    if table == "lookup":
        kinds = {"cvssScore": "double", "impactScore": "double", "exploitabilityScore": "double", "year_published": "bigint"}
        dims = {c: kinds.get(c, "string") for c in fixed.LOOKUP_COLUMNS if c != "date_published"}
        return TIME_COLUMN["lookup"], dims
    if table == "exposure_index_thresholds":
        doubles = {c: "double" for c in ("min_val", "p25", "p50", "p75", "max_val")}
        cuts = {c: "bigint" for c in ("low_threshold", "med_threshold", "high_threshold")}
        return TIME_COLUMN["thresholds"], {"level": "string", "total_count": "bigint", **doubles, **cuts, "run_ts": "string"}
    kind, *rest = table.split("_")
    level = rest[1] if kind == "trailing" else rest[0]
    keys = {k: "string" for k in LEVEL_KEYS[level]}
    if kind == "trailing":
        return "window_end", {**keys, **_measures(level), "window_start": "string", "window_end": "string"}
    dims = {**keys, "year_published": "bigint"}
    if kind == "monthly":
        dims["month_published"] = "bigint"
    dims |= _measures(level)
    dims[TIME_COLUMN[kind]] = "string"
    if rest[-1] == "running":
        dims["cumulative_exposure_index"] = "double"
    return TIME_COLUMN[kind], dims


def serving_tables() -> list[str]:
    levels = [f"{g}_{lv}" for g in fixed.GRAINS for lv in fixed.LEVELS]
    running = [f"daily_{lv}_running" for lv in fixed.LEVELS]
    trailing = [f"trailing_{w}_{lv}" for w in ("12mo", "1mo") for lv in ("vendor", "product")]
    return ["lookup", *levels, *running, *trailing, "exposure_index_thresholds", "kev_feed", "epss_scores"]


def serving_view(df: DataFrame, table: str) -> DataFrame:
    """Time column, typed dimensions and a row count of 1; nothing is rolled up."""
    time, dims = layout(table)
    return df.select(
        F.col(time).cast("timestamp").alias("__time"),
        *[F.col(c).cast(t).alias(c) for c, t in dims.items()],
        F.lit(1).cast("bigint").alias("rows"),
    )
