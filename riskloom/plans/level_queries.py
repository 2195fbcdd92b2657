"""Level tables, trailing windows, running totals and thresholds."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions import fixed
from riskloom.operators import exposure, running, thresholds
from riskloom.plans import check_sql as sql, feed
from riskloom.sources.staged import stored
from riskloom.plans.registry import add, flat

def _as_of():
    return F.lit(sql.AS_OF).cast("date")


def _level(spark: SparkSession, sf_dir: str, grain: str, level: str) -> DataFrame:
    return flat(exposure.level_table(feed.enriched(spark, sf_dir), grain, level))


def _trailing(spark: SparkSession, sf_dir: str, months: int, level: str) -> DataFrame:
    return flat(exposure.trailing_table(feed.enriched(spark, sf_dir), months, level, _as_of()))


def _running(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    daily = exposure.level_table(feed.enriched(spark, sf_dir), "daily", level)
    if level == "global":
        daily = stored(daily, "daily")  # read twice below; one row per day
    return flat(running.running_total(daily, exposure.LEVEL_KEYS[level], "date_published"))


def _indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of all levels, kept in the shared folder since thresholds read it several times
    (in the pipeline the level tables are written tables)."""
    return stored(exposure.index_by_level(feed.enriched(spark, sf_dir)), "levels")


def _union_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed.enriched(spark, sf_dir)
    return thresholds.union_levels(
        {f"{g}_{lv}": exposure.level_table(rows, g, lv) for g in fixed.GRAINS for lv in fixed.LEVELS}
    )


def _thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.lit(sql.AS_OF).cast("timestamp_ntz")
    return flat(thresholds.thresholds(_indexes(spark, sf_dir), stamp))


def _threshold_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.threshold_ranges(_indexes(spark, sf_dir))


def _join_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = _indexes(spark, sf_dir)
    cuts = thresholds.thresholds(idx, F.lit(None).cast("timestamp_ntz"))
    cuts = cuts.select("level", "low_threshold", "med_threshold", "high_threshold")
    return thresholds.join_thresholds(idx, cuts)


_AGG_NO = {"daily": 7, "monthly": 8, "yearly": 9}
for _g in fixed.GRAINS:
    for _lv in fixed.LEVELS:
        add(f"agg{_AGG_NO[_g]}_{_g}_{_lv}", partial(_level, grain=_g, level=_lv), sql.level_sql(_g, _lv))
for _m, _label in ((12, "12mo"), (1, "1mo")):
    for _lv in ("vendor", "product"):
        add(f"agg10_trailing_{_label}_{_lv}", partial(_trailing, months=_m, level=_lv), sql.trailing_sql(_m, _lv))
for _lv in fixed.LEVELS:
    add(f"win1_running_{_lv}", partial(_running, level=_lv), sql.running_sql(_lv))
add("set1_union_levels", _union_levels, sql.union_levels_sql())
add("agg11_thresholds", _thresholds, sql.thresholds_sql())
add("agg12_threshold_ranges", _threshold_ranges, sql.threshold_ranges_sql())
add("jn9_join_thresholds", _join_thresholds, sql.join_thresholds_sql())
