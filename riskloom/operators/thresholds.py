"""Percentile thresholds of the exposure index per level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import fixed
from riskloom.operators.running import prefix_sum


def union_levels(tables: dict[str, DataFrame], value: str = "exposure_index") -> DataFrame:
    """UNION ALL of level tables with a level tag."""
    parts = [df.select(F.lit(name).alias("level"), value) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, value: str = "exposure_index") -> DataFrame:
    """(level, value, count): copies of a value collapse on the map side."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy("level", F.col(value).alias("value"))
        .agg(F.count("*").alias("n"))
    )


def _value_bucket(v: Column) -> Column:
    """Rises with the value: 32 buckets per doubling, so one level spreads over many."""
    size = F.floor(F.log2(F.abs(v) + 1) * 32).cast("bigint")
    return F.when(v < 0, -size - 1).otherwise(size)


def percentiles(counts: DataFrame) -> DataFrame:
    """Exact discrete quartiles, count, min and max per level from value counts.

    The rank of a value is a distributed running count; no level is collected anywhere.
    """
    ranked = prefix_sum(
        counts, ["level"], ["value"], F.col("n"), "rank", _value_bucket(F.col("value")), total="size"
    )
    cuts = [
        F.expr(f"min(IF(rank >= ceil(size * {q}D), value, NULL)) AS {name}")
        for name, q in fixed.QUARTILES.items()
    ]
    return ranked.groupBy("level").agg(
        F.sum("n").alias("total_count"), F.min("value").alias("min_val"), F.max("value").alias("max_val"), *cuts
    )


def approx_percentiles(df: DataFrame, value: str = "exposure_index", accuracy: int = 10_000) -> DataFrame:
    """Same shape from Spark's mergeable sketch, for levels too large to rank."""
    qs = F.percentile_approx(value, list(fixed.QUARTILES.values()), accuracy)
    stats = df.where(F.col(value).isNotNull()).groupBy("level").agg(
        F.count("*").alias("total_count"), F.min(value).alias("min_val"), F.max(value).alias("max_val"),
        qs.alias("_q"),
    )
    picked = {name: F.get("_q", F.lit(i)) for i, name in enumerate(fixed.QUARTILES)}
    return stats.withColumns(picked).drop("_q")


def sketches(df: DataFrame, part: str, value: str = "exposure_index", k: int = 1024) -> DataFrame:
    """(level, part, sketch, total_count, min_val, max_val): one mergeable quantile sketch per level and
    part, to be stored. Sketches combine on the map side; `k` keeps the rank error below half a percent."""
    number = F.col(value).cast("double")
    return df.where(F.col(value).isNotNull()).groupBy("level", F.col(part).alias("part")).agg(
        F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"), F.count("*").alias("total_count"),
        F.min(number).alias("min_val"), F.max(number).alias("max_val"),
    )


def refresh_sketches(known: DataFrame, fresh: DataFrame, touched: DataFrame) -> DataFrame:
    """Stored sketches after a refresh: those of touched parts (level, part) replaced, also where a part has
    no rows any more; all others as they are."""
    return known.join(touched.select("level", "part"), ["level", "part"], "left_anti").unionByName(fresh)


def sketched_percentiles(parts: DataFrame) -> DataFrame:
    """The shape of `percentiles` from stored sketches: one merge per level, the rows aren't read again."""
    merged = parts.groupBy("level").agg(
        F.sum("total_count").alias("total_count"), F.min("min_val").alias("min_val"), F.max("max_val").alias("max_val"),
        F.kll_merge_agg_double("sketch").alias("_s"),
    )
    cuts = {n: F.kll_sketch_get_quantile_double("_s", F.lit(float(q))) for n, q in fixed.QUARTILES.items()}
    return merged.withColumns(cuts).drop("_s")


def rank_errors(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """(level, error): how far the ranks of a level's cut points are from their quartiles, at most, as a
    share of its rows. `counts`: level, value, n; `stats`: level and the cut points, a row per level."""
    rows = counts.join(F.broadcast(stats.select("level", *fixed.QUARTILES)), "level")
    sums = [F.sum("n").alias("_size")]
    for name in fixed.QUARTILES:
        sums += [F.sum(F.when(F.col("value") < F.col(name), F.col("n")).otherwise(0)).alias(f"_below_{name}")]
        sums += [F.sum(F.when(F.col("value") <= F.col(name), F.col("n")).otherwise(0)).alias(f"_upto_{name}")]
    apart = [
        F.greatest(F.col(f"_below_{n}") / F.col("_size") - q, q - F.col(f"_upto_{n}") / F.col("_size"), F.lit(0.0))
        for n, q in fixed.QUARTILES.items()
    ]
    return rows.groupBy("level").agg(*sums).select("level", F.greatest(*apart).alias("error"))


def _ceilings() -> dict[str, Column]:
    return {
        f"{name}_threshold": F.ceil(F.col(p)).cast("double")
        for name, p in zip(("low", "med", "high"), fixed.QUARTILES)
    }


def thresholds(df: DataFrame, run_ts: Column, approximate: bool = False) -> DataFrame:
    """Threshold table: count, min, quartiles, max and the rounded-up cut points."""
    return _table(approx_percentiles(df) if approximate else percentiles(value_counts(df)), run_ts)


def thresholds_from_counts(parts: DataFrame, run_ts: Column) -> DataFrame:
    """`thresholds`, exactly, from stored value counts (level, value, n) of parts of the level tables; rows of
    parts that did not change are not read again."""
    return _table(percentiles(parts.groupBy("level", "value").agg(F.sum("n").alias("n"))), run_ts)


def _table(stats: DataFrame, run_ts: Column) -> DataFrame:
    return stats.withColumns(_ceilings()).select(
        "level", "total_count", "min_val", "p25", "p50", "p75", "max_val",
        "low_threshold", "med_threshold", "high_threshold", run_ts.alias("run_ts"),
    )


def join_thresholds(df: DataFrame, cuts: DataFrame) -> DataFrame:
    """Every row with the cut points of its level (one row per level, at most nine)."""
    return df.join(F.broadcast(cuts), "level")


def threshold_ranges(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Thresholds with rounded quartiles, bucket counts and readable ranges, by level."""
    counts = value_counts(df)
    stats = approx_percentiles(df) if approximate else percentiles(counts)
    cuts = stats.withColumns(_ceilings())
    limits = cuts.select("level", "low_threshold", "med_threshold", "high_threshold")
    v, n = F.col("value"), F.col("n")
    low, med, high = F.col("low_threshold"), F.col("med_threshold"), F.col("high_threshold")
    spans = {
        "cnt_none": v == 0,
        "cnt_low": (v > 0) & (v <= low),
        "cnt_moderate": (v > low) & (v <= med),
        "cnt_high": (v > med) & (v <= high),
        "cnt_critical": v > high,
    }
    filled = join_thresholds(counts, limits).groupBy("level").agg(
        *[F.sum(F.when(c, n).otherwise(0)).cast("bigint").alias(k) for k, c in spans.items()]
    )

    def text(*parts: Column | str) -> Column:
        return F.concat(
            *[F.lit(p) if isinstance(p, str) else p.cast("bigint").cast("string") for p in parts]
        )

    return (
        cuts.join(filled, "level")
        .select(
            "level", "total_count", "min_val",
            F.round("p25", 2).alias("p25"), F.round("p50", 2).alias("median"),
            F.round("p75", 2).alias("p75"), "max_val",
            "low_threshold", "med_threshold", "high_threshold", *spans,
            F.lit("None = 0").alias("range_info"),
            text("Low = 1 … ", low).alias("range_low"),
            text("Moderate = ", low + 1, " … ", med).alias("range_moderate"),
            text("High = ", med + 1, " … ", high).alias("range_high"),
            text("Critical = > ", high).alias("range_critical"),
        )
        .orderBy("level")
    )
