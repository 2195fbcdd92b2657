"""Null profiles, row checks and per-group counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def null_profile(df: DataFrame, columns: list[str], table: str, run_ts: Column) -> DataFrame:
    """One row: total, null percent (two decimals, 0 when empty) and null count per column."""
    counts = df.agg(
        F.count("*").alias("totalRecords"),
        *[F.expr(f"count_if(`{c}` IS NULL) AS `{c}Nulls`") for c in columns],
    )
    percent = [
        f"IF(totalRecords > 0, CAST(round(100.0 * `{c}Nulls` / totalRecords, 2) AS DOUBLE), 0.0D) AS `{c}PercentNull`"
        for c in columns
    ]
    stamped = counts.withColumns(
        {"dqcheckDate": F.to_date(run_ts), "dqcheckTimestamp": run_ts, "stagingTableName": F.lit(table)}
    )
    return stamped.selectExpr(
        "dqcheckDate", "dqcheckTimestamp", "stagingTableName", "totalRecords", *percent,
        *[f"`{c}Nulls`" for c in columns],
    )


def row_checks(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) of several frames."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("stage"), "rows") for n, df in stages.items()]
    return reduce(DataFrame.unionByName, counts)


def watch_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they flow to a later action, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def observed_checks(spark: SparkSession, seen: dict[str, Observation]) -> DataFrame:
    """(stage, rows) of watched frames, after the action that they flowed to; one row per stage."""
    return spark.createDataFrame([(n, o.get["rows"]) for n, o in seen.items()], "stage string, rows long")


def rows_per(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("row_count"))


def distinct_per(df: DataFrame, key: str, member: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.countDistinct(member).alias(name))


def top(df: DataFrame, by: str, n: int, ties: list[str]) -> DataFrame:
    """Top-n report with a total order."""
    return df.orderBy(F.col(by).desc(), *ties).limit(n)
