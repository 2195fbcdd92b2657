"""Writers and table maintenance on plain files.

Whole tables are never overwritten while they are read: new data goes to a new folder, and
a version marker makes it current. Partition overwrites stage their files first.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions import fixed
from riskloom.operators.serving import serving_view
from riskloom.sources import paths


def balanced(df: DataFrame, *partitions: str) -> DataFrame:
    """Rows placed by table partition before a write. Adaptive execution merges small
    partitions and splits a large one over several tasks, so few, even files result."""
    return df.hint("rebalance", *partitions) if partitions else df.hint("rebalance")


def write_table(
    df: DataFrame, path: str, partitions: list[str] = (), mode: str = "append", sort: list[str] = ()
) -> None:
    """Create, append to or overwrite a partitioned parquet table."""
    out = balanced(df, *partitions)
    if sort:
        out = out.sortWithinPartitions(*partitions, *sort)
    writer = out.write.mode(mode)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def save_table(df: DataFrame, name: str, partitions: list[str] = (), mode: str = "append") -> None:
    """Same for a catalog table, created when absent."""
    writer = balanced(df, *partitions).write.format("parquet").mode(mode)
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)


def overwrite_partitions(df: DataFrame, path: str, partitions: list[str], sort: list[str] = ()) -> None:
    """Replace only the partitions that occur in `df` (which may come from the same folder)."""
    out = balanced(df, *partitions)
    if sort:
        out = out.sortWithinPartitions(*partitions, *sort)
    writer = out.write.mode("overwrite").partitionBy(*partitions)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def build_envelope(df: DataFrame) -> DataFrame:
    """Ingest record: date from the timestamp text, availability from the two arrays."""
    some = "coalesce(size(cvelistv5), 0) > 0 OR coalesce(size(fkie_nvd), 0) > 0"
    return df.selectExpr(
        "substring(ingestionTimestamp, 1, 10) AS ingestionDate", "ingestionTimestamp", "vendor", "product",
        f"{some} AS cveDataAvailable",
        "coalesce(cvelistv5, array()) AS cvelistv5", "coalesce(fkie_nvd, array()) AS fkie_nvd",
    )


#: Rows of a file of JSON lines, at most: a compressed one is read by a single task.
FILE_ROWS = 100_000
#: Files that a task of a partitioned write holds open; with more folders its rows are sorted first.
OPEN_FILES = 64


def write_ndjson_shards(df: DataFrame, path: str, shards: int, gzip: bool = False, per_file: int = FILE_ROWS) -> None:
    """Rows as JSON lines in `shards` files, or as many more as hold about `per_file` rows each; columns in frame
    order, nulls kept. The rows are counted first."""
    text = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    files = max(shards, math.ceil(df.count() / per_file))
    writer = text.repartition(files).write.mode("overwrite")
    (writer.option("compression", "gzip") if gzip else writer).text(path)


def write_documents(df: DataFrame, path: str, folders: list[str], per_file: int = FILE_ROWS) -> None:
    """Rows as compressed JSON lines in folders, at most `per_file` in a file. Rows placed by folder before (see
    `balanced`) give few files; they are written in passing, not sorted, unless a task has very many folders."""
    spark, key = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        df.write.option("compression", "gzip").option("maxRecordsPerFile", per_file).partitionBy(*folders).json(path)
    finally:
        spark.conf.set(key, before)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV export, nested columns as JSON. `single_file` is for readers that insist on one
    file: it funnels the whole table through one task, so it is off by default."""
    nested = ("array", "struct", "map")
    flat = df.select(
        *[(F.to_json(c) if t.startswith(nested) else F.col(c)).alias(c) for c, t in df.dtypes]
    )
    out = flat.coalesce(1) if single_file else flat
    out.write.mode("overwrite").option("header", True).csv(path)


def export_parquet(df: DataFrame, path: str, sort: list[str] = ()) -> None:
    out = balanced(df)
    (out.sortWithinPartitions(*sort) if sort else out).write.mode("overwrite").parquet(path)


def export_serving(df: DataFrame, table: str, path: str, by_day: bool = False) -> None:
    """Typed serving table, one folder for everything or one per day."""
    view = serving_view(df, table)
    if by_day:
        overwrite_partitions(view.withColumn("day", F.to_date("__time")), path, ["day"])
    else:
        write_table(view, path, mode="overwrite")


def export_new_files(
    spark: SparkSession, table_path: str, out: str, state: str, backfill: bool,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Export what was added to a parquet table since the last call.

    The stream checkpoint in `state` remembers exported files; a call without new files
    writes nothing. A backfill exports everything again; the first call must be one.
    """
    if backfill:
        paths.remove(spark, state)
        paths.remove(spark, out)
    if not backfill and not paths.exists(spark, state):
        raise RuntimeError(f"nothing exported from {table_path} yet: run a backfill first")
    schema = spark.read.parquet(table_path).schema
    rows = shape(spark.readStream.schema(schema).parquet(table_path))
    query = rows.writeStream.format("parquet").option("checkpointLocation", state)
    query.trigger(availableNow=True).start(out).awaitTermination()


# --- versioned tables -----------------------------------------------------------------------
def versions(spark: SparkSession, root: str) -> list[str]:
    return paths.child_names(spark, f"{root}/_versions")


def read_version(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """Current (or a given) version of a table."""
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no version of {root}")
    return spark.read.parquet(f"{root}/{version or known[-1]}")


def swap_table(df: DataFrame, root: str, partitions: list[str] = (), sort: list[str] = ()) -> str:
    """Write a new version next to the current one, then make it current.

    The marker file is created last and only once: readers see the old or the new version,
    a lost job leaves an unused folder, and of two writers one fails.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    version = f"v{int(known[-1][1:]) + 1 if known else 1:08d}"
    write_table(df, f"{root}/{version}", partitions, mode="overwrite", sort=sort)
    paths.create_once(spark, f"{root}/_versions/{version}")
    return version


def expire_versions(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Drop all but the newest versions."""
    old = versions(spark, root)[:-keep]
    for v in old:
        paths.remove(spark, f"{root}/_versions/{v}")
        paths.remove(spark, f"{root}/{v}")
    return old


def compact(
    spark: SparkSession, roots: dict[str, list[str]], target_bytes: int = fixed.TARGET_FILE_BYTES
) -> dict[str, str]:
    """Rewrite versioned tables (root -> partition columns) into files near `target_bytes`.

    The row count must stay the same. A failing table is reported and the others go on;
    the result maps each failed root to its error.
    """
    failed = {}
    size_key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before_size = spark.conf.get(size_key)
    spark.conf.set(size_key, str(target_bytes))
    try:
        for root, partitions in roots.items():
            try:
                current = read_version(spark, root)
                before = current.count()
                known = versions(spark, root)
                version = f"v{int(known[-1][1:]) + 1:08d}"
                per_file = max(1, math.ceil(before * target_bytes / max(1, paths.total_bytes(spark, f"{root}/{known[-1]}"))))
                rows = balanced(current, *partitions).write.mode("overwrite").option("maxRecordsPerFile", per_file)
                (rows.partitionBy(*partitions) if partitions else rows).parquet(f"{root}/{version}")
                after = spark.read.parquet(f"{root}/{version}").count()
                if before != after:
                    raise ValueError(f"row count changed from {before} to {after}")
                paths.create_once(spark, f"{root}/_versions/{version}")
            except Exception as e:  # report and go on with the other tables
                failed[root] = str(e)
    finally:
        spark.conf.set(size_key, before_size)
    return failed
