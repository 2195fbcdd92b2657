"""History table stored in parts: current rows by a bucket of their key, closed rows by run.

A merge reads only the buckets that hold keys of the batch, writes only those of them that change and adds
the rows it closed as a part of its own; the closed history, most of the table, is neither read nor rewritten. Both
count from one manifest on, so a merge happens whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions import fixed
from riskloom.operators.history import scd2_changes
from riskloom.operators.keyfilter import split
from riskloom.operators.keys import latest_per_key
from riskloom.sources import parts
from riskloom.sources.parts import PART
from riskloom.sources.staged import stored

#: Buckets within each year of record ids.
BUCKETS = 8


def bucket_of(keys: list[str]) -> Column:
    """Year in the record id and hash of the key: batches mostly hold ids of few years."""
    year = F.regexp_extract(F.coalesce("cveId", F.lit("")), r"-(\d{4})-", 1) if "cveId" in keys else F.lit("")
    return F.concat_ws("-", F.when(year == "", "0").otherwise(year), F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("string")).alias(PART)


def read_master(spark: SparkSession, root: str) -> DataFrame:
    """The whole history: current and closed rows."""
    manifest = parts.current(spark, root)
    whole = parts.read(spark, root, manifest, "current").drop(PART)
    if "closed" not in manifest.tables:
        return whole
    return whole.unionByName(parts.read(spark, root, manifest, "closed").drop(PART))


def _buckets(rows: DataFrame) -> list[str]:
    """Names of the buckets that the rows lie in."""
    return sorted(r[0] for r in rows.select(PART).distinct().collect())


def merge_into(
    spark: SparkSession, root: str, source: DataFrame, run_ts: Column, keys: list[str] = fixed.RECORD_KEY
) -> str:
    """Merge new master rows into the stored history; returns the run's name.

    A first batch is written as it comes. Later ones are stored and compared with the current rows of their
    buckets; only rows that the run closes or inserts are made, and only buckets that get such a row are written.
    """
    old = parts.current(spark, root)
    new = old.next()
    unique = latest_per_key(source, keys, ["lastModified"])
    if not old.number:
        first = unique.withColumns({"validFrom": run_ts, "validTo": F.lit(None).cast("timestamp"), "currentFlag": F.lit(True)})
        parts.write(first.withColumn(PART, bucket_of(keys)), root, new, "current", sort=keys)
    else:
        unique = stored(unique.withColumn(PART, bucket_of(keys)), "batch")
        known = parts.read(spark, root, old, "current", _buckets(unique))
        changes = scd2_changes(known.drop(PART), unique.drop(PART), keys, run_ts, kept=False)
        changes = stored(changes.withColumn(PART, bucket_of(keys)), "changes")
        moved = _buckets(changes)  # a closed row's key has an inserted row too
        if moved:
            closed = changes.where("NOT currentFlag")
            # Null keys are never closed; rows that the filter lets through don't reach a shuffle.
            near, rest = split(parts.read(spark, root, old, "current", moved), closed, keys)
            kept = rest.unionByName(near.join(closed.select(*keys), keys, "left_anti").select(*rest.columns))
            parts.write(kept.unionByName(changes.where("currentFlag")), root, new, "current", moved, sort=keys)
            parts.write(closed.withColumn(PART, F.lit(new.run)), root, new, "closed", [])
    parts.commit(spark, root, new)
    return new.run
