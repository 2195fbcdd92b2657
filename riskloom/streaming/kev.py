"""Exploited-vulnerability stream: append what the last published list did not have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.text import kev_key
from riskloom.sources import paths, sinks
from riskloom.sources.feeds import kev_rows
from riskloom.streaming.epss import newest_only


def with_key(items: DataFrame) -> DataFrame:
    return items.withColumn("hash", kev_key("cveID", "dateAdded"))


def publish_list(items: DataFrame, batch_id: int, out: str, state: str, version: str | None = None) -> None:
    """Emit one list (of several in the batch the newest by `version`): rows whose key is not in the last published list are appended, then the
    state becomes this list. Nothing new changes nothing.

    Output goes to a folder per batch and the state is swapped last, so a repeated batch
    gives the same table.
    """
    spark = items.sparkSession
    rows = with_key(newest_only(items, version).drop(version) if version else items)
    if sinks.versions(spark, state):
        known = sinks.read_version(spark, state).select("hash")
        fresh = rows.join(known, "hash", "left_anti")
    else:
        fresh = rows
    folder = f"{out}/batch={batch_id}"
    kev_rows(fresh.drop("hash")).write.mode("overwrite").partitionBy("day").parquet(folder)
    if any(n.startswith("day=") for n in paths.child_names(spark, folder)):
        sinks.swap_table(rows.select("hash").distinct(), state)
        sinks.expire_versions(spark, state)


def kev_stream(lists: DataFrame, out: str, state: str, checkpoint: str, version: str | None = None) -> StreamingQuery:
    """Run over a stream of complete lists. If several may come in one trigger, `version` names the
    column that tells them apart."""
    return (
        lists.writeStream.foreachBatch(lambda df, i: publish_list(df, i, out, state, version))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def kev_distinct(items: DataFrame) -> DataFrame:
    """Stateful form for a stream of single items: each key passes once, ever."""
    return with_key(items).dropDuplicates(["hash"])


def append_stream(rows: DataFrame, out: str, checkpoint: str, partitions: list[str] = ()) -> StreamingQuery:
    """Append a stream to a serving table (no roll-up)."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.trigger(availableNow=True).start(out)
