"""Score stream: the table is replaced as a whole when its content changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.sources import sinks
from riskloom.sources.staged import stored


def content_hash(df: DataFrame) -> DataFrame:
    """One row that identifies the rows of a frame in any order."""
    row = F.xxhash64(*df.columns)
    return df.agg(
        F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).cast("string").alias("total"), F.bit_xor(row).alias("mixed")
    )


def newest_only(rows: DataFrame, version: str) -> DataFrame:
    """Rows of the newest complete file or list in a batch, told by a column that rises from one to
    the next. Several may wait in one trigger; they must never be mixed."""
    return rows.where(F.col(version) == rows.select(F.max(version)).scalar())


def replace_scores(rows: DataFrame, out: str, state: str, version: str = "date") -> bool:
    """Swap in the newest scores unless they equal the published ones; the hash is kept last,
    so a lost run is repeated. Returns whether anything changed."""
    spark = rows.sparkSession
    rows = newest_only(rows, version)
    seen = stored(content_hash(rows.drop("date")), "scores_hash")
    if not seen.where("n > 0").count():
        return False
    if sinks.versions(spark, state):
        same = sinks.read_version(spark, state).join(seen, ["n", "total", "mixed"]).count()
        if same:
            return False
    sinks.swap_table(rows, out)
    sinks.swap_table(seen, state)
    sinks.expire_versions(spark, state)
    return True


def epss_stream(files: DataFrame, out: str, state: str, checkpoint: str) -> StreamingQuery:
    """Run over a stream of complete score files; of several in one trigger the newest counts."""
    return (
        files.writeStream.foreachBatch(lambda df, i: replace_scores(df, out, state) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
