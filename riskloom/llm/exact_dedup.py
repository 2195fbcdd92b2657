"""Exact duplicates: frequent digests are resolved map-side, the others by one shuffle.

A few texts may make up a large share of all rows; their digests would all meet in one task. A
Misra-Gries summary (Spark's frequent-items sketch, which evicts by decrementing counters) finds
candidates for such digests in bounded memory. An exact aggregation of the candidates' rows
verifies them and gives each its winner and size: at most `top` rows, which are broadcast. Rows of
those digests are settled in the map stage; only the rest is shuffled by digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.llm.common import stored, table, text_of

#: Broadcast digests at most, and counters of each summary. A digest that the summaries miss has at
#: most about one row in TRACKED of each summary's share, so no task gets a large group.
TOP, TRACKED, MERGERS = 1000, 4096, 64


def digest(text: str = "text") -> Column:
    """SHA-256 of the unchanged text in UTF-8, lower-case hex; null counts as empty."""
    return F.sha2(text_of(text), 256)


def frequent(rows: DataFrame, key: str, top: int = TOP, tracked: int = TRACKED) -> DataFrame:
    """Column `key`: at most `top` values that may be frequent, never null.

    Each task keeps one summary of `tracked` counters; `MERGERS` tasks merge them first, one task
    merges what those give.
    """
    parts = rows.where(F.col(key).isNotNull()).select(F.col(key), F.expr(f"spark_partition_id() % {MERGERS}").alias("part"))
    sums = parts.groupBy("part").agg(F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("summary"))
    # Grouped by a constant: without a key, a task that gets no summary would have none to pass on.
    whole = sums.groupBy(F.lit(0).alias("all")).agg(F.expr("approx_top_k_combine(summary)").alias("summary"))
    items = whole.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {top})")).alias("found"))
    return items.select(F.col("found.item").alias(key))


def winners(rows: DataFrame, top: int = TOP) -> DataFrame:
    """Verified frequent digests with their exact size and greatest id; at most `top` rows.

    `rows`: doc_id, text_sha256.
    """
    found = F.broadcast(frequent(rows, "text_sha256", top))
    counted = rows.join(found, "text_sha256").groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return counted.where("group_size > 1")


def mark(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", top: int = TOP) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. The row with the greatest id stays. Null
    ids rank last: such a row stays only in a group without any id (its keep_id is null). Rows
    that repeat both id and text are one document and share its mark. Other columns of `docs` are
    ignored. An empty table gives an empty result.
    """
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), digest(text).alias("text_sha256")), "digests")
    known = stored(winners(rows, top), "winners")
    joined = rows.join(F.broadcast(known), "text_sha256", "left")
    group = Window.partitionBy("text_sha256")
    rest = joined.where("group_size IS NULL").select(
        "doc_id", "text_sha256", F.max("doc_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
    )
    both = joined.where("group_size IS NOT NULL").select(*rest.columns).unionByName(rest)
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", top: int = TOP) -> DataFrame:
    """The documents with one row for each text, all columns kept: the row with the greatest id.

    Rows that repeat id and text are reduced to one. Copies of frequent digests are removed
    map-side by their broadcast winners; what is left is shuffled once by digest, after a
    map-side group limit.
    """
    key, keep, size, rank = (f"__{n}" for n in ("digest", "keep", "size", "rank"))
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), digest(text).alias("text_sha256")), "digests")
    known = stored(winners(rows, top), "winners").select(
        F.col("text_sha256").alias(key), F.col("keep_id").alias(keep), F.col("group_size").alias(size)
    )
    left = docs.withColumn(key, digest(text)).join(F.broadcast(known), key, "left")
    left = left.where(F.col(size).isNull() | F.col(doc_id).eqNullSafe(F.col(keep)))
    order = Window.partitionBy(key).orderBy(F.col(doc_id).desc_nulls_last())
    return left.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark(table(spark, sf_dir, "documents"))


CHECK = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
