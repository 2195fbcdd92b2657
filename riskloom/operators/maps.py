"""Vendor/product maps: which record ids belong to which pair, per build.

A pair may own a large share of all ids, so a map is kept as distinct
(vendor, product, cveId) rows and never as one array per pair. `pack` gives arrays of
bounded length for readers that want them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import fixed, text
from riskloom.functions.text import cpe_browse_parts, sanitize_key_field
from riskloom.operators.joins import insert_missing
from riskloom.operators.keyfilter import may_match
from riskloom.operators.keys import hot_join, key_set
from riskloom.operators.running import batch_rows
from riskloom.sources.staged import stored

PAIR = ["vendor", "product"]
EDGE = ["vendor", "product", "cveId"]


def build_map(df: DataFrame, vendor: str, product: str, cve: str, extra: list[str] = ()) -> DataFrame:
    """Distinct sanitised pairs with their ids; names are cleaned before the one shuffle.

    `extra` columns (such as the source of a row) become part of the key.
    """
    return (
        df.select(
            *extra,
            sanitize_key_field(vendor).alias("vendor"),
            sanitize_key_field(product).alias("product"),
            F.col(cve).alias("cveId"),
        )
        .where("vendor IS NOT NULL AND product IS NOT NULL")
        .distinct()
    )


def map_sizes(edges: DataFrame) -> DataFrame:
    return edges.groupBy(*PAIR).agg(F.count("cveId").alias("cve_count"))


def pack(edges: DataFrame, size: int = 10_000) -> DataFrame:
    """(vendor, product, part, cves): sorted id arrays of about `size` ids each.

    The ids of a pair spread over ceil(count / size) parts by hash, so the array of a hot
    pair is never built in one place. Only pairs above `size` take part in the join.
    """
    big = map_sizes(edges).where(F.col("cve_count") > size).select(
        *PAIR, F.ceil(F.col("cve_count") / size).alias("_parts")
    )
    spread = hot_join(edges, big, PAIR, "left").withColumn(
        "part", F.expr("pmod(crc32(CAST(cveId AS BINARY)), coalesce(_parts, 1L))")
    )
    return spread.groupBy(*PAIR, "part").agg(F.array_sort(F.collect_list("cveId")).alias("cves"))


def build_meta(edges: DataFrame, collection: str, ts: Column) -> DataFrame:
    """One row (collection, ts, count) about a build; count is its number of pairs."""
    return key_set(edges, PAIR).agg(F.count("*").alias("count")).select(
        F.lit(collection).alias("collection"), ts.alias("ts"), "count"
    )


def record_build(meta: DataFrame, new: DataFrame) -> DataFrame:
    """Meta table with the new builds, existing ones untouched."""
    return insert_missing(meta, new, ["collection", "ts"])


def pick_build(meta: DataFrame, now: Column, hours: float) -> DataFrame:
    """Newest build and the one to compare with, per collection.

    The latter is the newest build at least `hours` old, else the oldest. One build only is
    an error.
    """
    cutoff = now - F.make_dt_interval(mins=F.lit(int(hours * 60)))
    picked = meta.groupBy("collection").agg(
        F.count("*").alias("builds"),
        F.max("ts").alias("newest_ts"),
        F.coalesce(F.max(F.when(F.col("ts") <= cutoff, F.col("ts"))), F.min("ts")).alias("previous_ts"),
    )
    problem = F.concat(F.lit("need two builds for "), F.col("collection"))
    ok = F.when(F.col("builds") < 2, F.raise_error(problem).cast("bigint")).otherwise(F.col("builds"))
    return picked.withColumn("builds", ok)


def compare_builds(new: DataFrame, old: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Every edge of two builds with `side`: 1 only new, 2 only old, 3 both.

    One shuffle on whole edges, nothing grouped by pair.
    """
    keys = [*extra, *EDGE]
    both = new.select(*keys, F.lit(1).alias("side")).unionByName(
        old.select(*keys, F.lit(2).alias("side"))
    )
    return both.groupBy(*keys).agg(F.bit_or("side").alias("side"))


def pair_changes(new: DataFrame, old: DataFrame) -> DataFrame:
    """Per pair the sizes of both builds and of both differences (absent counts as empty)."""
    counts = {
        "new_count": "side IN (1, 3)", "old_count": "side IN (2, 3)",
        "added": "side = 1", "removed": "side = 2",
    }
    return compare_builds(new, old).groupBy(*PAIR).agg(
        *[F.expr(f"count_if({c}) AS {n}") for n, c in counts.items()]
    )


#: Buckets of ids within a pair, each with a digest of its own.
BUCKETS = 64


def build_digests(edges: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Per pair and bucket of ids: their number and a 128-bit digest that knows no order.

    Tasks sum up their own rows first, so what is shuffled grows with the pairs and not with the edges. Edges
    are distinct, as `build_map` gives them.
    """
    bucket = F.pmod(F.xxhash64(F.lit(0), "cveId"), F.lit(BUCKETS)).cast("int").alias("bucket")
    digest = [F.bit_xor(F.xxhash64(F.lit(seed), "cveId")).alias(name) for seed, name in ((1, "_a"), (2, "_b"))]
    return edges.groupBy(*extra, *PAIR, bucket).agg(F.count(F.lit(1)).alias("_n"), *digest)


def changed_buckets(new: DataFrame, old: DataFrame, extra: list[str] = ()) -> DataFrame:
    """(extra, vendor, product, bucket) whose ids differ between two builds; a bucket that one build lacks
    differs. Two different sets pass for equal with probability 2^-128."""
    both = build_digests(new, extra).withColumn("_builds", F.lit(1)).unionByName(build_digests(old, extra).withColumn("_builds", F.lit(1)))
    same = " AND ".join(["count(_builds) = 2", *[f"min({c}) = max({c})" for c in ("_n", "_a", "_b")]])
    return both.groupBy(*extra, *PAIR, "bucket").agg(F.expr(f"{same} AS _same")).where("NOT _same").drop("_same")


def changed_edges(new: DataFrame, old: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Edges that one build has alone, with `side` as in `compare_builds`; only the edges of buckets whose
    digests differ are shuffled. The builds are read twice: hand over tables."""
    keys = [*extra, *PAIR, "bucket"]
    changed = stored(changed_buckets(new, old, extra), "changed_buckets")
    bucket = F.pmod(F.xxhash64(F.lit(0), "cveId"), F.lit(BUCKETS)).cast("int")
    near = [may_match(df.withColumn("bucket", bucket), changed, keys).select(*df.columns) for df in (new, old)]
    return compare_builds(*near, extra).where("side <> 3")


def diff_builds(new: DataFrame, old: DataFrame, changed_ids: DataFrame, source: str = "source") -> DataFrame:
    """Pairs to process again: the id set changed in some source, or an id was modified.

    Builds are edges with a `source` column; `changed_ids` has a `cveId` column. Digests tell which
    pairs changed, edges aren't shuffled for it; edges of unmodified ids drop out where they are read.
    """
    moved = changed_buckets(new, old, [source]).select(*PAIR)
    ids = stored(key_set(changed_ids, ["cveId"]), "modified")
    touched = hot_join(stored(may_match(new, ids, ["cveId"]), "touched"), ids, ["cveId"], "left_semi").select(*PAIR)
    return moved.unionByName(touched).distinct()


def pair_messages(pairs: DataFrame, stamp: Column, size: int = fixed.BATCH_SIZE) -> DataFrame:
    """Queue messages of changed pairs: batch, message_id, body, at most `size` in a batch. `pairs` has a
    row per pair; it is read again while batches are numbered: hand over a table."""
    made = pairs.select(
        text.safe_message_id(*PAIR).alias("message_id"), text.message_payload(*PAIR, stamp).alias("body")
    )
    return batch_rows(made, ["message_id"], size).select("batch", "message_id", "body")


def cpe_hierarchy(df: DataFrame, name: str) -> DataFrame:
    """Browse index as distinct (index_key, member) rows: prefix -> type -> vendor ->
    product -> the rest of the name."""
    parts = df.select(cpe_browse_parts(name).alias("p")).select("p.*")
    steps = (
        "array(struct(concat('prefix:', prefix) AS index_key, cpetype AS member), "
        "struct(cpetype AS index_key, vendor AS member), "
        "struct(concat('v:', vendor) AS index_key, product AS member), "
        "struct(concat('p:', product) AS index_key, remainder AS member))"
    )
    return parts.selectExpr(f"inline({steps})").where("index_key IS NOT NULL AND member IS NOT NULL").distinct()


def browse_vendors(*maps: DataFrame) -> DataFrame:
    """Sorted distinct vendors of all maps."""
    names = [m.select("vendor") for m in maps]
    return reduce(DataFrame.unionByName, names).where("vendor IS NOT NULL").distinct().orderBy("vendor")


def browse_products(vendor: str, *maps: DataFrame) -> DataFrame:
    """Sorted distinct products of one vendor."""
    names = [m.where(F.col("vendor") == vendor).select("product") for m in maps]
    return reduce(DataFrame.unionByName, names).where("product IS NOT NULL").distinct().orderBy("product")
