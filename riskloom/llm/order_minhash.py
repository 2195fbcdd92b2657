"""Near duplicates by order MinHash, verified by banded alignment.

A text's words give k-mers (runs of five), each labelled with its occurrence number. For each of many
hash functions the two smallest labelled k-mers are kept in text order; texts agree in such a sketch
if they share these k-mers *and* their order, which follows edit similarity. Two sketches make a
bucket key. Similarity of two texts is the share of k-mers that an alignment in text order matches,
matched / (all - matched), and must reach 0.8; the threshold bounds how far an alignment can leave
the diagonal, so matches outside that band are left out without loss.

Buckets may hold any number of texts. In those of at most `SMALL` texts all pairs are compared. In a
larger one every text is first compared with the bucket's `HUBS` hubs: the texts that meet most others
in all their buckets, often the original of its copies. All other pairs of a large bucket follow, but for
those already in one group, which can't change the groups. Each text has its k-mers counted in `CELLS`
cells by hash; the counts of two texts differ by at most the k-mers that they don't share, so a pair whose
counts differ too much is below the threshold and needs no alignment. These comparisons grow with the
square of the texts of a bucket that aren't in one group; they are dealt over tasks in blocks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.llm import words
from riskloom.llm.common import stored, table, text_of
from riskloom.llm.exact_dedup import digest
from riskloom.llm.groups import components

SHINGLE, SIMILARITY = 5, 0.8
#: Sketches of two k-mers each, and sketches in a bucket key.
SKETCHES, PER_KEY = 32, 2
#: Largest bucket whose pairs are all compared at once; hubs that come first in a larger one.
SMALL, HUBS = 16, 4
#: Cells of k-mer counts; texts in a block; pairs of a text that are aligned in the first round.
CELLS, BLOCK, NEAREST = 256, 512, 4
_SEEDS = np.random.default_rng(5).integers(1, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COLUMNS = 4096


def two_smallest(kmers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash function the places of the two smallest k-mers, first one first in the text."""
    best = np.full((SKETCHES, 2), np.iinfo(np.uint64).max, np.uint64)
    place = np.zeros((SKETCHES, 2), np.int64)
    rows = np.arange(SKETCHES)
    for at in range(0, len(kmers), _COLUMNS):
        values = _SEEDS[:, None] * kmers[None, at : at + _COLUMNS]
        for _ in range(min(2, values.shape[1])):
            where = values.argmin(1)
            low = values[rows, where]
            values[rows, where] = np.iinfo(np.uint64).max
            first, second = low < best[:, 0], (low >= best[:, 0]) & (low < best[:, 1])
            best[first, 1], place[first, 1] = best[first, 0], place[first, 0]
            best[first, 0], place[first, 0] = low[first], where[first] + at
            best[second, 1], place[second, 1] = low[second], where[second] + at
    return place.min(1), place.max(1)


def bucket_keys(kmers: np.ndarray) -> np.ndarray:
    """Bucket keys of a text from its k-mers."""
    kmers = words.mixed(words.labelled(kmers))
    if len(kmers) > 1:
        first, second = two_smallest(kmers)
        sketch = words.mixed(kmers[first] * np.uint64(3) + words.mixed(kmers[second]))
    else:
        sketch = np.repeat(kmers, SKETCHES)
    parts = sketch.reshape(-1, PER_KEY)
    key = np.arange(len(parts), dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
    for j in range(PER_KEY):
        key = words.mixed(key + parts[:, j] * np.uint64(2 * j + 1))
    return key.view(np.int64)


def cell_counts(kmers: np.ndarray) -> np.ndarray:
    """K-mers in each cell, those above 255 as 255, which never makes two texts differ more."""
    cell = (kmers >> np.uint64(32)).astype(np.int64) % CELLS
    return np.minimum(np.bincount(cell, minlength=CELLS), 255).astype(np.uint8)


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Share of k-mers matched in text order within the band; 0 for a text without words."""
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return 0.0
    band = int(total * (1 - least) / (1 + least)) + 1
    _, at_a, at_b = np.intersect1d(words.labelled(a), words.labelled(b), assume_unique=True, return_indices=True)
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    chain = at_b[np.abs(at_a - at_b) <= band]
    if (np.diff(chain) > 0).all():
        matched = len(chain)
    else:
        tails: list[int] = []
        for x in chain.tolist():
            k = bisect_left(tails, x)
            tails[k : k + 1] = [x]
        matched = len(tails)
    return matched / (total - matched)


def sketched(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, digest, n (k-mers), keys and counts by cell of each document with an id; map-only."""
    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), digest(text).alias("digest"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.small(batches, 2):
            hashed, at = words.lower_words(batch.column(2))
            sizes, keys, counts = [], [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                kmers = words.shingles(hashed[a:b], SHINGLE)
                sizes.append(len(kmers))
                keys.append(bucket_keys(kmers) if len(kmers) else np.empty(0, np.int64))
                counts.append(cell_counts(kmers).tobytes())
            ends = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32))
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, flat), pa.array(counts, pa.binary())],
                names=["id", "digest", "n", "keys", "cells"],
            )

    return rows.mapInArrow(run, "id long, digest string, n long, keys array<long>, cells binary")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity, with it. `texts`: id, text.

    Texts meet their pairs by sorted partitions at every size, never by broadcast.
    """
    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")).hint("merge")
    wide = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.small(batches, 2, 3):
            (left, at), (right, to) = (words.lower_words(batch.column(k)) for k in (2, 3))
            alike = [
                aligned(words.shingles(left[at[k] : at[k + 1]], SHINGLE), words.shingles(right[to[k] : to[k + 1]], SHINGLE))
                for k in range(len(batch))
            ]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(alike, pa.float64())], names=["a", "b", "similarity"])
            yield out.filter(pa.array([s >= SIMILARITY for s in alike], pa.bool_()))

    return wide.mapInArrow(run, "a long, b long, similarity double")


def candidates(members: DataFrame) -> DataFrame:
    """Pairs a < b to compare, each once. `members`: key, id, n of buckets with several texts.

    Pairs whose numbers of k-mers rule the similarity out are left out.
    """
    sizes = stored(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "bucket_sizes")
    rows = stored(members.join(sizes, "key"), "buckets")
    met = stored(rows.groupBy("id").agg(F.sum("size").alias("met")), "met")
    large = rows.where(F.col("size") > SMALL).select("key", "id", "n")
    order = Window.partitionBy("key").orderBy(F.col("met").desc(), "id")
    hubs = large.join(met, "id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= HUBS)
    hubs = stored(hubs.select("key", F.col("id").alias("other"), F.col("n").alias("other_n")), "hubs")
    fits = F.least("n", "other_n") >= SIMILARITY * F.greatest("n", "other_n")
    few = rows.where(F.col("size") <= SMALL).select("key", "id", "n")
    beside = few.select("key", F.col("id").alias("other"), F.col("n").alias("other_n"))
    small = few.join(beside, "key").where(F.col("id") < F.col("other")).where(fits)
    stars = large.join(hubs, "key").where(F.col("id") != F.col("other")).where(fits)
    both = small.select("id", "other").unionByName(stars.select("id", "other"))
    return both.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def compare_counts(rows: pa.Table) -> pa.Table:
    """Pairs a < b of one block, or of two, that aren't in one group and whose counts let them reach the
    similarity; `apart` is the difference of the counts."""
    ids, n, label, own, block = (rows[c].to_numpy() for c in ("id", "n", "label", "own", "block"))
    cells = np.frombuffer(b"".join(rows["cells"].to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int16)
    across = block.min() != block.max()
    left, right, apart = [], [], []
    for i in range(len(ids) - 1):
        may = (label[i + 1 :] != label[i]) & (own[i + 1 :] | own[i])
        may &= np.minimum(n[i + 1 :], n[i]) >= SIMILARITY * np.maximum(n[i + 1 :], n[i])
        if across:
            may &= block[i + 1 :] != block[i]
        others = np.flatnonzero(may) + i + 1
        if len(others):
            differ = np.abs(cells[others] - cells[i]).sum(1, dtype=np.int64)
            near = differ * (1 + SIMILARITY) <= (n[others] + n[i]) * (1 - SIMILARITY) + 1e-6
            left.append(np.minimum(ids[others[near]], ids[i]))
            right.append(np.maximum(ids[others[near]], ids[i]))
            apart.append(differ[near])
    whole = [np.concatenate([np.empty(0, np.int64), *c]) for c in (left, right, apart)]
    return pa.table(whole, names=["a", "b", "apart"])


def rest(large: DataFrame, labels: DataFrame, cells: DataFrame) -> DataFrame:
    """All pairs a < b of large buckets that are in different groups and may reach the similarity by
    their counts, with `apart`. `large`: key, id, n; `labels`: node, label; `cells`: id, cells.

    Texts within the similarity have numbers of k-mers in the same or in neighbouring bands, so each
    text goes to the unit of its band as an own one and to that below as a guest.
    """
    known = labels.select(F.col("node").alias("id"), "label")
    rows = stored(large.join(known, "id", "left").select("key", "id", "n", F.coalesce("label", "id").alias("label")), "large_buckets")
    band = F.floor(F.log("n") / F.lit(-np.log(SIMILARITY) * (1 + 1e-6)))
    unit = lambda shift, own: F.struct((band - shift).alias("band"), F.lit(own).alias("own"))
    spread = rows.select("key", "id", "n", "label", F.explode(F.array(unit(0, True), unit(1, False))).alias("unit")).select("key", "id", "n", "label", "unit.*")
    units = spread.groupBy("key", "band").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"), F.max("own").alias("any"))
    units = stored(units.where("low < high AND any").select("key", "band", F.ceil(F.col("size") / BLOCK).alias("blocks")), "open_units")
    dealt = spread.join(units, ["key", "band"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = stored(dealt.select("key", "band", "id", "n", "label", "own", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")), "blocks")
    counted = dealt.join(cells.hint("merge"), "id")
    return counted.groupBy("key", "band", "low", "high").applyInArrow(compare_counts, "a long, b long, apart long").distinct()


def grouped(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs with label_a and label_b; a text without links is its own group."""
    for c in ("a", "b"):
        known = labels.select(F.col("node").alias(c), F.col("label").alias("known"))
        pairs = pairs.join(known, c, "left").withColumn(f"label_{c}", F.coalesce("known", c)).drop("known")
    return pairs


def merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """`labels` after links (a, b) among groups: only the groups are connected anew."""
    groups = components(more)
    texts = labels.unionByName(groups.select("node", F.col("node").alias("label"))).distinct()
    known = groups.select(F.col("node").alias("label"), F.col("label").alias("new"))
    return texts.join(known, "label", "left").select("node", F.coalesce("new", "label").alias("label"))


def links(members: DataFrame, texts: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) that span every group, and the groups (node, label).

    The rest of the large buckets is aligned in rounds: every text's nearest pairs first, four times as
    many in the next round, without those that have come into one group meanwhile.
    """
    found = stored(verified(stored(candidates(members), "pairs"), texts).select("a", "b"), "links")
    labels = components(found)
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > SMALL).select("key")
    left = stored(rest(members.join(sizes, "key"), labels, cells), "rest")
    most = NEAREST
    while not left.isEmpty():
        rank = lambda c: F.row_number().over(Window.partitionBy(c).orderBy("apart", "a", "b"))
        ranked = stored(left.withColumn("rank", F.least(rank("a"), rank("b"))), "ranked")
        more = stored(verified(ranked.where(F.col("rank") <= most).select("a", "b"), texts).select("a", "b"), "more_links")
        left = ranked.where(F.col("rank") > most).drop("rank")
        if not more.isEmpty():
            found = stored(found.unionByName(more).distinct(), "links")
            more = stored(grouped(more, labels).select("label_a", "label_b").toDF("a", "b"), "group_links")
            labels = stored(merged(labels, more), "labels")
            left = grouped(left, labels).where("label_a != label_b").select("a", "b", "apart")
        left = stored(left, "rest")
        most *= 4
    return found, labels


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_id, class_id, n_links.

    text_id is the smallest id with the same text, class_id the smallest of the near-duplicate group,
    n_links the number of verified links of the text to other texts (a spanning set, not all pairs).
    Texts without words are only equal to themselves. Rows without an id come back with nulls. Rows
    that share an id count as one document. An empty table gives an empty result; other columns are
    ignored.
    """
    sketch = stored(sketched(docs, doc_id, text), "sketches")
    own = stored(sketch.groupBy("digest").agg(F.min("id").alias("text_id")), "text_ids")
    single = sketch.select("id", "n", "keys").join(own.select(F.col("text_id").alias("id")), "id", "left_semi")
    rows = stored(single.select("id", "n", F.explode("keys").alias("key")), "bucket_rows")
    shared = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"), "shared_keys")
    members = stored(rows.join(shared, "key").select("key", "id", "n"), "bucket_members")
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), text_of(text).alias("text"))
    texts = stored(texts.hint("merge").join(members.select("id").distinct(), "id", "left_semi"), "candidate_texts")
    found, label = links(members, texts, sketch.select("id", "cells").join(members.select("id").distinct(), "id", "left_semi"))
    degree = found.select(F.col("a").alias("node")).unionAll(found.select(F.col("b").alias("node"))).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    known = stored(label.join(degree, "node", "left").select(F.col("node").alias("text_id"), "label", "n_links"), "classes")
    texts_known = stored(own.join(known, "text_id", "left"), "text_classes")
    result = sketch.select("id", "digest").join(texts_known, "digest").select(
        F.col("id").alias("doc_id"), "text_id", F.coalesce("label", "text_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    )
    nothing = F.lit(None).cast("long")
    missing = docs.where(F.col(doc_id).isNull()).select(nothing.alias("doc_id"), nothing.alias("text_id"), nothing.alias("class_id"), nothing.alias("n_links"))
    return result.unionByName(missing)


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each near-duplicate group, that with the smallest id; rows
    without an id stay."""
    gone = stored(classes(docs, doc_id, text).where("doc_id != class_id").select(F.col("doc_id").alias("__gone")), "near_copies")
    return docs.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
