"""Exact Jaccard join of documents' shingle sets as a join in a metric space.

1 - Jaccard similarity is a metric, so pivots divide the sets into Voronoi regions and the triangle
inequality tells which regions can hold links between them.

1. *Pivots.* Sets that share minimum hashes meet under the smallest of them, a pivot. Exact distances
   to these pivots put every set within RADIUS of one into the region of its nearest pivot; every
   other set is the pivot of a region of its own. Members are linked with their pivot, so a group of
   copies of any size shrinks to a few connected regions.
2. *Windows.* Two linked sets share one of their 20 % first shingles in any common order of all
   shingles. Regions in different groups whose members share such a shingle are paired, once per pair
   of regions. With d the exact distance of the two pivots and r1, r2 the regions' radii, a pair with
   d > RADIUS + r1 + r2 holds no link.
3. *Recursion.* Where a pair of regions stays open, the same test recurs between their members: those
   at distances own1 and own2 from their pivots can only be linked if d <= RADIUS + own1 + own2, and if
   they share enough first shingles. What passes is measured exactly, the likeliest first, until the set
   has come into one group with the region or no member is left.

The order of shingles puts common ones last, so the shingles that many documents share (boilerplate,
passages) come into play only for sets that consist of them. What is common follows from exact counts
over all documents; it is kept as a bitmap of fixed size. All steps are exact: the order, the pivots and
the bitmaps decide about the work, not about the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.llm import runs
from riskloom.llm.common import stored, table, text_of
from riskloom.llm.groups import components
from riskloom.llm.words import mixed, windows

SHINGLE = 5
#: A link: PART * intersection >= LEAST * union. RADIUS is the distance that this allows.
PART, LEAST = 100, 80
RADIUS = 1 - LEAST / PART
#: Minimum hashes of a set; how many a set must share with a pivot to be measured against it.
SEEDS, AGREE = 8, 2
#: A shingle in more documents than this is common; the limit is doubled until at most MOST are.
COMMON, MOST = 32, 500_000
#: Bits of the bitmaps, and shingles in a part of the counts.
BITS, COUNTED = 26, 1 << 22
#: Members of a region in a block of the comparison between open regions.
SIDE = 1024
#: Rows (shingle, region) whose pairs one task counts, regions of a shingle in a block, pairs held before they are added up.
ROWS, MET, HELD = 50_000, 2048, 1 << 21
#: Members that a set is measured against first, most shared shingles first; then four times as many, as long as
#: it has come into no group with their region.
FIRST = 8
_WORD = runs.without(bytes([0x20, *range(0x09, 0x0E)]))
_SEEDS = np.random.default_rng(51).integers(1, 2**63, SEEDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MARKS = np.random.default_rng(52).integers(1, 2**63, 2, dtype=np.uint64) | np.uint64(1)
_EPS = 1e-9


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingles of each text, as 64-bit hashes."""
    raw, offsets = runs.lowered(texts)
    starts, ends = runs.bounds(raw, offsets, _WORD)
    value = runs.hashes(raw, starts, ends)
    at = np.searchsorted(starts, offsets)
    whole = windows(value, SHINGLE)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        out.append(np.unique(whole[a : b - SHINGLE + 1] if b - a >= SHINGLE else windows(value[a:b], max(b - a, 1))))
    return out


def mark(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    return tuple(int(mixed(s * m).sum(dtype=np.uint64).view(np.int64)) for m in _MARKS)


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = values >> np.uint64(64 - BITS)
    return (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0


def first_share(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles of a set, common ones last: any set linked with it shares one of its own first."""
    last = in_bitmap(common, s)
    need = -(-LEAST * len(s) // PART)
    return np.concatenate([s[~last], s[last]])[: len(s) - need + 1]


def bitmap(values: DataFrame, column: str) -> np.ndarray:
    """2**BITS bits, those of the 64-bit values set; at most 2**(BITS-6) rows come to the driver."""
    bit = F.shiftrightunsigned(column, 64 - BITS)
    rows = values.select(F.shiftright(bit, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - BITS}) & 63 AS int))").alias("bits"))
    cells = rows.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out.view(np.uint64)


def common_shingles(docs: DataFrame, text: str, count: int) -> DataFrame:
    """`shingle` (its first bits, the others zero): at most MOST that are in more than COMMON documents.

    Tasks count their own shingles and send them packed, 40 bits each, to the part that they belong
    to; the number of parts follows the number of shingles, so a part has a bounded size.
    """
    power = max(0, (count // COUNTED).bit_length())
    low = np.uint64(max(0, 64 - power - 40))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs.parts(batches, 0, 1 << 22):
            found = [s for part in runs.parts([batch], 0) for s in shingle_sets(part.column(0))]
            keys, many = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)
            cut = np.searchsorted(keys, np.arange(1 << power, dtype=np.uint64) << np.uint64(64 - power)) if power else np.zeros(1, np.int64)
            small = np.ascontiguousarray(((keys >> low) & np.uint64(2**40 - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
            ends = np.append(cut[1:], len(keys))
            own = [k for k in range(1 << power) if ends[k] > cut[k]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array([small[cut[k] : ends[k]].tobytes() for k in own], pa.binary()), pa.array([many[cut[k] : ends[k]].astype("<u4").tobytes() for k in own], pa.binary())],
                names=["part", "keys", "many"],
            )

    def counted(rows: pa.Table) -> pa.Table:
        packed = np.frombuffer(b"".join(rows["keys"].to_pylist()), np.uint8).reshape(-1, 5)
        keys = np.zeros((len(packed), 8), np.uint8)
        keys[:, :5] = packed
        keys = keys.view("<u8").ravel()
        many = np.frombuffer(b"".join(rows["many"].to_pylist()), "<u4").astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, many = keys[order], many[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        total = np.add.reduceat(many, first)
        keys, total = keys[first][total > COMMON], total[total > COMMON]
        top = np.uint64(rows["part"][0].as_py()) << np.uint64(64 - power) if power else np.uint64(0)
        return pa.table([(keys.astype(np.uint64) << low | top).view(np.int64), total], names=["shingle", "n"])

    rows = docs.select(text_of(text).alias("text")).mapInArrow(run, "part long, keys binary, many binary")
    found = stored(rows.groupBy("part").applyInArrow(counted, "shingle long, n long"), "common")
    level = F.floor(F.log2(F.col("n") / COMMON))
    sizes = {r[0]: r[1] for r in found.groupBy(level.alias("level")).count().collect()}
    least = 0
    while sum(v for k, v in sizes.items() if k >= least) > MOST:
        least += 1
    return found.where(level >= least).select("shingle")


def parsed(docs: DataFrame, doc_id: str, text: str, common: np.ndarray) -> DataFrame:
    """doc_id, t (hash of the text), a and b (mark of the set), n, rare (shingles that are not common), mins and
    keys of every row; map-only."""
    bits = docs.sparkSession.sparkContext.broadcast(common)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("t"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs.parts(batches, 2):
            found = shingle_sets(batch.column(2))
            marks = [mark(s) for s in found]
            mins = [(_SEEDS[:, None] * s[None, :]).min(1) if len(s) else s for s in found]
            keys = [first_share(s, bits.value) for s in found]
            rare = [int((~in_bitmap(bits.value, s)).sum()) for s in found]
            lists = []
            for values in (mins, keys):
                ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.uint64), *values]).view(np.int64))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1)), pa.array([len(s) for s in found], pa.int64()), pa.array(rare, pa.int64()), *lists],
                names=["doc_id", "t", "a", "b", "n", "rare", "mins", "keys"],
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, t long, a long, b long, n long, rare long, mins array<long>, keys array<long>")


def texts_of(docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """node, text: one text of each node (node, a, b, t). A bitmap of the wanted texts' hashes keeps most
    others from leaving their task; a text found by chance has another mark and finds no node."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(nodes.select("t").distinct(), "t"))
    rows = docs.select(F.xxhash64(text_of(text)).alias("t"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = batch.column(0).to_numpy().view(np.uint64)
            few = batch.filter(pa.array(in_bitmap(bits.value, hashed), pa.bool_()))
            for part in runs.parts([few], 1):
                marks = [mark(s) for s in shingle_sets(part.column(1))]
                yield pa.RecordBatch.from_arrays([*(pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1)), part.column(1)], names=["a", "b", "text"])

    found = rows.mapInArrow(run, "a long, b long, text string")
    rank = F.row_number().over(Window.partitionBy("a", "b").orderBy("a"))
    one = found.withColumn("rank", rank).where("rank = 1").select("a", "b", "text")
    return stored(one.hint("merge").join(nodes.select("node", "a", "b"), ["a", "b"]).select("node", "text"), "candidate_texts")


def measured(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their intersection and union; texts meet their pairs by sorted partitions."""
    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")).hint("merge")
    wide = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs.parts(batches, 2):
            for part in runs.parts([batch], 3):
                left, right = shingle_sets(part.column(2)), shingle_sets(part.column(3))
                both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right, strict=True)], np.int64)
                union = np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)], np.int64) - both
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(both), pa.array(union)], names=["a", "b", "both", "whole"])

    found = wide.mapInArrow(run, "a long, b long, both long, whole long")
    return found.select("a", "b", (1 - F.col("both") / F.col("whole")).alias("d"), (PART * F.col("both") >= LEAST * F.col("whole")).alias("linked"))


def near_pivots(nodes: DataFrame) -> DataFrame:
    """Pairs a (set), b (pivot). Under each minimum hash the set that meets most others under all of its
    own is a pivot for the others: among copies that is one with few changes, often their original. Many copies of
    a large family have all of its minimum hashes; of those the one with the fewest rare shingles, which changes
    make, is within the radius of most others."""
    rows = nodes.select("node", "n", "rare", F.posexplode("mins").alias("seed", "low"))
    several = stored(rows.groupBy("seed", "low").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "meetings")
    rows = stored(rows.join(several, ["seed", "low"]), "met")
    met = rows.groupBy("node").agg(F.sum("size").alias("met"))
    order = F.struct("met", (-F.col("rare")).alias("rare"), (-F.col("node")).alias("node"))
    best = rows.select("node", "rare", "seed", "low").join(met, "node").groupBy("seed", "low").agg(F.max(order).alias("best"))
    pivots = stored(best.select("seed", "low", (-F.col("best.node")).alias("pivot")), "pivots")
    pairs = rows.join(pivots, ["seed", "low"]).where("node != pivot").groupBy("node", "n", "pivot").agg(F.count(F.lit(1)).alias("agree"))
    pairs = pairs.where(F.col("agree") >= F.least(F.lit(AGREE), "n"))
    sized = pairs.join(nodes.select(F.col("node").alias("pivot"), F.col("n").alias("m")), "pivot")
    fits = PART * F.least("n", "m") >= LEAST * F.greatest("n", "m")
    return sized.where(fits).select(F.col("node").alias("a"), F.col("pivot").alias("b"))


def regions(nodes: DataFrame, near: DataFrame, labels: DataFrame) -> DataFrame:
    """node, n, region (its nearest pivot within the radius, else itself), d (distance to it) and label (the
    group so far). A set that is a pivot of others is never in another region."""
    taken = near.where("linked")
    nearest = taken.groupBy("a").agg(F.min(F.struct("d", "b")).alias("to"))
    nearest = nearest.join(taken.select(F.col("b").alias("a")).distinct(), "a", "left_anti").select(F.col("a").alias("node"), "to")
    known = nodes.select("node", "n").join(nearest, "node", "left").join(labels, "node", "left")
    return known.select("node", "n", F.coalesce("to.b", "node").alias("region"), F.coalesce("to.d", F.lit(0.0)).alias("d"), F.coalesce("label", "node").alias("label"))


def shared_keys(nodes: DataFrame) -> DataFrame:
    """node, key: first shingles that several sets have."""
    exploded = nodes.select(F.explode("keys").alias("key"))
    shared = stored(exploded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"), "shared")
    bits = nodes.sparkSession.sparkContext.broadcast(bitmap(shared, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
            may = in_bitmap(bits.value, flat.view(np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[may])), pa.array(flat[may])], names=["node", "key"])

    rows = nodes.select("node", "keys").mapInArrow(run, "node long, key long")
    return stored(rows.join(shared, "key"), "shared_rows")


def pair_counts(rows: pa.Table) -> pa.Table:
    """p, q, shared, low, high: pairs of regions that meet under some key of these rows and may be linked, with
    the number of keys; `low` is the least sum of their sizes, `high` the greatest size."""
    order = np.argsort(rows["key"].to_numpy(), kind="stable")
    key, region, low, high, label, cap, own, i, j = (rows[c].to_numpy()[order] for c in ("key", "region", "low", "high", "label", "cap", "own", "i", "j"))
    names, at = np.unique(region, return_inverse=True)
    least, most = np.full(len(names), 2**62), np.zeros(len(names), np.int64)
    np.minimum.at(least, at, low)
    np.maximum.at(most, at, high)
    cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])).tolist() + [len(key)]
    held: list[np.ndarray] = []
    codes, many, size = np.empty(0, np.int64), np.empty(0, np.int64), 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        found, back = np.unique(np.concatenate([codes, *held]), return_inverse=True)
        return found, np.bincount(back, np.concatenate([many, np.ones(size, np.int64)]), len(found)).astype(np.int64)

    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        for x in range(a, b - 1):
            y = slice(x + 1, b)
            may = (label[y] != label[x]) & (PART * high[y] >= LEAST * low[x]) & (PART * high[x] >= LEAST * low[y])
            may &= (LEAST * (low[y] + low[x]) <= (PART + LEAST) * np.minimum(cap[y], cap[x])) & ((i[y] == j[y]) | (own[y] != own[x]))
            met = at[y][may]
            if len(met):
                held.append(np.minimum(met, at[x]) * len(names) + np.maximum(met, at[x]))
                size += len(met)
        if size > HELD:
            codes, many = added()
            held, size = [], 0
    codes, many = added()
    p, q = codes // max(len(names), 1), codes % max(len(names), 1)
    return pa.table([names[p], names[q], many, least[p] + least[q], np.maximum(most[p], most[q])], names=["p", "q", "shared", "low", "high"])


def open_pairs(keyed: DataFrame, place: DataFrame) -> DataFrame:
    """p < q: regions of different groups whose members share a first shingle and may be linked.

    `shared` counts the first shingles that the two regions share. Two linked sets have all their
    shared shingles among the first ones of both or behind the end of the shorter ones, which bounds
    from below how many must be among the first. No set can share more than `cap`: all but those of its first
    shingles that no other set has. Pairs are counted in tasks that hold many shingles each; a shingle
    of very many regions is dealt over several tasks in blocks.
    """
    known = place.join(keyed.groupBy("node").agg(F.count(F.lit(1)).alias("few")), "node")
    known = known.withColumn("cap", F.col("few") + F.ceil(LEAST * F.col("n") / PART) - 1)
    rows = keyed.join(known, "node").groupBy("key", "region").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("label").alias("label"), F.max("cap").alias("cap")
    )
    rows = stored(rows, "key_regions")
    several = rows.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("size")).where("x < y")
    rows = stored(rows.join(several.select("key", F.ceil(F.col("size") / MET).alias("blocks")), "key"), "open_keys")
    parts = max(1, rows.count() // ROWS)
    rows = rows.withColumns({"own": F.pmod(F.xxhash64("region"), F.col("blocks")), "part": F.pmod(F.xxhash64("key", F.lit(3)), F.lit(parts))})
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("blocks", "other")
    counts = rows.groupBy("part", "i", "j").applyInArrow(pair_counts, "p long, q long, shared long, low long, high long")
    pairs = counts.groupBy("p", "q").agg(F.sum("shared").alias("shared"), F.min("low").alias("low"), F.max("high").alias("high"))
    # intersection >= LEAST / (PART + LEAST) * (n + m), of which at most LEAST / PART * the larger lie behind.
    may = LEAST * F.col("low") - F.col("shared") * (PART + LEAST) <= F.floor(LEAST * F.col("high") / PART) * (PART + LEAST)
    return stored(pairs.where(may).select("p", "q"), "region_pairs")


def grouped(pairs: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    """The pairs whose two nodes are in different groups."""
    for c in columns:
        known = labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
        pairs = pairs.join(known, c, "left").withColumn(f"{c}_label", F.coalesce(f"{c}_label", c))
    return pairs.where(F.col(f"{columns[0]}_label") != F.col(f"{columns[1]}_label")).drop(*[f"{c}_label" for c in columns])


def compare_members(rows: pa.Table) -> pa.Table:
    """For each b (of another region) the members of region p that may be linked with it, from their distances
    to their pivots, the distance `d` of the pivots and the number of first shingles that they share; those
    that share most come first."""
    mine = rows["mine"].to_numpy()
    node, n, own, label, d = (rows[c].to_numpy() for c in ("node", "n", "own", "label", "d"))
    lists = rows["keys"].combine_chunks()
    flat, at = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
    left, right = np.flatnonzero(mine), np.flatnonzero(~mine)
    held = np.concatenate([np.empty(0, np.uint64), *[flat[at[i] : at[i + 1]] for i in left]])
    owner = np.repeat(np.arange(len(left)), at[left + 1] - at[left])
    order = np.argsort(held, kind="stable")
    held, owner = held[order], owner[order]
    found: dict[str, list] = {"p": [], "b": [], "others": []}
    for k in right:
        keys = np.sort(flat[at[k] : at[k + 1]])
        low, high = np.searchsorted(held, keys, "left"), np.searchsorted(held, keys, "right")
        met = np.concatenate([np.empty(0, np.int64), *[owner[x:y] for x, y in zip(low, high, strict=True) if y > x]])
        shared = np.bincount(met, minlength=len(left))
        most = np.maximum(n[left], n[k])
        may = (shared > 0) & (label[left] != label[k]) & (own[left] + own[k] + RADIUS + _EPS >= d[k])
        may &= (PART + LEAST) * (shared + LEAST * most // PART) >= LEAST * (n[left] + n[k])
        if may.any():
            best = np.flatnonzero(may)
            best = best[np.lexsort((node[left[best]], -shared[best]))]
            for name, value in (("p", rows["p"][0].as_py()), ("b", int(node[k])), ("others", node[left[best]])):
                found[name].append(value)
    return pa.table(found, schema=pa.schema({"p": pa.int64(), "b": pa.int64(), "others": pa.list_(pa.int64())}))


def member_pairs(apart: DataFrame, place: DataFrame, nodes: DataFrame) -> DataFrame:
    """p, b, others: members of regions that stay open, not in one group and maybe linked; `apart`: p, q, d.
    Lists have at most the members of a block.

    The members are dealt to tasks in blocks of about SIDE, those of one region against those of all
    regions that it is open to.
    """
    among = apart.select("p").unionAll(apart.select("q")).distinct().withColumnRenamed("p", "region")
    members = stored(place.join(among, "region").join(nodes.select("node", "keys"), "node").select("region", "node", "n", F.col("d").alias("own"), "label", "keys"), "open_members")
    sizes = stored(members.groupBy("region").agg(F.count(F.lit(1)).alias("size")), "open_sizes")
    both = apart.join(sizes.toDF("p", "size_p"), "p").join(sizes.toDF("q", "size_q"), "q")
    swap = F.col("size_q") > F.col("size_p")
    turned = both.select(F.when(swap, F.col("q")).otherwise(F.col("p")).alias("p"), F.when(swap, F.col("p")).otherwise(F.col("q")).alias("region"), "d")
    guests = stored(turned.join(members, "region").select("p", "d", "node", "n", "own", "label", "keys"), "guests")
    blocks = guests.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / SIDE).alias("theirs")).join(sizes.toDF("p", "size"), "p")
    blocks = stored(blocks.select("p", "theirs", F.ceil(F.col("size") / SIDE).alias("ours")), "open_blocks")
    deal = lambda own, other: (F.pmod(F.xxhash64("node"), F.col(own)), F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
    columns = ["p", "i", "j", "mine", "node", "n", "own", "label", "d", "keys"]
    i, j = deal("ours", "theirs")
    left = members.withColumnRenamed("region", "p").join(blocks, "p").withColumns({"i": i, "mine": F.lit(True), "d": F.lit(0.0)}).withColumn("j", j)
    i, j = deal("theirs", "ours")
    right = guests.join(blocks, "p").withColumns({"j": i, "mine": F.lit(False)}).withColumn("i", j)
    dealt = left.select(*columns).unionByName(right.select(*columns))
    return stored(dealt.groupBy("p", "i", "j").applyInArrow(compare_members, "p long, b long, others array<long>"), "member_pairs")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Texts are lower-cased (A-Z) and split at ASCII white space; the set holds the distinct 5-word
    shingles, or the whole sequence of fewer words. Two documents are linked when 100 * intersection >=
    80 * union; component_id is the smallest doc_id of a document's connected group. Null and empty
    texts have an empty set and are linked with nothing: their component is their own id. A row without
    an id links as any other, but never gives its group a name (a group without any id has null). Rows
    that share an id are rows of their own. An empty table gives an empty result; other columns are
    ignored. Shingles are compared by 64-bit hashes, sets by 128 bits.
    """
    rough = docs.agg(F.sum(F.length(text_of(text))).alias("n")).first()["n"] or 0
    common = bitmap(common_shingles(docs, text, rough // 6), "shingle")
    rows = stored(parsed(docs, doc_id, text, common), "sets")
    unique = rows.where("n > 0").groupBy("a", "b").agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.min("t").alias("t"), F.min("rare").alias("rare"), F.first("mins").alias("mins"), F.first("keys").alias("keys")
    )
    nodes = stored(unique.withColumn("node", F.monotonically_increasing_id()), "nodes")

    def fetch(pairs: DataFrame) -> DataFrame:
        """Texts of all nodes of the pairs."""
        ids = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
        return texts_of(docs, text, nodes.select("node", "a", "b", "t").join(ids, "node", "left_semi"))

    pairs = stored(near_pivots(nodes), "pivot_pairs")
    near = stored(measured(pairs, fetch(pairs)), "near_pivots")
    links = stored(near.where("linked").select("a", "b"), "links")
    labels = components(links)
    place = stored(regions(nodes, near, labels), "regions")
    keyed = shared_keys(nodes)
    between = open_pairs(keyed, place).select(F.col("p").alias("a"), F.col("q").alias("b"))
    between = stored(measured(between, fetch(between)), "pivot_distances")
    links = stored(links.unionByName(between.where("linked").select("a", "b")), "links")
    radius = stored(place.groupBy("region").agg(F.max("d").alias("r")).where("r > 0"), "radii")
    side = lambda c: radius.select(F.col("region").alias(c), F.col("r").alias(f"r_{c}"))
    apart = between.where("NOT linked").select(F.col("a").alias("p"), F.col("b").alias("q"), "d").join(side("p"), "p", "left").join(side("q"), "q", "left")
    apart = apart.select("p", "q", "d", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("r_p", "r_q")])
    apart = stored(apart.where(F.col("d") <= RADIUS + F.col("r_p") + F.col("r_q") + _EPS), "open_regions")
    labels = components(links)
    apart = stored(grouped(apart, labels, "p", "q"), "open_regions")
    if not apart.isEmpty():
        place = place.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        left = member_pairs(apart, place, nodes)
        inside = place.join(left.select(F.col("p").alias("region")).distinct(), "region", "left_semi").select(F.col("node").alias("a"))
        texts = fetch(inside.withColumn("b", F.col("a")).unionByName(left.select(F.col("b").alias("a"), "b")))
        done, step = 0, FIRST
        while not left.isEmpty():
            pairs = left.select(F.explode(F.slice("others", done + 1, step)).alias("a"), "b").distinct()
            more = stored(measured(stored(pairs, "member_step"), texts).where("linked").select("a", "b"), "more_links")
            done, step = done + step, 4 * step
            left = left.where(F.size("others") > done)
            if not more.isEmpty():
                links = stored(links.unionByName(more), "links")
                labels = components(links)
                left = grouped(left, labels, "p", "b")
            left = stored(left, "left_members")
    known = nodes.select("a", "b", "node", "doc_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = stored(known, "labelled")
    names = known.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    known = stored(known.join(names, "label").select("a", "b", "component_id"), "components")
    full = rows.where("n > 0").select("doc_id", F.col("n").alias("n_shingles"), "a", "b").join(known, ["a", "b"]).drop("a", "b")
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(none)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
