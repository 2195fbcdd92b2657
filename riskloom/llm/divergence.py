"""Divergence of sources: term shares of all pairs of a language's sources.

Terms are counted per (language, source) and document over whole texts. A language keeps the terms of
at least DOCUMENTS of its documents; a group's share of a term is smoothed and kept as an integer,
1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)). The divergence of two groups is the sum of the
absolute differences of their shares over all kept terms.

Pairs are priced by sparse merges. A group's counts are sorted arrays of (term id, count), cut into
buckets of terms of bounded size. For each bucket and each unordered pair of blocks of groups a
task co-groups the arrays of both blocks; a galloping intersection (the shorter array is searched for in
the longer one) prices common terms, the remaining ones are priced against the other group's share
of an absent term. Terms absent from both need no array: their number follows from V.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.llm import runs
from riskloom.llm.common import stored, table, text_of

DOCUMENTS, SCALE, SMOOTH, TOP = 30, 10**9, 5, 50
#: Kept terms in a bucket, about, and groups in a block of pairs.
BUCKET, BLOCK = 1 << 15, 16
#: Bytes of terms are letters and all bytes of non-ASCII characters.
_TERM = runs.without(bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it), summed within tasks; and for each
    language and source that occurs a row without a term, so that groups without terms are known."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(name(lang).alias("lang"), name(source).alias("source"), text_of(text).alias("text"))

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        groups = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"])
        seen: dict[tuple, int] = {}
        group = np.array([seen.setdefault((g["lang"], g["source"]), len(seen)) for g in groups.to_pylist()], np.int64)
        raw, offsets = runs.lowered(batch.column(2))
        starts, ends = runs.bounds(raw, offsets, _TERM)
        value = runs.hashes(raw, starts, ends)
        doc = np.searchsorted(offsets, starts, "right") - 1
        order = np.lexsort((doc, value))
        value, doc = value[order], doc[order]
        first = np.append(True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])) if len(value) else np.empty(0, bool)
        at = np.flatnonzero(first)
        many = np.diff(np.append(at, len(value)))
        value, owner, place = value[at], group[doc[at]] if len(at) else np.empty(0, np.int64), order[at]
        order = np.lexsort((owner, value))
        value, owner, place, many = value[order], owner[order], place[order], many[order]
        at = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))) if len(value) else np.empty(0, np.int64)
        n = np.add.reduceat(many, at) if len(at) else at
        held = np.diff(np.append(at, len(value)))
        data = raw.tobytes()
        terms = [data[a:b].decode("utf-8") for a, b in zip(starts[place[at]].tolist(), ends[place[at]].tolist(), strict=True)]
        names = list(seen)
        owner = owner[at].tolist() + list(range(len(names)))
        empty = len(names)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[k][0] for k in owner], pa.string()), pa.array([names[k][1] for k in owner], pa.string()), pa.array(terms + [None] * empty, pa.string()),
                pa.array(np.append(n, np.zeros(empty, np.int64)).astype(np.int64)), pa.array(np.append(held, np.zeros(empty, np.int64)).astype(np.int64)),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs.parts(batches, 2, 1 << 22):
            yield counted(batch)

    found = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTH) / total), exactly: by long division, three digits at a time."""
    total = np.asarray(total, np.int64)
    rest = np.asarray(count, np.int64) + SMOOTH
    out = rest // total
    rest = rest % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def _share(count: Column, total: Column) -> Column:
    """The same as a column (long)."""
    total = F.greatest(total, F.lit(1).cast("long"))
    rest = count + SMOOTH
    out = F.call_function("div", rest, total)
    for _ in range(3):
        rest = rest % total * 1000
        out = out * 1000 + F.call_function("div", rest, total)
    return out + 1


def priced(left: list[tuple[np.ndarray, np.ndarray, int]], right: list[tuple[np.ndarray, np.ndarray, int]], same: bool) -> list[tuple[int, int, int, int]]:
    """For each pair (position left, right): the sum over terms of either, and how many those are.

    A group is its sorted term ids, their counts and its total N + SMOOTH * V.
    """
    out = []
    shares = [[share(count, total) for _, count, total in side] for side in (left, right)]
    absent = [[int(share(np.int64(0), total)) for _, _, total in side] for side in (left, right)]
    for x, (ids_x, _, _) in enumerate(left):
        for y, (ids_y, _, _) in enumerate(right):
            if same and y <= x:
                continue
            p, q, p0, q0 = shares[0][x], shares[1][y], absent[0][x], absent[1][y]
            flip = len(ids_x) > len(ids_y)
            few, many = (ids_y, ids_x) if flip else (ids_x, ids_y)
            at = np.searchsorted(many, few)
            met = at < len(many)
            met[met] = many[at[met]] == few[met]
            at = at[met]
            in_x, in_y = (at, np.flatnonzero(met)) if flip else (np.flatnonzero(met), at)
            only_x, only_y = np.abs(p - q0), np.abs(q - p0)
            value = only_x.sum() - only_x[in_x].sum() + only_y.sum() - only_y[in_y].sum() + np.abs(p[in_x] - q[in_y]).sum()
            out.append((x, y, int(value), len(ids_x) + len(ids_y) - len(at)))
    return out


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (sources, a before b), value and terms (held by either) of all pairs with terms; summed over buckets.

    `counts`: lang, source, term, n of kept terms; `groups`: lang, source, number, blocks, buckets, total.
    """
    known = groups.select("lang", "source", "number", "blocks", "buckets", "total")
    cells = counts.join(known, ["lang", "source"]).withColumn("bucket", F.pmod(F.xxhash64("term", F.lit(7)), F.col("buckets")))
    ids = cells.select("lang", "bucket", "term").distinct()
    ids = ids.withColumn("id", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("term")))
    cells = cells.join(ids, ["lang", "bucket", "term"])
    packed = cells.groupBy("lang", "bucket", "source").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("cells"))
    whole = known.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)))  # groups without terms there, too
    packed = whole.join(packed, ["lang", "bucket", "source"], "left").withColumn("cells", F.coalesce("cells", F.array().cast("array<struct<id:int,n:bigint>>")))
    packed = stored(packed.select("lang", "bucket", "source", "blocks", "total", F.floor(F.col("number") / BLOCK).alias("block"), F.col("cells.id").alias("ids"), F.col("cells.n").alias("counts")), "packed_counts")
    left = packed.withColumnRenamed("block", "i").withColumn("j", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)))
    right = packed.withColumnRenamed("block", "j").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("j"))))

    def arrays(rows: pa.Table) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray, int]]]:
        names = rows["source"].to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        ids, counts, total = (rows[c] for c in ("ids", "counts", "total"))
        return [names[k] for k in order], [(ids[k].values.to_numpy(), counts[k].values.to_numpy(), total[k].as_py()) for k in order]

    def merge(a: pa.Table, b: pa.Table) -> pa.Table:
        schema = pa.schema({"lang": pa.string(), "a": pa.string(), "b": pa.string(), "value": pa.int64(), "terms": pa.int64()})
        if not len(a) or not len(b):
            return schema.empty_table()
        (names, left), (others, right) = arrays(a), arrays(b)
        found = priced(left, right, a["i"][0].as_py() == a["j"][0].as_py())
        turn = lambda x, y: (names[x], others[y])
        pairs = [turn(x, y) for x, y, _, _ in found]
        return pa.table([[a["lang"][0].as_py()] * len(found), [p[0] for p in pairs], [p[1] for p in pairs], [f[2] for f in found], [f[3] for f in found]], schema=schema)

    columns = ["lang", "bucket", "i", "j", "source", "total", "ids", "counts"]
    key = ["lang", "bucket", "i", "j"]
    tasks = left.select(*columns).groupBy(*key).cogroup(right.select(*columns).groupBy(*key))
    found = tasks.applyInArrow(merge, "lang string, a string, b string, value long, terms long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank.

    Part `pair`: each other source of the language with the sum of absolute differences of shares over all
    kept terms; part `term`: the TOP terms of a group whose share exceeds that of its language most. Null
    texts, languages and sources count as ''. Groups without terms have pairs like all others; a
    language without kept terms has pairs of value 0. Repeated rows count as often as they occur. An
    empty table gives an empty result; other columns are ignored.
    """
    every = stored(term_counts(docs, text, lang, source), "term_counts")
    kept = every.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"))
    kept = stored(kept.where(F.col("docs") >= DOCUMENTS).select("lang", "term", "n_lang"), "kept_terms")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("total_lang"))
    counts = stored(every.where("term IS NOT NULL").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "kept_counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    groups = every.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    groups = groups.select("lang", "source", number.cast("long").alias("number"), zero("v").alias("v"), (zero("n_all") + SMOOTH * zero("v")).alias("total"), (zero("total_lang") + SMOOTH * zero("v")).alias("total_lang"))
    groups = groups.withColumns({"blocks": F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / BLOCK), "buckets": F.ceil((F.col("v") + 1) / BUCKET)})
    groups = stored(groups, "groups")
    merged = stored(pair_values(counts.select("lang", "source", "term", "n"), groups), "pair_values")
    side = lambda c: groups.select("lang", F.col("source").alias(c), F.col("v").alias(f"v_{c}"), F.col("total").alias(f"total_{c}"))
    pairs = side("a").join(side("b"), "lang").where("a < b").join(merged, ["lang", "a", "b"], "left")
    nothing = F.lit(0).cast("long")
    gap = F.abs(_share(nothing, F.col("total_a")) - _share(nothing, F.col("total_b")))
    one_sided = F.coalesce("value", nothing) + (F.col("v_a") - F.coalesce("terms", nothing)) * gap
    pairs = stored(pairs.select("lang", "a", "b", F.when(F.col("v_a") > 0, one_sided).otherwise(nothing).alias("value")), "pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    priced_terms = counts.join(groups.select("lang", "source", "total", "total_lang"), ["lang", "source"])
    over = _share(F.col("n"), F.col("total")) - _share(F.col("n_lang"), F.col("total_lang"))
    terms = priced_terms.select("lang", "source", F.col("term").alias("item"), over.alias("value")).where("value > 0")
    top = terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(order).alias("rank")).where(F.col("rank") <= TOP)
    return ranked.unionByName(top)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


CHECK = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
occurrences AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM occurrences GROUP BY ALL),
kept AS (SELECT lang, term FROM occurrences GROUP BY ALL HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
kept_counts AS (SELECT c.* FROM counts c JOIN kept USING (lang, term)),
totals AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n, coalesce(any_value(v.v), 0) AS v
           FROM groups g LEFT JOIN kept_counts c USING (lang, source) LEFT JOIN v ON v.lang = g.lang GROUP BY ALL),
shares AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS c, 1 + 1000000000 * (coalesce(c.n, 0) + 5) // (t.n + 5 * t.v) AS p
           FROM totals t JOIN kept k ON k.lang = t.lang LEFT JOIN kept_counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
lang_totals AS (SELECT lang, sum(n)::HUGEINT AS n, any_value(v) AS v FROM totals GROUP BY ALL),
lang_shares AS (SELECT k.lang, k.term, 1 + 1000000000 * (sum(k.n)::HUGEINT + 5) // (any_value(t.n) + 5 * any_value(t.v)) AS q
                FROM kept_counts k JOIN lang_totals t USING (lang) GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(any_value(s.f), 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source AS s1, y.source AS s2, sum(abs(x.p - y.p)) AS f
                     FROM shares x JOIN shares y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL) s
            ON s.lang = a.lang AND s.s1 = a.source AND s.s2 = b.source GROUP BY ALL),
terms AS (SELECT s.lang, s.source, 'term' AS part, s.term AS item, s.p - q.q AS value
          FROM shares s JOIN lang_shares q USING (lang, term) WHERE s.c > 0 AND s.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
