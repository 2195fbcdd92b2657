"""Phrase collocations by Rabin-Karp fingerprints.

Texts are split into pieces and words; prefix polynomials over word hashes (sums of value * base**place,
modulo 2**64) give the fingerprint of every run of words by one difference and one product, whatever
its length. Tasks add up equal fingerprints; the shuffle carries fingerprints, counts and a pointer
to one occurrence, never phrases. A second, independent fingerprint keeps phrases apart whose first ones
collide; the phrases are then read from the texts that the pointers name and must give both
fingerprints again. Only frequent phrases are ever turned into text.

A run of words can only be frequent if all its parts are. Words are counted first, then pairs of frequent
words, triples of frequent pairs, then all that these leave. What is frequent goes to the tasks as
bitmaps of fixed size: what passes one by chance is counted and found rare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.llm import runs
from riskloom.llm.common import stored, table, text_of
from riskloom.llm.jaccard_join import bitmap, in_bitmap
from riskloom.llm.words import mixed

LONGEST, OFTEN, TOP = 5, 100, 2000
#: Runs of up to so many words are counted before longer ones.
COUNTED = 3
#: Bytes of text that a task looks at at once, bytes of entries that it holds, words that make one range.
BYTES, HELD, RANGE = 1 << 22, 1 << 25, 1 << 21
_STOPS = b".,;:!?" + bytes(range(0x0A, 0x0E))
_WORD, _PIECE = runs.without(b" \t" + _STOPS), runs.without(_STOPS)
_BASES = [int(x) | 1 for x in np.random.default_rng(61).integers(2**60, 2**63, 2)]
_SALT = np.random.default_rng(62).integers(1, 2**63, 3, dtype=np.uint64) | np.uint64(1)
#: Fingerprints have these bits; tests take few of them, so that they collide.
MASK = 2**64 - 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Polynomial:
    """Sums of value * base**place up to each word, and the inverse powers that move a run to place 0."""

    def __init__(self, value: np.ndarray, base: int):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * powers(base, len(value)))])
        self.back = powers(pow(base, -1, 2**64), len(value))

    def prints(self, lang: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of the runs of `size` words that begin at the places `start`; `lang`: a number of their language."""
        run = (self.sums[start + size] - self.sums[start]) * self.back[start]
        return mixed(mixed(run * _SALT[0] + lang * _SALT[1]) + np.full(1, size, np.uint64) * _SALT[2])


class Words:
    """Words of a batch of texts: their hashes, places and pieces."""

    def __init__(self, texts: pa.Array, lang: np.ndarray):
        self.raw, offsets = runs.lowered(texts)
        self.start, self.end = runs.bounds(self.raw, offsets, _WORD)
        self.value = runs.hashes(self.raw, self.start, self.end)
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.lang = lang[self.doc]
        self.begin = offsets
        stops = np.zeros(len(self.raw) + 1, np.int32)
        np.cumsum(~_PIECE[self.raw], dtype=np.int32, out=stops[1:])
        self.piece = stops[self.start] + self.doc
        self.polynomials: dict[int, Polynomial] = {}

    def runs(self, size: int) -> np.ndarray:
        """Places of all runs of `size` words inside pieces."""
        last = len(self.piece) - size + 1
        return np.flatnonzero(self.piece[: max(last, 0)] == self.piece[size - 1 :]) if last > 0 else np.empty(0, np.int64)

    def prints(self, start: np.ndarray, size: int, which: int = 0) -> np.ndarray:
        if which not in self.polynomials:
            self.polynomials[which] = Polynomial(self.value, _BASES[which])
        found = self.polynomials[which].prints(self.lang[start], start, size)
        return found if which else found & np.uint64(MASK)


def prepared(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, its number, the text's hash, text."""
    name = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    return docs.select(name.alias("lang"), F.xxhash64(name).alias("number"), F.xxhash64(text_of(text)).alias("t"), text_of(text).alias("text"))


def languages(rows: DataFrame) -> DataFrame:
    """lang, number, total (words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs.parts(batches, 3, BYTES):
            w = Words(batch.column(3), batch.column(1).to_numpy().view(np.uint64))
            _, first, many = np.unique(w.lang, return_index=True, return_counts=True)
            own = pa.array(w.doc[first])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(many)], names=["lang", "number", "n"])

    return rows.mapInArrow(run, "lang string, number long, n long").groupBy("lang", "number").agg(F.sum("n").alias("total"))


#: What tasks add up: a count by fingerprint, and the same with the second fingerprint and one occurrence.
COUNT = np.dtype([("print", "<u8"), ("n", "<i8")])
POINTED = np.dtype([("print", "<u8"), ("check", "<u8"), ("n", "<i8"), ("number", "<i8"), ("size", "<i8"), ("t", "<i8"), ("start", "<i8"), ("length", "<i8")])


def combined(entries: np.ndarray) -> np.ndarray:
    """One entry for each fingerprint (or two), the counts added; the pointer is picked by a hash, so that
    the pointers of many phrases don't all name the same text."""
    if not len(entries):
        return entries
    if "check" in entries.dtype.names:
        order = np.lexsort((mixed(entries["t"].view(np.uint64) ^ entries["print"]), entries["check"], entries["print"]))
        entries = entries[order]
        new = (entries["print"][1:] != entries["print"][:-1]) | (entries["check"][1:] != entries["check"][:-1])
    else:
        entries = entries[np.argsort(entries["print"], kind="stable")]
        new = entries["print"][1:] != entries["print"][:-1]
    first = np.flatnonzero(np.append(True, new))
    out = entries[first]
    out["n"] = np.add.reduceat(entries["n"], first)
    return out


def often(rows: DataFrame, power: int, kind: np.dtype, found) -> DataFrame:
    """Entries of `kind` with OFTEN occurrences. `found(words, batch)` gives the fingerprints' entries of a batch.

    A task adds up its entries and sends them packed, by ranges of fingerprints; there are 2**power
    ranges, in number as the words, so that each is of bounded size.
    """
    top = np.uint64(64 - power)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [np.empty(0, kind)], 0

        def packed() -> pa.RecordBatch:
            whole = combined(np.concatenate(held))
            cut = np.append(np.searchsorted(whole["print"], np.arange(1 << power, dtype=np.uint64) << top), len(whole)) if power else np.array([0, len(whole)])
            own = [k for k in range(1 << power) if cut[k + 1] > cut[k]]
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([whole[cut[k] : cut[k + 1]].tobytes() for k in own], pa.binary())], names=["part", "entries"])

        for batch in runs.parts(batches, 3, BYTES):
            w = Words(batch.column(3), batch.column(1).to_numpy().view(np.uint64))
            held.append(combined(found(w, batch)))
            size += held[-1].nbytes
            if size > HELD:
                yield packed()
                held, size = [np.empty(0, kind)], 0
        if size:
            yield packed()

    names = list(kind.names)

    def summed(table: pa.Table) -> pa.Table:
        whole = combined(np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table["entries"]]))
        whole = whole[whole["n"] >= OFTEN]
        return pa.table([np.ascontiguousarray(whole[c]).view(np.int64) for c in names], names=names)

    sent = rows.mapInArrow(run, "part long, entries binary")
    return stored(sent.groupBy("part").applyInArrow(summed, ", ".join(f"{c} long" for c in names)), "frequent")


def pointed(w: Words, batch: pa.RecordBatch, start: np.ndarray, size: int) -> np.ndarray:
    out = np.empty(len(start), POINTED)
    doc = w.doc[start]
    out["print"], out["check"], out["n"], out["size"] = w.prints(start, size), w.prints(start, size, 1), 1, size
    out["number"], out["t"] = batch.column(1).to_numpy()[doc], batch.column(2).to_numpy()[doc]
    out["start"], out["length"] = w.start[start] - w.begin[doc], w.end[start + size - 1] - w.start[start]
    return combined(out)


def counted(prints: np.ndarray) -> np.ndarray:
    found, many = np.unique(prints, return_counts=True)
    out = np.empty(len(found), COUNT)
    out["print"], out["n"] = found, many
    return out


def frequent_runs(rows: DataFrame, words_in_all: int) -> DataFrame:
    """Entries (POINTED) of all runs of one to LONGEST words with OFTEN occurrences.

    Level by level: words, pairs of frequent words, triples of frequent pairs, and at last everything whose
    triples (or pairs, or words) are frequent, with pointers.
    """
    spark = rows.sparkSession
    power = max(0, (words_in_all // RANGE).bit_length())
    levels: list = []

    def starts(w: Words, size: int) -> np.ndarray:
        """Places of the runs whose own longest counted parts are frequent."""
        start = w.runs(size)
        for k, bits in enumerate(levels, 1):
            if k > size:
                break
            good = np.zeros(len(w.value) + LONGEST, bool)
            place = w.runs(k)
            good[place[in_bitmap(bits.value, w.prints(place, k))]] = True
            for j in range(size - k + 1):
                start = start[good[start + j]]
        return start

    for size in range(1, COUNTED + 1):
        one = often(rows, power, COUNT, lambda w, _, size=size: counted(w.prints(starts(w, size), size)))
        levels.append(spark.sparkContext.broadcast(bitmap(one, "print")))
    return often(rows, power, POINTED, lambda w, batch: np.concatenate([pointed(w, batch, starts(w, size), size) for size in range(1, LONGEST + 1)]))


def read_phrases(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """lang, size, print, check, a, words: the frequent runs of two and more words with their words, read from
    the texts of their pointers; what doesn't give both fingerprints again is left out."""
    wanted = stored(frequent.where("size > 1").select("lang", "size", "print", "check", "a", "number", "t", "start", "length"), "pointers")
    bits = rows.sparkSession.sparkContext.broadcast(bitmap(wanted, "t"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            may = batch.filter(pa.array(in_bitmap(bits.value, batch.column(0).to_numpy().view(np.uint64)), pa.bool_()))
            if len(may):
                yield may

    texts = rows.select("t", "text").mapInArrow(near, "t long, text string")
    texts = texts.withColumn("rank", F.row_number().over(Window.partitionBy("t").orderBy("t"))).where("rank = 1").select("t", "text")
    lists = wanted.groupBy("t").agg(F.collect_list(F.struct("number", "lang", "size", "print", "check", "a", "start", "length")).alias("found"))
    schema = "lang string, size long, print long, check long, a long, words array<string>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = text.as_py().encode()
                for f in found:
                    piece = runs.LOWER[np.frombuffer(raw[f["start"] : f["start"] + f["length"]], np.uint8)].tobytes().decode("utf-8", "replace")
                    w = Words(pa.array([piece]), np.array([f["number"]], np.int64).view(np.uint64))
                    start = w.runs(f["size"])
                    own = [int(w.prints(start, f["size"], k).view(np.int64)[0]) for k in (0, 1)] if len(start) == len(w.value) - f["size"] + 1 == 1 else []
                    if own == [f["print"], f["check"]]:
                        out.append({k: f[k] for k in ("lang", "size", "print", "check", "a")} | {"words": piece.replace("\t", " ").split(" ")})
            for x in out:
                x["words"] = [v for v in x["words"] if v]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema({"lang": pa.string(), **{k: pa.int64() for k in ("size", "print", "check", "a")}, "words": pa.list_(pa.string())})
    return stored(texts.join(lists, "t").select("text", "found").mapInArrow(cut, schema), "phrases")


def parts_of(phrases: DataFrame) -> DataFrame:
    """For each phrase and each of its parts (runs of its words): lang, print, check of the phrase, a, first and
    last place, part_size, part_print, part_check."""
    rows = phrases.select("lang", F.xxhash64("lang").alias("number"), "size", "print", "check", "a", F.array_join("words", " ").alias("phrase"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Words(batch.column(6), batch.column(1).to_numpy().view(np.uint64))
            size = batch.column(2).to_numpy()
            first = np.concatenate([[0], np.cumsum(size)])[:-1]
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for length in range(1, LONGEST):
                start = w.runs(length)
                own = w.doc[start]
                keep = size[own] > length
                start, own = start[keep], own[keep]
                for k, v in enumerate((own, start - first[own], np.full(len(own), length), w.prints(start, length).view(np.int64), w.prints(start, length, 1).view(np.int64), size[own])):
                    out[k].append(v)
            own, place, length, prints, check, whole = (np.concatenate(v) for v in out)
            picked = batch.take(pa.array(own))
            yield pa.RecordBatch.from_arrays(
                [picked.column(0), picked.column(3), picked.column(4), picked.column(5), pa.array(place), pa.array(whole), pa.array(length), pa.array(prints), pa.array(check)],
                names=["lang", "print", "check", "a", "place", "size", "part_size", "part_print", "part_check"],
            )

    return rows.mapInArrow(run, "lang string, print long, check long, a long, place long, size long, part_size long, part_print long, part_check long")


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exactly."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    return F.call_function("div", wide(F.lit(1000), 4) * wide(a, 16) * wide(n, 16), wide(left, 18) * wide(right, 18))


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's TOP phrases of two to LONGEST words.

    A language is `und` where it is null; null texts count as empty. Repeated rows count as often as they occur.
    An empty table, or one without a phrase of OFTEN occurrences, gives an empty result; other columns are
    ignored. Counts are exact as far as two 64-bit fingerprints tell phrases apart.
    """
    rows = prepared(docs, text, lang)
    totals = stored(languages(rows), "languages")
    whole = totals.agg(F.sum("total")).first()[0] or 0
    named = frequent_runs(rows, whole).withColumnRenamed("n", "a").join(totals.select("lang", "number"), "number")
    frequent = stored(named, "frequent_runs")
    found = read_phrases(rows, frequent)
    parts = stored(parts_of(found), "parts")
    counts = frequent.select("lang", F.col("size").alias("part_size"), F.col("print").alias("part_print"), F.col("check").alias("part_check"), F.col("a").alias("part_a"))
    ends = parts.where("place = 0 OR place + part_size = size").join(counts, ["lang", "part_size", "part_print", "part_check"])
    key = ["lang", "print", "check"]
    left = ends.where("place = 0").select(*key, "a", F.col("part_size").alias("cut"), F.col("part_a").alias("l"))
    right = ends.where("place > 0").select(*key, F.col("place").alias("cut"), F.col("part_a").alias("r"))
    cuts = left.join(right, [*key, "cut"]).join(totals.drop("number"), "lang")
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("total"), F.col("l"), F.col("r")))
    best = cuts.groupBy(*key).agg(F.min(F.struct("score", "cut", "l", "r", F.col("total").alias("n"))).alias("best"))
    covered = parts.where("part_size > 1").groupBy("lang", F.col("part_print").alias("print"), F.col("part_check").alias("check")).agg(F.max("a").alias("longer"))
    kept = found.join(best, key).join(covered, key, "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    kept = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", "best.l", "best.r", "best.n", "best.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = kept.withColumn("rank", rank).where(F.col("rank") <= TOP)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"))


CHECK = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed),
totals AS (SELECT lang, count(*)::HUGEINT AS n FROM places GROUP BY ALL),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
scored AS (SELECT x.lang, x.phrase, x.a, l.a AS l, r.a AS r, n.n, 1000 * x.a * n.n // (l.a * r.a) AS score, cut
           FROM cuts x JOIN totals n USING (lang) JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(w[1:cut], ' ')
           JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_sizes AS (SELECT *, unnest(range(2, k)) AS size FROM c WHERE k > 2),
inner_parts AS (SELECT *, unnest(range(1, k - size + 2)) AS i FROM inner_sizes),
covered AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer FROM inner_parts GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN covered v USING (lang, phrase) WHERE v.longer IS NULL OR 100 * v.longer < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
