"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders, so a question keeps its template when its
parameters change. Runs of template words (windows) of documents are hash-joined with those of the
benchmark, and so are windows of the plain lower-cased words, which hold whatever the case (copies wholly
in capitals too), line breaks and number of placeholders. Windows that agree at one offset between document and item form an alignment; template windows count without those whose slots
don't map item values to document values one to one. A document is contaminated by an item if the windows
cover half of the item's windows, or of those with a template, or if RUN words in a row are the item's.

A bitmap of fixed size, set by the benchmark's windows, keeps most document windows from leaving
their task; it grows neither with the documents nor with the benchmark, and what passes it by chance
finds no partner in the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm import words
from riskloom.llm.common import stored, table, text_of

#: Words in a window, literal words that it needs of eight, words that an item needs.
WINDOW, LITERALS, LEAST = 8, 5, 5
#: Share of an item's windows that a document must hold.
COVERAGE = 0.5
#: Words in a row of an item that are enough by themselves.
RUN = 13
BITS = 26
#: Words that are a unit when a number stands before them.
UNITS = (
    "mm cm dm m km mi mile miles inch inches ft foot feet yd yard yards mg g kg t lb lbs oz pound pounds gram grams "
    "ton tons tonne tonnes ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour "
    "hours day days week weeks month months year years hz khz mhz ghz v kv w kw mw j kj cal kcal a ma pa bar c f k "
    "percent pct usd eur gbp dollar dollars cent cents euro euros kb mb gb tb bit bits byte bytes mph kmh degree degrees"
).split()
LITERAL, NUMBER, NAME, UNIT = range(4)
_CODES = np.random.default_rng(31).integers(1, 2**63, 4, dtype=np.uint64)
_PLAIN = np.random.default_rng(32).integers(1, 2**63, 1, dtype=np.uint64)
#: Bytes after which a capital letter says nothing.
_STOPS = np.isin(np.arange(256), np.frombuffer(b".!?:;\n\r\"'()[]|*#-", np.uint8))


def templates(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Value, kind and second kind of each word of all texts, and where each text's words begin.

    A word that begins with a digit is a number. A capitalised word (not one in capitals) inside a
    sentence is a name; one that opens a sentence, line, quote or bracket is literal in the first kind
    and a name in the second. A unit word is a unit after a number.
    """
    raw, offsets = words.buffer_of(texts)
    starts, ends = words.bounds(raw, offsets)
    value, at = words.lower_words(texts)
    kind = np.zeros(len(starts), np.uint8)
    if len(starts):
        if len(value) != len(starts):
            raise ValueError("lower-casing changed the number of words")
        first = raw[starts]
        second = np.where(ends - starts > 1, raw[np.minimum(starts + 1, len(raw) - 1)], 0)
        number = (first >= ord("0")) & (first <= ord("9"))
        wide = (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
        capital = (first >= ord("A")) & (first <= ord("Z")) & ((second >= ord("a")) & (second <= ord("z")) | (second >= 128)) | wide
        stops = np.concatenate([[0], np.cumsum(_STOPS[raw], dtype=np.int32)])
        opens = np.ones(len(starts), bool)
        opens[1:] = stops[starts[1:]] > stops[ends[:-1]]
        begins = at[:-1][np.diff(at) > 0]
        opens[begins] = True
        after_number = np.concatenate([[False], number[:-1]])
        after_number[begins] = False
        kind[capital & ~opens] = NAME
        unit = after_number & np.isin(value, unit_values())
        kind[unit] = UNIT
        kind[number] = NUMBER
        other = np.where(capital & opens & ~unit, np.uint8(NAME), kind)
        return value, kind, other, at
    return value, kind, kind, at


def unit_values() -> np.ndarray:
    return words.lower_words(pa.array([" ".join(UNITS)]))[0]


def plain_windows(value: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all windows of `size` lower-cased words that stay in one text."""
    found = words.windows(value, size)
    if not len(found):
        return np.empty(0, np.int64), found
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place = np.flatnonzero(text[: len(found)] == text[size - 1 :])
    return place, words.mixed(found[place] + np.uint64(size) + _PLAIN)


def template_windows(value: np.ndarray, kind: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows of `size` words that stay in one text and hold enough literal words, and
    their hashes."""
    found = words.windows(np.where(kind == LITERAL, value, _CODES[kind]), size)
    if not len(found):
        return np.empty(0, np.int64), found
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    literal = np.concatenate([[0], np.cumsum(kind == LITERAL)])
    good = (text[: len(found)] == text[size - 1 :]) & (8 * (literal[size:] - literal[:-size]) >= LITERALS * size)
    place = np.flatnonzero(good)
    return place, words.mixed(found[place] + np.uint64(size))


def all_windows(parsed: tuple, size: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Places and hashes of the windows of `size` words, with the kinds that tell their slots: by plain
    words (no slots), by the first kinds, and by the second ones where these differ."""
    value, kind, other, at = parsed
    second, found = template_windows(value, other, at, size)
    differ = np.concatenate([[0], np.cumsum(other != kind)])
    changed = differ[second + size] > differ[second]
    return [(*plain_windows(value, at, size), None), (*template_windows(value, kind, at, size), kind), (second[changed], found[changed], other)]


def _rows(ids: pa.Array, at: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray | None, int]], value: np.ndarray) -> pa.RecordBatch:
    """Windows as rows: id, position in the text, hash, slot values, whether it is one of plain words."""
    place = np.concatenate([p for p, _, _, _ in parts])
    plain = np.concatenate([np.full(len(p), kind is None) for p, _, kind, _ in parts])
    owner = np.searchsorted(at, place, "right") - 1
    none = np.empty(0, np.int64)
    slots = [none if kind is None else value[p : p + n][kind[p : p + n] != LITERAL].view(np.int64) for own, _, kind, n in parts for p in own.tolist()]
    ends = np.concatenate([[0], np.cumsum([len(s) for s in slots])]).astype(np.int32)
    flat = np.concatenate(slots) if slots else none
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(owner)), pa.array((place - at[owner]).astype(np.int64)),
            pa.array(np.concatenate([h for _, h, _, _ in parts]).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(plain, pa.bool_()),
        ],
        names=["id", "position", "window", "slots", "plain"],
    )


_ROW = "id long, position long, window long, slots array<long>, plain boolean"


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, position, window, slots, plain, size of every benchmark item of at least LEAST words; an
    item shorter than a window is one window. Each position has a window of plain words, and one or two
    of template words if enough of them are literal."""
    rows = benchmark.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("id"), text_of(text).alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.small(batches, 1):
            parsed = templates(batch.column(1))
            value, at = parsed[0], parsed[-1]
            length = np.diff(at)
            for size in sorted({min(n, WINDOW) for n in length.tolist() if n >= LEAST}):
                parts = []
                for place, found, kinds in all_windows(parsed, size):
                    own = np.searchsorted(at, place, "right") - 1
                    keep = np.minimum(length[own], WINDOW) == size
                    parts.append((place[keep], found[keep], kinds, size))
                out = _rows(batch.column(0), at, parts, value)
                yield out.append_column("size", pa.array(np.full(len(out), size), pa.int64()))

    return rows.mapInArrow(run, f"{_ROW}, size long").withColumnRenamed("id", "item_id")


def bitmap(items: DataFrame) -> np.ndarray:
    """2**BITS bits, those of the items' windows set; at most 2**(BITS-6) rows come to the driver."""
    bit = F.shiftrightunsigned("window", 64 - BITS)
    rows = items.select(F.shiftright(bit, 6).alias("cell"), F.expr("shiftleft(1L, cast(shiftrightunsigned(window, {0}) & 63 AS int))".format(64 - BITS)).alias("bits"))
    cells = rows.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out.view(np.uint64)


def document_windows(docs: DataFrame, items: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents' windows that may be the benchmark's: id, position, window, slots, plain."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(bitmap(items))
    sizes = [r[0] for r in items.select("size").distinct().collect()]
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value
        for batch in words.small(batches, 1):
            parsed = templates(batch.column(1))
            parts = []
            for size in sizes:
                for place, found, kinds in all_windows(parsed, size):
                    bit = found >> np.uint64(64 - BITS)
                    may = (known[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
                    parts.append((place[may], found[may], kinds, size))
            if sum(len(p) for p, _, _, _ in parts):
                yield _rows(batch.column(0), parsed[-1], parts, parsed[0])

    return rows.mapInArrow(run, _ROW)


def longest_run(places: Column) -> Column:
    """Length of the longest run of consecutive numbers in a sorted array."""
    number = lambda x: F.lit(x).cast("long")
    start = F.struct(number(-2).alias("last"), number(0).alias("now"), number(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        now = F.when(x == s["last"] + 1, s["now"] + 1).otherwise(number(1))
        return F.struct(x.alias("last"), now.alias("now"), F.greatest(s["best"], now).alias("best"))

    return F.aggregate(places, start, step, lambda s: s["best"])


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Contaminated pairs: doc_id, item_id, coverage, reparameterised (some slot has another value).

    Null and empty texts hold no windows; items with fewer than LEAST words or without an id aren't
    searched for. An item of numbers, names and units has no template windows and is found by its plain
    words. Documents without an id are reported together under null. Repeated rows of either
    table change nothing; other columns are ignored.
    """
    items = stored(item_windows(benchmark, item_id, item_text), "item_windows")
    hits = stored(document_windows(docs, items, doc_id, text), "document_windows")
    slots = F.arrays_zip(F.col("own_slots").alias("i"), F.col("slots").alias("d"))
    typed = items.groupBy("item_id", "position").agg(F.bool_or(~F.col("plain")).alias("typed"))
    own = items.join(typed, ["item_id", "position"])
    own = own.select("item_id", F.col("position").alias("own"), "window", F.col("slots").alias("own_slots"), "typed")
    joined = hits.join(own, "window").select(
        "id", "item_id", (F.col("position") - F.col("own")).alias("offset"), F.struct("own", "plain", "typed", slots.alias("pairs")).alias("w")
    )
    lines = joined.groupBy("id", "item_id", "offset").agg(F.collect_set("w").alias("ws"))
    lines = lines.withColumn("pairs", F.array_distinct(F.flatten("ws.pairs")))
    distinct = lambda name: F.size(F.array_distinct(F.transform("pairs", lambda p: p[name])))
    steady = (distinct("i") == F.size("pairs")) & (distinct("d") == F.size("pairs"))
    torn = F.filter("pairs", lambda p: F.exists("pairs", lambda q: (q["i"] == p["i"]) != (q["d"] == p["d"])))
    lines = lines.withColumn("torn", F.when(steady, F.array_except("pairs", "pairs")).otherwise(torn))
    lines = lines.withColumn("ws", F.filter("ws", lambda w: w["plain"] | ~F.arrays_overlap(w["pairs"], F.col("torn"))))
    places = lambda keep: F.array_distinct(F.filter("ws", keep)["own"])
    lines = lines.select(
        "id", "item_id", places(lambda w: F.lit(True)).alias("places"), places(lambda w: w["typed"]).alias("typed"),
        longest_run(F.array_sort(places(lambda w: w["plain"]))).alias("run"),
        F.exists(F.flatten("ws.pairs"), lambda p: p["i"] != p["d"]).alias("changed"),
    )
    union = lambda c: F.size(F.array_distinct(F.flatten(F.collect_set(c))))
    covered = lines.where(F.size("places") > 0).groupBy("id", "item_id").agg(
        union("places").alias("covered"), union("typed").alias("covered_typed"), F.max("run").alias("run"), F.bool_and("changed").alias("reparameterised")
    )
    whole = typed.groupBy("item_id").agg(F.count(F.lit(1)).alias("windows"), F.count_if("typed").alias("windows_typed"))
    share = F.greatest(F.col("covered") / F.col("windows"), F.expr("try_divide(covered_typed, windows_typed)")).alias("coverage")
    found = covered.join(whole, "item_id").select(F.col("id").alias("doc_id"), "item_id", share, "reparameterised", "run")
    return found.where((F.col("coverage") >= COVERAGE) | (F.col("run") > RUN - WINDOW)).drop("run")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_id (best covered, then smallest), its
    coverage and whether it was reparameterised."""
    best = F.max(F.struct("coverage", (-F.col("item_id")).alias("i"), "reparameterised")).alias("best")
    found = stored(matches(docs, benchmark).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_items"), best), "contaminated")
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.col("best").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        (-F.col("best.i")).alias("item_id"), F.col("best.coverage").alias("coverage"), F.col("best.reparameterised").alias("reparameterised"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that hold a benchmark item; rows without an id stay."""
    gone = stored(matches(docs, benchmark, doc_id, text).select(F.col("doc_id").alias("__gone")).distinct(), "contaminated")
    return docs.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
