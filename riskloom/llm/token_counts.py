"""Token counts of parts of a document, by the character offsets of its tokens.

A document is encoded once, as a whole: parts encoded alone would be split differently at their
borders. Byte lengths of the tokens give their character spans, which are joined with the spans of
the document's sections (both sorted, so a binary search in a numpy array per document).

A token may cross a border. Rules: `first` gives it to the section of its first character, `last` to
that of its last, `most` to the one that holds most of its characters (the earlier one of equals).
A token whose deciding characters lie in no section is counted as outside.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm.bpe import Decoder, Encoder, Vocabulary, shared_file
from riskloom.llm.common import table, text_of
from riskloom.llm.pii import running
from riskloom.llm.words import small

RULES = ("first", "last", "most")
FIELDS = ("title", "table", "body")


def character_spans(text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end, in characters, of tokens with these byte lengths. Tokens that share a character
    each span all of it."""
    chars = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    ends = np.cumsum(sizes)
    return chars[ends - sizes] - 1, chars[ends - 1]


def disjoint(opens: np.ndarray, closes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted borders of overlapping sections and the owner of the characters before, between and behind
    them: the last section that holds them, -1 for none."""
    bounds, held, k = np.unique(np.concatenate([opens, closes])), [], 0
    owner = np.full(len(bounds) + 1, -1, np.int64)
    for i, b in enumerate(bounds.tolist(), 1):
        while k < len(opens) and opens[k] <= b:
            heappush(held, -k)
            k += 1
        while held and closes[-held[0]] <= b:
            heappop(held)
        if held:
            owner[i] = -held[0]
    return bounds, owner


def attributed(start: np.ndarray, end: np.ndarray, opens: np.ndarray, closes: np.ndarray, rule: str) -> tuple[np.ndarray, int, int]:
    """Tokens of each section, tokens outside all, tokens that cross a border.

    Sections are sorted by start; where they overlap, a character belongs to the later one that holds it.
    """
    if (opens[1:] < np.maximum.accumulate(closes)[:-1]).any():
        bounds, owner = disjoint(opens, closes)
    else:
        bounds = None

    def section(at: np.ndarray) -> np.ndarray:
        if bounds is not None:
            return owner[np.searchsorted(bounds, at, "right")]
        k = np.searchsorted(opens, at, "right") - 1
        return np.where((k >= 0) & (at < closes[np.maximum(k, 0)]), k, -1)

    if not len(opens):
        return np.zeros(0, np.int64), len(start), 0
    first, last = section(start), section(end - 1)
    crossing = np.flatnonzero(first != last)
    chosen = (last if rule == "last" else first).copy()
    if rule == "most":
        for i in crossing.tolist():
            own = section(np.arange(start[i], end[i]))
            kinds, at, sizes = np.unique(own, return_index=True, return_counts=True)
            chosen[i] = kinds[np.lexsort((at, -sizes))[0]]
    return np.bincount(chosen[chosen >= 0], minlength=len(opens)), int((chosen < 0).sum()), len(crossing)


def count(docs: DataFrame, keys: list[str], sections: str, text: str = "text", rule: str = "most", tokenizer: str | None = None) -> DataFrame:
    """Columns `keys`, n_tokens, n_outside, n_crossing and counts array<long>, one for each section.

    `sections`: column array<struct<start int, end int, ...>>, sorted by start, ends exclusive, in
    characters. Counts and n_outside add up to n_tokens. Null and empty texts have no tokens; with
    null or no sections all tokens are outside. Rows stay in number, repeated rows and null keys
    included; other columns are ignored. Map-only.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    file = shared_file(docs.sparkSession, tokenizer)
    spans = F.coalesce(F.col(sections), F.array().cast(docs.schema[sections].dataType))
    rows = docs.select(*keys, F.transform(spans, lambda s: s["start"]).alias("__opens"), F.transform(spans, lambda s: s["end"]).alias("__closes"), text_of(text).alias("__text"))
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(file.value)
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in small(batches, width + 2):
            total, outside, crossing, counts = [], [], [], []
            lists = (batch.column(width), batch.column(width + 1))
            opens, closes = (c.flatten().to_numpy(zero_copy_only=False) for c in lists)
            at = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))])
            for k, value in enumerate(batch.column(width + 2)):
                body = value.as_py()
                ids = encoder.encode(body)
                start, end = character_spans(body.encode("utf-8"), decoder.lengths(ids)) if len(ids) else (np.empty(0, np.int64),) * 2
                own, out, over = attributed(start, end, opens[at[k] : at[k + 1]], closes[at[k] : at[k + 1]], rule)
                total.append(len(ids))
                outside.append(out)
                crossing.append(over)
                counts.append(own)
            flat = pa.array(np.concatenate(counts).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], *(pa.array(c, pa.int64()) for c in (total, outside, crossing)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), flat)],
                names=[*keys, "n_tokens", "n_outside", "n_crossing", "counts"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:width])
    return rows.mapInArrow(run, f"{kinds}, n_tokens long, n_outside long, n_crossing long, counts array<long>")


def with_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text and `sections` array<struct<field, start, end>>: the lines of the text, line ends
    included. The first is the title, lines with cell borders are table, the others body."""
    rows = docs.select("doc_id", text_of().alias("text"))
    rows = rows.withColumn("lines", F.split("text", "\n", -1))
    rows = rows.withColumn("sizes", F.transform("lines", lambda line: F.length(line) + 1))
    rows = rows.withColumn("ends", running(F.col("sizes"))).withColumn("length", F.length("text"))
    starts = F.slice(F.concat(F.array(F.lit(0)), F.col("ends")), F.lit(1), F.size("ends"))
    spans = F.arrays_zip(F.col("lines").alias("line"), starts.alias("start"), F.col("ends").alias("end"))
    kind = lambda line, i: F.when(i == 0, "title").when(F.contains(line, F.lit(" | ")), "table").otherwise("body")
    return rows.select(
        "doc_id", "text",
        F.transform(
            spans, lambda z, i: F.struct(kind(z["line"], i).alias("field"), z["start"].alias("start"), F.least(z["end"], F.col("length")).alias("end"))
        ).alias("sections"),
    )


def by_field(docs: DataFrame, rule: str = "most") -> DataFrame:
    """Per document and field: doc_id, field, n_sections, n_chars, n_tokens, and the document's
    doc_tokens, n_crossing."""
    sized = F.transform("sections", lambda s: F.struct(s["field"].alias("field"), (s["end"] - s["start"]).alias("size")))
    counted = count(with_lines(docs).withColumn("fields", sized), ["doc_id", "fields"], "sections", rule=rule)
    parts = F.arrays_zip(F.col("fields"), F.col("counts").alias("tokens"))
    own = lambda kind: F.filter("parts", lambda p: p["fields"]["field"] == kind)
    sums = [
        F.struct(
            F.lit(kind).alias("field"), F.size(own(kind)).cast("long").alias("n_sections"),
            F.aggregate(own(kind), F.lit(0).cast("long"), lambda a, p: a + p["fields"]["size"]).alias("n_chars"),
            F.aggregate(own(kind), F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("n_tokens"),
        )
        for kind in FIELDS
    ]
    rows = counted.select("doc_id", F.col("n_tokens").alias("doc_tokens"), "n_crossing", parts.alias("parts"))
    return rows.select("doc_id", "doc_tokens", "n_crossing", F.inline(F.array(*sums)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_field(table(spark, sf_dir, "documents"))
