"""LM scoring by a log-bilinear model, trained with noise-contrastive estimation in numpy.

Token counts cover the whole training part of the corpus. The most frequent tokens (at most HEAD, of
bounded length) are broadcast, so their counts are added in the map stage; the other tokens of a
document meet their counts in a join.

The neural model works on symbols: the end of text, the WORDS most frequent tokens, and CLASSES
classes of all other tokens by their last bytes. A symbol is predicted from the one before it: its
context vector, times a context matrix, meets every symbol's target vector in a matrix product, plus
a bias. Training uses counts of symbol pairs over all training documents (a table of fixed size), and
takes the noise-contrastive objective in expectation, over all pairs and all noise symbols at once,
so no sampling is involved. Matrix products over blocks of contexts then give the exactly normalised
table that scores texts. A token of a class has the class's probability times its share of the
class, (count + 1) / (sum of (count + 1) over the class's tokens + 1), which leaves one share for
tokens never seen.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm.common import stored, table, text_of
from riskloom.llm.words import small

#: Held-out documents have this remainder.
FOLDS, HELD_OUT = 7, 2
#: Broadcast tokens at most and their longest length in bytes; symbols; entries of a task's counter.
HEAD, LONGEST, WORDS, CLASSES, COUNTED = 100_000, 64, 1000, 256, 500_000
WIDTH, NOISE, STEPS, RATE = 32, 10.0, 100, 0.03
#: Pairs that each context is credited with, spread by the symbols' frequency: rare contexts stay close
#: to it.
PRIOR = 100.0
SYMBOLS = 1 + WORDS + CLASSES
_ROWS = 256


def held_out(doc_id: str) -> Column:
    """Whether a document isn't learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8: A-Z in lower case, cut at ASCII white space. The end token, the
    empty word, isn't included."""
    return text.lower().split()


def class_of(token: bytes) -> int:
    return 1 + WORDS + zlib.crc32(token[-3:]) % CLASSES


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in small(batches, column):
        yield batch, batch.column(column).cast(pa.binary()).to_pylist()


def token_counts(texts: DataFrame) -> DataFrame:
    """token binary, n: counts over column `text`, with the empty token once for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, bodies in _texts(batches, 0):
            for body in bodies:
                seen.update(tokens_of(body))
            seen[b""] += len(bodies)
            if len(seen) >= COUNTED:
                yield from _counted(seen)
                seen.clear()
        yield from _counted(seen)

    return texts.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _counted(seen: Counter) -> Iterator[pa.RecordBatch]:
    names = list(seen)
    for k in range(0, len(names), 50_000):
        part = names[k : k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([seen[t] for t in part], pa.int64())], names=["token", "n"])


@dataclass(frozen=True)
class Counts:
    """What the driver knows of the token counts: totals, and the head with its counts (descending)."""

    total: int
    distinct: int
    ends: int
    head: list[bytes]
    number: np.ndarray
    mass: np.ndarray

    def symbol(self) -> np.ndarray:
        """Symbol of each head token."""
        return np.array([1 + k if k < WORDS else class_of(t) for k, t in enumerate(self.head)], np.int32)


def summarize(counts: DataFrame) -> Counts:
    """Totals, head and class masses of `counts`. The head is cut at a count that leaves at most HEAD
    tokens, found from a histogram of the counts' logarithms."""
    level = F.floor(F.log2("n") * 16)
    words = counts.where("token != X''")
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.col("token") == F.lit(b""), F.col("n"))).alias("ends")).first()
    short = words.where(F.length("token") <= LONGEST)
    levels = sorted(((r["level"], r["count"]) for r in short.groupBy(level.alias("level")).count().collect()), reverse=True)
    cut, many = None, 0
    for at, number in levels:
        many += number
        if many > HEAD:
            break
        cut = at
    rows = short.where(level >= cut).select("token", "n").toArrow().to_pydict() if cut is not None else {"token": [], "n": []}
    order = sorted(range(len(rows["n"])), key=lambda i: (-rows["n"][i], rows["token"][i]))
    head = [rows["token"][i] for i in order]
    number = np.array([rows["n"][i] for i in order], np.int64)
    # All words by class, less those that are symbols of their own.
    suffix = F.expr(f"crc32(substring(token, greatest(1, length(token) - 2), 3)) % {CLASSES}")
    mass = np.zeros(SYMBOLS)
    for r in words.groupBy(suffix.alias("k")).agg(F.sum(F.col("n") + 1).alias("m")).collect():
        mass[1 + WORDS + r["k"]] = r["m"]
    for token, n in zip(head[:WORDS], number[:WORDS].tolist(), strict=True):
        mass[class_of(token)] -= n + 1
    return Counts(total["n"] or 0, total["v"] or 0, total["ends"] or 0, head, number, mass)


def _symbols(words: list[bytes], known: dict[bytes, int], symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Head number (-1: none) and symbol of each word."""
    ids = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
    out = symbol[ids] if len(symbol) else np.zeros(len(ids), np.int32)
    for k in np.flatnonzero(ids < 0).tolist():
        out[k] = class_of(words[k])
    return ids, out


def pair_counts(texts: DataFrame, counts: Counts) -> np.ndarray:
    """Counts of following symbols over column `text`, [before, after]; texts begin and end with 0.
    The table has SYMBOLS**2 cells whatever the corpus."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        known, symbol = {t: k for k, t in enumerate(own.head)}, own.symbol()
        cells = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for _, bodies in _texts(batches, 0):
            lines = [np.zeros(1, np.int64)]
            for body in bodies:
                lines += [_symbols(tokens_of(body), known, symbol)[1].astype(np.int64), np.zeros(1, np.int64)]
            line = np.concatenate(lines)
            cells += np.bincount(line[:-1] * SYMBOLS + line[1:], minlength=len(cells))
        used = np.flatnonzero(cells)
        for k in range(0, len(used), 100_000):
            part = used[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(cells[part])], names=["cell", "n"])

    found = texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS * SYMBOLS)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(SYMBOLS, SYMBOLS)


def train(pairs: np.ndarray, steps: int = STEPS, seed: int = 1) -> np.ndarray:
    """Log10 probability of each symbol after each, from pair counts; rows are normalised.

    Scores are log-bilinear: (context vector x context matrix) . target vector + bias. Adam on the
    expected noise-contrastive objective with NOISE noise symbols, drawn by smoothed frequency, for
    each pair. PRIOR pairs by that frequency are added to each context.
    """
    size = len(pairs)
    draws = np.random.default_rng(seed)
    noise = (pairs.sum(0) + 1) / (pairs.sum() + size)
    pairs = pairs + PRIOR * noise
    before = pairs.sum(1)
    values = [
        draws.normal(0, 0.1, (size, WIDTH)), np.eye(WIDTH), draws.normal(0, 0.1, (size, WIDTH)), np.log(noise)[None],
    ]
    values = [v.astype(np.float32) for v in values]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    level = np.log(NOISE * noise).astype(np.float32)
    total = pairs.sum()
    for step in range(1, steps + 1):
        context, matrix, target, bias = values
        slopes = [np.zeros_like(v) for v in values]
        for k in range(0, size, _ROWS):
            rows = slice(k, k + _ROWS)
            mapped = context[rows] @ matrix
            data = 1 / (1 + np.exp(np.minimum(level - mapped @ target.T - bias, 80)))
            push = (pairs[rows] / total).astype(np.float32)
            push = push * (1 - data) - (NOISE * before[rows, None] / total * noise).astype(np.float32) * data
            back = push @ target
            slopes[0][rows] = back @ matrix.T
            slopes[1] += context[rows].T @ back
            slopes[2] += push.T @ mapped
            slopes[3] += push.sum(0)
        pace = RATE * min(1.0, 3 * (1 - (step - 1) / steps))
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope * slope
            values[k] = values[k] + pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-12)
    return normalized(*values)


def normalized(context: np.ndarray, matrix: np.ndarray, target: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Log10 probabilities of all symbols after each context, block by block."""
    out = np.empty((len(context), len(target)), np.float32)
    for k in range(0, len(context), _ROWS):
        score = (context[k : k + _ROWS] @ matrix @ target.T + bias).astype(np.float64)
        top = score.max(1, keepdims=True)
        out[k : k + _ROWS] = (score - top - np.log(np.exp(score - top).sum(1, keepdims=True))) / np.log(10)
    return out


def head_scores(rows: DataFrame, counts: Counts, model: np.ndarray) -> DataFrame:
    """What the map stage knows of each row (doc_id, held_out, text): uid, doc_id, held_out, n_tokens,
    n_known, base, model and the tokens outside the head as rest array<struct<token, n, class>>.

    `base` sums log10(count + 1), `model` log10 probabilities of symbols and of shares in classes.
    """
    shared = rows.sparkSession.sparkContext.broadcast((counts, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, table_ = shared.value
        known, symbol = {t: k for k, t in enumerate(own.head)}, own.symbol()
        plus = np.log10(own.number + 1.0)
        share = np.where(symbol > WORDS, plus - np.log10(own.mass[symbol] + 1), 0.0)
        end = np.log10(own.ends + 1.0)
        uid = TaskContext.get().partitionId() << 40
        for batch, bodies in _texts(batches, 2):
            out, ends, rest = [], [0], []
            for body in bodies:
                words = tokens_of(body)
                ids, line = _symbols(words, known, symbol)
                line = np.concatenate([[0], line, [0]])
                inside = ids[ids >= 0]
                score = float(table_[line[:-1], line[1:]].sum(dtype=np.float64) + share[inside].sum())
                others = Counter(words[k] for k in np.flatnonzero(ids < 0).tolist())
                rest += others.items()
                ends.append(len(rest))
                out.append((uid, len(words) + 1, len(inside) + (own.ends > 0), float(plus[inside].sum() + end), score))
                uid += 1
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
            names = [t for t, _ in rest]
            parts = pa.StructArray.from_arrays(
                [pa.array(names, pa.binary()), pa.array([n for _, n in rest], pa.int64()), pa.array([class_of(t) for t in names], pa.int32())], names=["token", "n", "class"]
            )
            lists = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), parts)
            yield pa.RecordBatch.from_arrays(
                [columns[0], batch.column(0), batch.column(1), *columns[1:], lists],
                names=["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rest"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        run,
        f"uid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, "
        "rest array<struct<token: binary, n: long, class: int>>",
    )


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts have one token, the end. Repeated rows are scored each (and counted each in
    training). Without any training document all counts are zero and symbols are even. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), text_of(text).alias("text"))
    learned = rows.where(~F.col("held_out"))
    counted = stored(token_counts(learned), "token_counts")
    counts = summarize(counted)
    model = train(pair_counts(learned, counts))
    first = stored(head_scores(rows, counts, model), "head_scores")
    masses = spark.createDataFrame([(k, float(np.log10(m + 1))) for k, m in enumerate(counts.mass.tolist())], "class int, log_mass double")
    rest = first.select("uid", F.inline("rest")).join(counted.withColumnRenamed("n", "count"), "token", "left").join(F.broadcast(masses), "class")
    plus = F.log10(F.coalesce("count", F.lit(0)) + 1)
    added = rest.groupBy("uid").agg(
        F.sum(F.col("n") * plus).alias("more_base"), F.sum(F.col("n") * (plus - F.col("log_mass"))).alias("more_model"),
        F.sum(F.when(F.col("count") > 0, F.col("n"))).alias("more_known"),
    )
    each = F.lit(float(np.log10(counts.total + counts.distinct + 1)))
    more = lambda c: F.coalesce(F.col(c), F.lit(0))
    return first.drop("rest").join(added, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more("more_known")).alias("n_known"), F.lit(counts.total).cast("long").alias("train_tokens"),
        (F.col("base") + more("more_base") - F.col("n_tokens") * each).alias("base_score"), (F.col("model") + more("more_model")).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
