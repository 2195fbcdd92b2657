"""Quality classifier: document evidence combined with host and path posteriors.

A logistic model over features of the whole text, fitted on a bounded sample of labelled rows, gives
each document its own log-odds. Hosts and paths (host and language) get posteriors by hierarchical
empirical Bayes: each path's rate of good documents (labels where known, the model's probability
elsewhere, over *all* documents) is shrunk towards its host's, each host's towards the global rate.
How strongly follows from the spread of the rates themselves: the pseudo-count of each level is
estimated by the method of moments. A document's score is its own log-odds plus what its path's
posterior adds to the global one; sparse sites add next to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm import words
from riskloom.llm.common import stored, table, text_of

#: Labelled rows that the model is fitted on, at most: those with the smallest hashes of their ids.
LABELLED = 20_000
#: Documents whose posterior probability of being good is at least this are kept.
KEEP = 0.5
#: Pseudo-counts lie between these.
WEAKEST, STRONGEST = 2.0, 1e6
NAMES = (
    "size", "words", "upper", "digits", "symbols", "marks", "bars", "lines", "wide", "word_length", "distinct", "repeats",
    "upper_squared", "symbols_root", "distinct_squared",
)
_CODES = np.arange(256)
_CLASSES = {
    "upper": (_CODES >= 65) & (_CODES <= 90), "lower": (_CODES >= 97) & (_CODES <= 122), "digits": (_CODES >= 48) & (_CODES <= 57),
    "symbols": np.isin(_CODES, np.frombuffer(b"#$%&*@~^_=+<>{}[]\\/", np.uint8)), "marks": np.isin(_CODES, np.frombuffer(b"!?", np.uint8)),
    "bars": _CODES == ord("|"), "lines": _CODES == 10, "wide": _CODES >= 128,
}


def features(texts: pa.Array) -> np.ndarray:
    """One row of NAMES for each text of an array without nulls. An empty text has zeros."""
    out = np.zeros((len(texts), len(NAMES)))
    if not len(texts):
        return out
    raw, offsets = words.buffer_of(texts)
    size = np.diff(offsets)
    counts = {}
    for name, inside in _CLASSES.items():
        sums = np.concatenate([[0], np.cumsum(inside[raw], dtype=np.int64)])
        counts[name] = sums[offsets[1:]] - sums[offsets[:-1]]
    hashed, at = words.lower_words(texts)
    number = np.diff(at)
    same = np.concatenate([[0], np.cumsum(np.concatenate([[False], hashed[1:] == hashed[:-1]]))]) if len(hashed) else np.zeros(1, np.int64)
    repeats = same[at[1:]] - same[np.minimum(at[:-1] + 1, at[1:])]
    distinct = np.array([len(np.unique(hashed[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)])
    chars, many = np.maximum(size, 1), np.maximum(number, 1)
    letters = np.maximum(counts["upper"] + counts["lower"] + counts["wide"], 1)
    upper, symbols = counts["upper"] / letters, counts["symbols"] / chars
    # Distinct words grow more slowly than words; the share of this power doesn't fall with length.
    variety = distinct / many**0.75
    rows = (
        np.log1p(size), np.log1p(number), upper, counts["digits"] / chars, symbols, counts["marks"] / many, counts["bars"] / many,
        counts["lines"] / many, counts["wide"] / chars, np.log(chars / many), variety, repeats / many, upper**2, np.sqrt(symbols), variety**2,
    )
    return np.where((size > 0)[:, None], np.stack(rows, 1), 0.0)


@dataclass(frozen=True)
class Model:
    """Weights of the standardised features, the last for the intercept."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(((rows - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1], -12, 12)

    def column(self, values: Column) -> Column:
        """The same as an expression over a feature array."""
        slope = self.weights[:-1] / self.scale
        start = float(self.weights[-1] - (self.mean * slope).sum())
        total = sum((values[i] * F.lit(float(s)) for i, s in enumerate(slope)), F.lit(start))
        return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), total))


def fit(rows: np.ndarray, good: np.ndarray, penalty: float = 1.0, steps: int = 50) -> Model:
    """Penalised logistic regression by Newton steps. Without rows of both kinds only the smoothed
    rate is fitted; without any row it is even."""
    n, k = rows.shape
    mean, scale = (rows.mean(0), np.maximum(rows.std(0), 1e-9)) if n else (np.zeros(k), np.ones(k))
    weights = np.zeros(k + 1)
    rate = (good.sum() + 1) / (n + 2)
    weights[-1] = np.log(rate / (1 - rate))
    if not n or good.min() == good.max():
        return Model(mean, scale, weights)
    x = np.concatenate([(rows - mean) / scale, np.ones((n, 1))], 1)
    ridge = np.diag([penalty] * k + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (good - p) - ridge @ weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return Model(mean, scale, weights)


def feature_rows(docs: DataFrame) -> DataFrame:
    """doc_id, host, path and features of every document."""

    @F.arrow_udf("array<double>")
    def featured(texts: pa.Array) -> pa.Array:
        found = _by_parts(texts, features)
        ends = np.arange(len(found) + 1, dtype=np.int32) * len(NAMES)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

    return docs.select("doc_id", *site_columns(), featured(text_of()).alias("features"))


def _by_parts(texts: pa.Array, f) -> np.ndarray:
    parts = [f(b.column(0)) for b in words.small([pa.RecordBatch.from_arrays([texts], names=["t"])], 0)]
    return np.concatenate(parts) if parts else f(texts)


def site_columns(source: Column | None = None, lang: Column | None = None) -> list[Column]:
    """Host is the source, path the source and language; nulls count as a site of their own."""
    source, lang = (F.coalesce((F.col(n) if c is None else c).cast("string"), F.lit("")) for n, c in (("source", source), ("lang", lang)))
    return [source.alias("host"), F.concat_ws("/", source, lang).alias("path")]


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id, good: the mean of a document's quality labels; rows with nulls are dropped."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("good"))


def train(rows: DataFrame, labels: DataFrame, most: int = LABELLED) -> Model:
    """Model from at most `most` labelled documents; their features come to the driver."""
    picked = labelled(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = rows.join(F.broadcast(picked), "doc_id").orderBy("doc_id").select("features", "good").limit(most).toArrow()
    x = found["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
    return fit(x, found["good"].to_numpy())


def strength(rates: DataFrame, rate: str, prior: Column, count: str) -> float:
    """Pseudo-count of a level by the method of moments: the spread of the rates beyond what counts
    of that size explain. Weighted by count; one aggregation, one number to the driver."""
    weight = F.col(count)
    noise = prior * (1 - prior)
    row = rates.agg(
        F.sum(weight * (F.col(rate) - prior) ** 2).alias("spread"), F.sum(noise).alias("noise"), F.sum(weight * noise).alias("scale"), F.sum(weight).alias("n")
    ).first()
    if not row["n"] or not row["scale"]:
        return STRONGEST
    between = (row["spread"] - row["noise"]) / row["n"]
    return min(STRONGEST, max(WEAKEST, row["scale"] / row["n"] / between - 1)) if between > 0 else STRONGEST


def sites(rows: DataFrame, labels: DataFrame, model: Model) -> DataFrame:
    """path, host, n_path, n_host, host_rate, path_rate (both shrunk) and lift: the log-odds that the
    path adds."""
    p = 1 / (1 + F.exp(-model.column(F.col("features"))))
    known = rows.select("doc_id", "host", "path", p.alias("p")).join(labelled(labels), "doc_id", "left")
    paths = stored(known.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n_path"), F.sum(F.coalesce("good", "p")).alias("sum_path")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("sum_path").alias("sum_host")), "hosts")
    total = hosts.agg(F.sum("sum_host").alias("s"), F.sum("n_host").alias("n")).first()
    overall = ((total["s"] or 0) + 1) / ((total["n"] or 0) + 2)
    k = strength(hosts.withColumn("rate", F.col("sum_host") / F.col("n_host")), "rate", F.lit(overall), "n_host")
    hosts = hosts.select("host", "n_host", ((F.col("sum_host") + k * overall) / (F.col("n_host") + k)).alias("host_rate"))
    joined = stored(paths.join(hosts, "host"), "path_rates")
    k = strength(joined.withColumn("rate", F.col("sum_path") / F.col("n_path")), "rate", F.col("host_rate"), "n_path")
    rate = (F.col("sum_path") + k * F.col("host_rate")) / (F.col("n_path") + k)
    safe = joined.withColumn("path_rate", F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), rate)))
    odds = F.ln(F.col("path_rate") / (1 - F.col("path_rate"))) - F.lit(float(np.log(overall / (1 - overall))))
    return stored(safe.select("path", "host", "n_path", "n_host", "host_rate", "path_rate", odds.alias("lift")), "sites")


def judged(evidence: Column) -> Column:
    """Posterior probability from a document's own log-odds and its path's lift."""
    return 1 / (1 + F.exp(-(evidence + F.coalesce(F.col("lift"), F.lit(0.0)))))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, evidence, host_rate, path_rate, posterior, kept.

    `docs`: doc_id, text, source, lang; `labels`: doc_id, quality (0 or 1). Null texts count as
    empty, null sources and languages as sites of their own. Without labels every document has even
    evidence and is kept. Repeated rows are judged alike; other columns are ignored.
    """
    rows = stored(feature_rows(docs), "features")
    model = train(rows, labels)
    place = sites(rows, labels, model)
    own = rows.select("doc_id", "path", model.column(F.col("features")).alias("evidence")).join(place, "path", "left")
    return own.select("doc_id", "evidence", "host_rate", "path_rate", judged(F.col("evidence")).alias("posterior")).withColumn("kept", F.col("posterior") >= KEEP)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, all columns unchanged. Features are computed again
    for the decision, so that texts aren't shuffled to meet it; whole rows pass the task in small parts."""
    rows = stored(feature_rows(docs), "features")
    model = train(rows, labels)
    place = sites(rows, labels, model).select(F.col("path").alias("__path"), "lift")
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    marked = plain.select("*", site_columns(*(F.col(names[docs.columns.index(c)]) for c in ("source", "lang")))[1].alias("__path"), text_of(names[docs.columns.index("text")]).alias("__text"))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = len(names) + 1
        for batch in words.small(batches, last):
            odds = model.log_odds(features(batch.column(last)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(odds)], names=[*names, "__path", "__own"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    judged_rows = marked.mapInArrow(own, f"{kinds}, `__path` string, `__own` double")
    kept = judged_rows.join(place, "__path", "left").where(judged(F.col("__own")) >= KEEP)
    return kept.select(*names).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
