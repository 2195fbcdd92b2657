"""Corpus pipeline: quality, exact copies, near copies, benchmark passages, tokens.

Each stage works on all rows that its predecessor kept and applies its decisions; all but the last
return the columns of `documents`. Rows without a doc_id pass the stages that name documents by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, decontam, exact_dedup, order_minhash, quality
from riskloom.llm.common import stored, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: that with the greatest id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return order_minhash.drop_near(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of each text, and the digest of the text decoded from them."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality classifier", good),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", clean),
    ("tokens", tokens),
]

#: The classifier, the near copies, the templates and the encoder aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result of the last stage; what each stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
