"""Intermediate results as written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskloom.session import shared_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: pruned by later reads, with statistics,
    and independent of the executors that made them."""
    path = shared_dir(df.sparkSession, "staged", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
