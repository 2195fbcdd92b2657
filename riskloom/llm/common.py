"""Reading tables, cutting lineage and small expressions that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: later reads are column-pruned and
    don't depend on the executors that made them."""
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def hashed(*cols: Column) -> Column:
    """128 bits from two differently seeded 64-bit hashes, as a struct."""
    return F.struct(F.xxhash64(F.lit(1), *cols).alias("a"), F.xxhash64(F.lit(2), *cols).alias("b"))
