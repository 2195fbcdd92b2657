"""Registry of queries and of the DuckDB texts they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.plans import feed
from riskloom.session import ensure_shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def add(name: str, query: Query, check: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_shared_folder(spark)
        return query(spark, sf_dir)

    QUERIES[name] = run
    if check is not None:
        CHECKS[name] = check


def flat(df: DataFrame) -> DataFrame:
    """Dates and times as text, so both engines compare the same values."""
    cols = []
    for name, kind in df.dtypes:
        text = kind in ("date", "timestamp", "timestamp_ntz")
        cols.append(F.col(name).cast("string").alias(name) if text else F.col(name))
    return df.select(*cols)


def add_columns(
    name: str, table: str, keep: str, columns: dict[str, Column | Callable], check: str, first: dict[str, Callable] | None = None
) -> None:
    """Register expressions over one table; `keep` names the passed-through columns.

    Columns are made lazily (a callable), since a Column needs a running session. Those in `first` are
    made before the others, which name them: a document read in several places is parsed once a row.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = feed.records(spark, sf_dir) if table == "records" else feed.table(spark, sf_dir, table)
        if first:
            source = source.withColumns({n: c() for n, c in first.items()})
        made = [c().alias(n) for n, c in columns.items()]
        return flat(source.select(*keep.split(), *made))

    add(name, query, check)
