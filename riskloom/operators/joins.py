"""Keyed joins.

Keys are made unique before a join wherever the result allows it, so matching is 1:1 and
one hot key cannot blow up a task. A side that may repeat keys goes through `hot_join`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import fixed
from riskloom.sources.staged import stored
from riskloom.operators.keyfilter import may_match
from riskloom.operators.keys import hot_join, key_set, latest_per_key


def merge_sources(
    cna: DataFrame,
    nvd: DataFrame,
    keys: list[str],
    cna_first: dict[str, tuple[str, str]],
    nvd_first: dict[str, tuple[str, str]],
    nvd_nonempty: dict[str, tuple[str, str]],
    keep: list[str] = (),
) -> DataFrame:
    """Full outer join of two sources that each have one row per key.

    The maps give output column -> (cna column, nvd column): `cna_first` and `nvd_first`
    take the first non-null value, `nvd_nonempty` takes the NVD array unless it is empty.
    """
    joined = cna.join(nvd, keys, "full_outer")
    out = {n: F.coalesce(F.col(a), F.col(b)) for n, (a, b) in cna_first.items()}
    out |= {n: F.coalesce(F.col(b), F.col(a)) for n, (a, b) in nvd_first.items()}
    for n, (a, b) in nvd_nonempty.items():
        out[n] = F.when(F.coalesce(F.size(b), F.lit(0)) > 0, F.col(b)).otherwise(F.col(a))
    return joined.select(*keys, *[c.alias(n) for n, c in out.items()], *keep)


def dedupe_cwe(members: DataFrame, keys: list[str], cwe: str, text: str) -> DataFrame:
    """One text (the greatest) per key and CWE id."""
    return members.groupBy(*keys, cwe).agg(F.max(text).alias(text))


def collect_cwe(members: DataFrame, keys: list[str], cwe: str, text: str, name: str) -> DataFrame:
    """Per key the array of (id, text); ids are distinct by now, so it is as long as the
    catalogue of weaknesses at most."""
    entry = F.struct(F.col(cwe).alias("cweId"), F.col(text).alias("cweDescription"))
    return members.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias(name))


def attach(df: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of a table that has one row per key."""
    return df.join(extra, keys, "left")


def delete_matching(
    target: DataFrame, keys_of: DataFrame, keys: list[str], repeats: bool = False
) -> DataFrame:
    """DELETE ... WHERE EXISTS. Say `repeats` when the target has many rows per key."""
    gone = key_set(keys_of, keys)
    return hot_join(target, gone, keys, "left_anti") if repeats else target.join(gone, keys, "left_anti")


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Append the source rows whose key is not in the target yet."""
    return target.unionByName(source.join(key_set(target, keys), keys, "left_anti"))


def update_from(
    target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """UPDATE ... FROM: overwrite `columns` where a (unique) change key matches."""
    marked = changes.select(*keys, *[F.col(c).alias("_n_" + c) for c in columns], F.lit(True).alias("_hit"))
    new = {c: F.when(F.col("_hit"), F.col("_n_" + c)).otherwise(F.col(c)) for c in columns}
    return target.join(marked, keys, "left").withColumns(new).select(*target.columns)


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Replace or insert whole rows; `changes` has one row per key."""
    return delete_matching(target, changes, keys).unionByName(changes)


def newer_than(df: DataFrame, column: str, watermark: DataFrame, wm_column: str) -> DataFrame:
    """Rows above the watermark, which enters the plan as a scalar subquery."""
    return df.where(F.col(column) > watermark.select(F.max(wm_column)).scalar())


def changed_keys(
    staged: DataFrame, current: DataFrame, keys: list[str], hash_col: str = "row_hash"
) -> DataFrame:
    """Keys whose hash differs between a staged row and its (unique) current row."""
    now = current.select(*keys, F.col(hash_col).alias("_now"))
    return (
        staged.select(*keys, hash_col)
        .join(now, keys)
        .where(F.col(hash_col) != F.col("_now"))
        .select(*keys, F.col("_now").alias("old_hash"), F.col(hash_col).alias("new_hash"))
    )


def search(
    requests: DataFrame, maps: dict[str, DataFrame], documents: dict[str, DataFrame]
) -> DataFrame:
    """Documents of every requested (vendor, product) pair, from each source.

    `maps` hold (vendor, product, cveId) rows, `documents` one row per `cveId`. Ids
    without a document drop out. Edges and documents of all sources go through one join each; a filter
    of the requested pairs, then of the ids found, drops the others where they are read.
    """
    wanted = stored(key_set(requests, ["vendor", "product"]), "requests")
    edges, docs = _by_source(maps), _by_source(documents)
    # A pair may own a large share of the ids, and an id may belong to many pairs.
    near = stored(may_match(edges, wanted, ["vendor", "product"]), "near")
    ids = stored(hot_join(near, wanted, ["vendor", "product"], "left_semi"), "search")
    found = may_match(docs, ids, ["source", "cveId"])
    return hot_join(ids, found, ["source", "cveId"], "inner")


def _by_source(tables: dict[str, DataFrame]) -> DataFrame:
    named = [df.withColumn("source", F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def get_record(ids: DataFrame, first: DataFrame, second: DataFrame, key: str = "cveId") -> DataFrame:
    """Requested records from the first source, else from the second."""
    wanted = key_set(ids, [key])
    preferred = first.join(wanted, key, "left_semi")
    fallback = second.join(wanted, key, "left_semi").join(key_set(preferred, [key]), key, "left_anti")
    return preferred.withColumn("source", F.lit(1)).unionByName(
        fallback.withColumn("source", F.lit(2)), allowMissingColumns=True
    )


def upsert_documents(target: DataFrame, changed: DataFrame, key: str, newest: list[str]) -> DataFrame:
    """Replace or insert documents by id; the newest changed version wins."""
    return upsert(target, latest_per_key(changed, [key], newest), [key])


def fits(keys: list[str], widths: dict[str, int] = fixed.WAREHOUSE_WIDTHS) -> Column:
    """Whether the key columns of a row fit the warehouse table uncut."""
    cond = F.lit(True)
    for k in keys:
        if k in widths:
            cond = cond & F.coalesce(F.length(F.col(k).cast("string")) <= widths[k], F.lit(True))
    return cond


def warehouse_columns(df: DataFrame, widths: dict[str, int] = fixed.WAREHOUSE_WIDTHS) -> DataFrame:
    """Cut text columns to the widths of the warehouse table. Rows whose keys don't fit must be
    taken out first (see `fits`): cut keys of different rows could be the same."""
    narrow = {c: F.substring(F.col(c).cast("string"), 1, n) for c, n in widths.items() if c in df.columns}
    return df.withColumns(narrow)
