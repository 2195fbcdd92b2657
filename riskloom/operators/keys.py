"""Key sets, duplicates and one-row-per-key choices.

A key may hold a large share of all rows. Every operator here shrinks such a key on
the map side: grouped counts combine partially, and `row_number() = 1` is planned as
a partial group limit before the shuffle, so each task sends one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.scoring import completeness
from riskloom.operators.keyfilter import split
from riskloom.sources.staged import stored


def key_set(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right["_h_" + k])
    return cond


HOT_SHARE, SALTS = 1e-4, 32


def hot_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, share: float = HOT_SHARE, salts: int = SALTS
) -> DataFrame:
    """Join a side that may repeat keys with one that has a row per key, safe for hot keys.

    Keys with more than `share` of the left rows, of which there can be only `1 / share`, are
    known to both sides by broadcast. Their left rows are dealt over `salts` tasks and their
    right rows sent to each of these; all other keys take the usual way of the same join. Rows
    of the right side, however wide, are never broadcast. Null keys match null keys. `how` is
    inner, left, left_semi or left_anti. The left side is read twice: hand over a table.
    """
    counts = left.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = counts.select(F.sum("_rows")).scalar()
    hot = F.broadcast(
        counts.where(F.col("_rows") > total * F.lit(share)).select(*[F.col(k).alias("_h_" + k) for k in keys], F.lit(salts).alias("_salts"))
    )
    dealt = F.when(F.col("_salts").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.col("_salts"))).otherwise(0).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    salted = left.join(hot, _same(left, hot, keys), "left").select(*left.columns, dealt.alias("_salt"))
    copies = right.join(hot, _same(right, hot, keys), "left").select(
        *[F.col(k).alias("_h_" + k) for k in keys], *[c for c in right.columns if c not in keys], each.alias("_h__salt")
    )
    joined = salted.join(copies, _same(salted, copies, [*keys, "_salt"]), how)
    extra = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    return joined.select(*left.columns, *extra)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found on more than one row."""
    return df.groupBy(*keys).count().where("count > 1").drop("count")


def mark_duplicates(df: DataFrame, keys: list[str], name: str = "repeated", share: float = HOT_SHARE) -> DataFrame:
    """Rows with a flag whether their key repeats; null keys count like any other. The rows are
    read three times: hand over a table."""
    dup = duplicate_keys(df, keys).withColumn(name, F.lit(True))
    return hot_join(df, dup, keys, "left", share).withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def split_duplicates(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key repeats, rows whose key is unique)."""
    marked = mark_duplicates(df, keys, "_repeated")
    return marked.where("_repeated").drop("_repeated"), marked.where("NOT _repeated").drop("_repeated")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_per_key(
    df: DataFrame, keys: list[str], newest: list[str], ties: list[str] | None = None
) -> DataFrame:
    """Newest row of each key. `ties` (default: all other columns) make the choice total."""
    others = [c for c in df.columns if c not in keys and c not in newest]
    order = [F.col(c).desc_nulls_last() for c in newest]
    order += [F.col(c).asc_nulls_last() for c in (others if ties is None else ties)]
    return first_per_key(df, keys, order)


def most_complete_per_key(
    df: DataFrame, keys: list[str], ties: list[str] | None = None
) -> DataFrame:
    """Row with the most non-null columns of each key, total order through `ties`."""
    others = [c for c in df.columns if c not in keys]
    order = [completeness(others).desc()]
    order += [F.col(c).asc_nulls_last() for c in (others if ties is None else ties)]
    return first_per_key(df, keys, order)


def latest_partition(df: DataFrame, col: str) -> DataFrame:
    """Rows of the newest partition; the maximum is a scalar subquery."""
    newest = df.select(F.max(col)).scalar()
    return df.where(F.col(col) == newest)


def collect_distinct(df: DataFrame, keys: list[str], arrays: dict[str, str]) -> DataFrame:
    """Distinct members of array columns per key; `arrays` maps output name to input.

    Every key stays, null keys too; a key whose arrays are all empty or null gets an empty array.
    All arrays go through one long form (key, array, member), made distinct with map-side
    combining, so no task ever sees the repeated arrays of one key. A marker row per key and task
    keeps keys without members.
    """
    member = dict(df.select(*[F.explode(a).alias(n) for n, a in arrays.items()][:1]).dtypes)
    kind = next(iter(member.values()))
    listed = [
        F.transform(F.coalesce(F.col(a), F.array().cast(f"array<{kind}>")), _entry(n)) for n, a in arrays.items()
    ]
    marker = F.array(F.struct(F.lit("").alias("a"), F.lit(None).cast(kind).alias("m")))
    rows = df.select(*keys, F.explode(F.concat(marker, *listed)).alias("_e")).select(*keys, "_e.a", "_e.m").distinct()
    return rows.groupBy(*keys).agg(
        *[F.array_sort(F.collect_list(F.when(F.col("a") == n, F.col("m")))).alias(n) for n in arrays]
    )


def _entry(name: str):
    return lambda m: F.struct(F.lit(name).alias("a"), m.alias("m"))


def consolidate_first(
    df: DataFrame, keys: list[str], newest: list[str], arrays: list[str]
) -> DataFrame:
    """One row per key: scalars of the newest row (the greatest other columns break ties)
    and the sorted distinct union of the array columns.

    A count over the keys alone finds those with several rows; rows that a filter of these keys (of
    fixed size, broadcast) rules out only have their own arrays tidied, without a shuffle. The others,
    all rows of repeated keys and a few more, are written: their newest row comes from a group limit
    and each array's members are made distinct with map-side combining before they are gathered, so a
    hot key brings neither its rows nor its copies to one task. Null keys count like any other. The
    rows are read three times: hand over a table.
    """
    others = [c for c in df.columns if c not in keys and c not in newest and c not in arrays]
    several, alone = split(df, stored(duplicate_keys(df, keys), "repeated_keys"), keys)
    several = stored(several, "repeated_rows")
    tidy = {
        a: F.coalesce(
            F.when(F.size(a) > 1, F.array_sort(F.array_distinct(a))).otherwise(F.col(a)), F.array().cast(df.schema[a].dataType)
        )
        for a in arrays
    }
    alone = alone.withColumns(tidy)
    order = [F.col(c).desc_nulls_last() for c in [*newest, *others]]
    out = first_per_key(several.drop(*arrays), keys, order)
    for a in arrays:
        members = several.select(*keys, F.explode(a).alias("_m")).distinct()
        found = members.groupBy(*[F.col(k).alias("_h_" + k) for k in keys]).agg(F.array_sort(F.collect_list("_m")).alias(a))
        out = out.join(found, _same(out, found, keys), "left").select(*out.columns, F.coalesce(a, F.array().cast(df.schema[a].dataType)).alias(a))
    columns = [*keys, *newest, *others, *arrays]
    return alone.select(*columns).unionByName(out.select(*columns))
