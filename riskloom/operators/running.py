"""Running sums and numbering that never put one whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _keys_match(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right["_o_" + k])
    return cond


def prefix_sum(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    name: str,
    bucket: Column | None = None,
    total: str | None = None,
) -> DataFrame:
    """Running sum of `value` per key in `order`, current row included; `total` names an
    optional column with the sum over the whole key.

    Without `bucket` one window per key does it; right when a key has few rows by its
    nature (one per calendar day). With `bucket`, a value that rises with `order`, the
    window runs inside (key, bucket) and the totals of earlier buckets are added: a key
    of any size spreads over its buckets. The input is then read twice, so hand over a
    written or checkpointed table when it is costly to compute.
    """
    rows = Window.unboundedPreceding, Window.currentRow
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*rows)
        out = df.withColumn(name, F.sum(value).over(w))
        return out.withColumn(total, F.sum(value).over(Window.partitionBy(*keys))) if total else out
    marked = df.withColumn("_bucket", bucket).withColumn("_value", value)
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(*rows)
    totals = marked.groupBy(*keys, "_bucket").agg(F.sum("_value").alias("_total"))
    outer = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias("_o_" + k) for k in keys],
        F.col("_bucket").alias("_o__bucket"),
        F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_offset"),
        F.sum("_total").over(Window.partitionBy(*keys)).alias("_all"),
    )
    return (
        marked.join(offsets, _keys_match(marked, offsets, [*keys, "_bucket"]), "left")
        .withColumn(name, F.sum("_value").over(inner) + F.coalesce(F.col("_offset"), F.lit(0)))
        .select(*df.columns, name, *([F.col("_all").alias(total)] if total else []))
    )


def running_total(
    df: DataFrame,
    keys: list[str],
    date: str,
    value: str = "exposure_index",
    name: str = "cumulative_exposure_index",
) -> DataFrame:
    """All-time cumulative measure by date (two decimals).

    Rows are one per key and date. A vendor's or product's window is bounded by the
    calendar; the total without keys runs by year, so there is no single-task window.
    """
    exact = F.col(value).cast("decimal(28,2)")
    by_year = F.year(date) if not keys else None
    out = prefix_sum(df, keys, [date], exact, name, by_year)
    return out.withColumn(name, F.round(F.col(name), 2).cast("double"))


def batch_rows(
    df: DataFrame, order: list[str], size: int, name: str = "batch", per_bucket: int = 1 << 16
) -> DataFrame:
    """Number rows into consecutive batches of exactly `size` (the last may be short).

    Numbering runs per hash bucket of the (unique) order columns and adds the counts of earlier
    buckets. The number of buckets follows from the number of rows, about `per_bucket` in each.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in order])
    buckets = df.select(F.greatest(F.lit(1), F.ceil(F.count("*") / per_bucket)).cast("bigint")).scalar()
    numbered = prefix_sum(df, [], order, F.lit(1).cast("bigint"), "_n", F.pmod(F.xxhash64(text), buckets))
    return numbered.withColumn(name, F.floor((F.col("_n") - 1) / size).cast("bigint")).drop("_n")


def closing_totals(df: DataFrame, keys: list[str], date: str, value: str = "exposure_index") -> DataFrame:
    """keys, year, closing: each key's exact cumulative measure at the end of every year that has rows, to be
    stored beside the running totals; one row per key and year."""
    year = F.year(date).alias("year")
    sums = df.groupBy(*keys, year).agg(F.sum(F.col(value).cast("decimal(28,2)")).alias("_sum"))
    order = Window.partitionBy(*keys).orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sums.withColumn("closing", F.sum("_sum").over(order).cast("decimal(38,2)")).drop("_sum")


def _start(closing: DataFrame, keys: list[str], first_year: int) -> DataFrame:
    """Each key's closing total before a year, under other names; without keys one row."""
    earlier = closing.where(F.col("year").isNull() | (F.col("year") < first_year))
    start = earlier.groupBy(*keys).agg(F.max_by("closing", F.coalesce("year", F.lit(-(2**31) + 1))).alias("_offset"))
    return start.select(*[F.col(k).alias("_o_" + k) for k in keys], "_offset")


def carried_closing(
    open_rows: DataFrame, closing: DataFrame, keys: list[str], date: str, first_year: int, value: str = "exposure_index"
) -> DataFrame:
    """`closing_totals` of the years from `first_year` on, from the rows of these years and the stored closing
    totals of the years before."""
    own, start = closing_totals(open_rows, keys, date, value), _start(closing, keys, first_year)
    whole = own.join(start, _keys_match(own, start, keys), "left") if keys else own.crossJoin(F.broadcast(start))
    carried = F.col("closing") + F.coalesce(F.col("_offset"), F.lit(0).cast("decimal(28,2)"))
    return whole.withColumn("closing", carried.cast("decimal(38,2)")).select(*own.columns)


def carried_total(
    open_rows: DataFrame,
    closing: DataFrame,
    keys: list[str],
    date: str,
    first_year: int,
    value: str = "exposure_index",
    name: str = "cumulative_exposure_index",
) -> DataFrame:
    """`running_total` of the years from `first_year` on, carried on from the stored closing totals of the years
    before; rows of closed years are neither needed nor read. A key without earlier rows starts at 0, years
    without a date count as before all others."""
    start = _start(closing, keys, first_year)
    exact = F.col(value).cast("decimal(28,2)")
    total = prefix_sum(open_rows, keys, [date], exact, name, F.year(date) if not keys else None)
    whole = total.join(start, _keys_match(total, start, keys), "left") if keys else total.crossJoin(F.broadcast(start))
    carried = F.col(name) + F.coalesce(F.col("_offset"), F.lit(0).cast("decimal(28,2)"))
    return whole.withColumn(name, F.round(carried, 2).cast("double")).select(*open_rows.columns, name)
