"""Type-2 history, type-1 merges and watermark sync.

Plain files have no row-level MERGE, so each merge returns the new table. Only the current
rows (one per key) take part in a join; closed history rows pass through, or are not read
at all when the table is stored in two parts (see `plans.store`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import fixed
from riskloom.operators.joins import fits, newer_than, upsert, warehouse_columns
from riskloom.operators.keyfilter import may_match, split
from riskloom.operators.keys import latest_per_key

NEWER = (
    "s.lastModified IS NOT NULL AND (t.lastModified IS NULL OR t.lastModified < s.lastModified)"
)
HASH_DIFFERS = "s.row_hash <> t.row_hash"


def _on(keys: list[str]) -> Column:
    return F.expr(" AND ".join(f"t.{k} = s.{k}" for k in keys))


def scd2_changes(
    current: DataFrame,
    source: DataFrame,
    keys: list[str],
    start: Column,
    changed: str = NEWER,
    names: tuple[str, str, str] = ("validFrom", "validTo", "currentFlag"),
    keys_of: DataFrame | None = None,
    kept: bool = True,
) -> DataFrame:
    """New versions of the current rows: kept, expired and inserted ones, in one join.

    `current` and `source` have one row per key; `start` is the validity start of inserted
    rows (and end of expired ones), `changed` a condition over `t` and `s`. Current rows whose keys don't
    occur in the source pass a key filter unjoined. The filter is made from `keys_of` (default: `source`,
    which is then read twice), any table with the keys of `source`. Without `kept` only expired and inserted
    rows are made, and the current rows are read once.
    """
    valid_from, valid_to, flag = names
    known = source if keys_of is None else keys_of
    near, rest = split(current, known, keys) if kept else (may_match(current, known, keys), None)
    data = [c for c in current.columns if c not in names]
    begin = source.withColumn("_start", start)
    pairs = (
        near.withColumn("_t", F.lit(True)).alias("t")
        .join(begin.withColumn("_s", F.lit(True)).alias("s"), _on(keys), "full_outer" if kept else "right_outer")
        .withColumn("_changed", F.expr(f"coalesce(t._t AND s._s AND ({changed}), false)"))
    )

    # Which rows a pair gives is a list of flags, and fields are chosen by flag: no wide rows are built to be filtered.
    old, new = "t._t" if kept else "_changed", "s._s AND (t._t IS NULL OR _changed)"
    sides = f"CASE WHEN {old} AND {new} THEN array(true, false) WHEN {old} THEN array(true) WHEN {new} THEN array(false) END"
    fields = {c: f"IF(_old, t.`{c}`, s.`{c}`)" for c in data} | {
        valid_from: f"IF(_old, t.{valid_from}, s._start)",
        valid_to: f"IF(_old, IF(_changed, s._start, t.{valid_to}), CAST(NULL AS {_type(current, valid_to)}))",
        flag: f"IF(_old, IF(_changed, false, t.{flag}), true)",
    }
    made = pairs.withColumn("_old", F.expr(f"explode({sides})")).selectExpr(*[f"{fields[c]} AS `{c}`" for c in current.columns])
    return made.unionByName(rest) if kept else made


def _type(df: DataFrame, name: str) -> str:
    return dict(df.dtypes)[name]


def split_current(target: DataFrame, flag: str = "currentFlag") -> tuple[DataFrame, DataFrame]:
    """(current rows, closed rows)."""
    return target.where(F.col(flag)), target.where(~F.coalesce(F.col(flag), F.lit(False)))


def read_current(master: DataFrame, published: str = "datePublished") -> DataFrame:
    """Current rows with their year and date."""
    return master.where("currentFlag").withColumns(
        {"year_published": F.year(published), "date_published": F.to_date(published)}
    )


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    run_ts: Column,
    newest: str = "lastModified",
) -> DataFrame:
    """History table after a run: a newer `lastModified` closes the current row."""
    current, closed = split_current(target)
    unique = latest_per_key(source, keys, [newest])
    return scd2_changes(current, unique, keys, run_ts, keys_of=source).unionByName(closed)


def scd2_merge_by_hash(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    start: Column,
    newest: str = "ingestionTimestamp",
    names: tuple[str, str, str] = ("valid_from", "valid_to", "is_current"),
) -> DataFrame:
    """Same, where a row counts as changed when its hash differs."""
    current, closed = split_current(target, names[2])
    unique = latest_per_key(source, keys, [newest])
    return scd2_changes(current, unique, keys, start, HASH_DIFFERS, names, source).unionByName(closed)


def merge_changed(
    target: DataFrame, source: DataFrame, keys: list[str], compare: list[str], newest: list[str]
) -> DataFrame:
    """Type-1 merge: take the source row when it is new or differs in `compare`.

    Target rows whose keys don't occur in the source are told apart by a key filter and pass where they
    are read; only the others are joined. The source is read twice: hand over a table.
    """
    unique = latest_per_key(source, keys, newest)
    near, rest = split(target, source, keys)
    differs = " OR ".join(f"s.{c} <> t.{c}" for c in compare)
    take = f"s._s AND (t._t IS NULL OR coalesce({differs}, false))"
    pairs = near.withColumn("_t", F.lit(True)).alias("t").join(
        unique.withColumn("_s", F.lit(True)).alias("s"), _on(keys), "full_outer"
    )
    merged = pairs.selectExpr(*[f"IF({take}, s.`{c}`, t.`{c}`) AS `{c}`" for c in target.columns])
    return merged.unionByName(rest)


def sync_full(master: DataFrame, keys: list[str] = fixed.RECORD_KEY) -> DataFrame:
    """Current rows in warehouse types: the full-load path. Rows whose keys don't fit are left to
    `sync_rejects`."""
    return warehouse_columns(master.where("currentFlag").where(fits(keys)))


def sync_rejects(master: DataFrame, keys: list[str] = fixed.RECORD_KEY) -> DataFrame:
    """Current rows that the warehouse can't hold, because a key is longer than its column."""
    return master.where("currentFlag").where(~fits(keys))


def sync_incremental(
    current: DataFrame, master: DataFrame, watermark: DataFrame, keys: list[str] = fixed.RECORD_KEY
) -> DataFrame:
    """Warehouse table after upserting the newest master row of each key above the watermark.

    Rows are told apart by their whole keys; only columns that aren't keys are cut. Rows whose keys
    don't fit are left to `sync_rejects`, as in the full load.
    """
    fresh = newer_than(master, "validFrom", watermark, "last_run_ts")
    changes = warehouse_columns(latest_per_key(fresh.where(fits(keys)), keys, ["validFrom"]))
    return upsert(current, changes.select(*current.columns), keys)


def next_watermark(table: DataFrame, now: Column | None = None) -> DataFrame:
    """One-row watermark: the greatest validFrom, `now` (else the epoch) for an empty table."""
    start = F.lit(fixed.EPOCH).cast("timestamp") if now is None else now
    return table.agg(F.coalesce(F.max("validFrom"), start).alias("last_run_ts"))


def refresh_lookup(lookup: DataFrame, updates: DataFrame, keys: list[str] = fixed.RECORD_KEY) -> DataFrame:
    """Delete the matching keys and insert the updated rows (lookup columns only)."""
    return upsert(lookup, updates.select(*lookup.columns), keys)
