"""Fixed-size key filters: rows of a big table that can't have a match are known before any shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Words of 64 bits in a filter: 2^20 broadcast rows at most, about one in ten strange keys passes at 7 million keys.
WORDS = 1 << 20


def _slot(keys: list[Column], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words * 64))


def key_filter(keys_of: DataFrame, keys: list[str], types: dict[str, str], words: int = WORDS) -> DataFrame:
    """One bit per hashed key, as rows (_word, _bits): never more than `words` rows, however many keys.
    `types` are those of the table to be filtered, as hashes differ by type."""
    slot = _slot([F.col(k).cast(types[k]) for k in keys], words)
    return keys_of.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_slot & 63 AS INT))) AS _bits"))


def marked(df: DataFrame, keys_of: DataFrame, keys: list[str], name: str = "_may", words: int = WORDS) -> DataFrame:
    """Rows with a flag: false says that no row of `keys_of` has the keys (exact), true that one may.

    The filter is broadcast, its size is bounded by `words`. With more keys than it has bits all
    rows may match: that costs work, not rows. Null keys are hashed like any other value. Keys are of
    integer, text, date or boolean types (equal floating numbers may differ in their bits).
    """
    bits = F.broadcast(key_filter(keys_of, keys, dict(df.dtypes), words))
    slotted = df.withColumn("_slot", _slot([F.col(k) for k in keys], words))
    hit = F.expr("coalesce(shiftright(_bits, CAST(_slot & 63 AS INT)) & 1 = 1, false)")
    return slotted.join(bits, F.shiftright(slotted["_slot"], 6) == bits["_word"], "left").select(*df.columns, hit.alias(name))


def may_match(df: DataFrame, keys_of: DataFrame, keys: list[str], words: int = WORDS) -> DataFrame:
    """Rows whose keys may occur in `keys_of`; every row whose keys do is among them."""
    return marked(df, keys_of, keys, "_may", words).where("_may").drop("_may")


def split(df: DataFrame, keys_of: DataFrame, keys: list[str], words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys may occur in `keys_of`, rows whose keys don't); the table is read by each."""
    rows = marked(df, keys_of, keys, "_may", words)
    return rows.where("_may").drop("_may"), rows.where("NOT _may").drop("_may")
