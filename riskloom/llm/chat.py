"""Chat formatting: logged snapshots of a conversation are collapsed to the longest, then rendered.

A chat log often stores a conversation again after each turn. Each turn gets a hash of its position,
role and text; the rolling XOR of these gives every prefix a 128-bit key. A conversation whose whole
key occurs as a proper prefix key of any other is a snapshot and goes (anti join); equal
conversations keep the smallest id. Only built-in expressions are used.

One conversation may hold a large part of all rows: sorted ranges of turns are numbered each by
itself and sums over the ranges give the positions; hashes, rolling keys and rendering go in blocks of
`BLOCK` positions, with sums over the blocks in between. So no task gets a whole conversation, however
its turns are numbered. One prefix may be very common: prefix keys are made distinct with map-side
combining before the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.llm.common import stored, table, text_of

#: Positions in a block; characters of a text that ranges are cut by.
BLOCK, CUT = 256, 64
#: Rendering of one turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def positions(clean: DataFrame) -> DataFrame:
    """Distinct turns (conv_id, turn, role, text) with position and the conversation's length.

    Rows are sorted in ranges, which are written with a running number. A conversation that lies in
    several ranges goes on with the sum of what the earlier ones hold of it. Turns that agree up to the
    first CUT characters of their texts are sorted in one task; nothing gathers them.
    """
    cut = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role")]
    ranged = clean.repartitionByRange(*cut, F.substring("text", 1, CUT)).sortWithinPartitions(*cut, "text")
    ranged = stored(ranged.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")), "ranges")
    sizes = ranged.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    whole = Window.partitionBy("conv_id")
    before = sizes.select(
        "conv_id", "range", (F.sum("size").over(whole.orderBy("range")) - F.col("size") - F.col("first")).alias("shift"),
        F.sum("size").over(whole).alias("length"),
    )
    return ranged.join(stored(before, "range_sizes"), ["conv_id", "range"]).select(
        "conv_id", (F.col("at") + F.col("shift") + 1).alias("position"), "length", "role", "text"
    )


def turns(rows: DataFrame) -> DataFrame:
    """Turns with position (from 1), the conversation's length and the rolling prefix keys a, b.

    `rows`: conv_id, turn, role, text. Order is by turn (null first), then role and text; rows that
    repeat in all four are one turn. Null roles count as "unknown", null texts as empty. Rows without
    a conv_id are dropped: they belong to no conversation.
    """
    clean = rows.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), text_of().alias("text"),
    ).distinct()
    numbered = positions(clean).withColumn("block", F.floor((F.col("position") - 1) / BLOCK))
    block = ["conv_id", "block"]
    part = lambda seed: F.xxhash64(F.lit(seed), "position", "role", "text")
    numbered = stored(numbered.select("*", part(1).alias("x"), part(2).alias("y")), "turns")
    whole = Window.partitionBy("conv_id").orderBy("block")
    inside = Window.partitionBy(*block).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    earlier = whole.rowsBetween(Window.unboundedPreceding, -1)
    keys = numbered.groupBy(*block).agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).select(
        *block, *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0).cast("long")).alias(f"{c}_before") for c in "xy"]
    )
    rolled = numbered.select("conv_id", "block", "position", "length", "role", "text",
                             F.bit_xor("x").over(inside).alias("x_in"), F.bit_xor("y").over(inside).alias("y_in"))
    return rolled.join(stored(keys, "prefix_blocks"), block).select(
        "conv_id", "block", "position", "length", "role", "text",
        F.col("x_in").bitwiseXOR(F.col("x_before")).alias("a"), F.col("y_in").bitwiseXOR(F.col("y_before")).alias("b"),
    )


def maximal(rolled: DataFrame) -> DataFrame:
    """conv_id, length and n_equal of the conversations that no other one continues; the smallest id
    of equal ones."""
    keys = rolled.select("conv_id", "position", "length", "a", "b")
    whole = keys.where("position = length").groupBy("position", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal")
    )
    prefixes = keys.where("position < length").groupBy("position", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    left = whole.join(prefixes, ["position", "a", "b"], "left_anti")
    return left.select("conv_id", F.col("position").alias("length"), "n_equal")


def rendered(role: Column, text: Column) -> Column:
    """One turn as text. Markers inside a text are broken up, so that it can't open or close a turn."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(OPEN), safe(role), F.lit("\n"), safe(text), F.lit(f"{CLOSE}\n"))


def format_chats(rows: DataFrame) -> DataFrame:
    """Maximal conversations as text: conv_id, part, n_turns, length, n_equal, rendered.

    A conversation comes in parts of `BLOCK` turns by position (most have one part, number 0); the parts
    in order are the whole, so a long one never has to lie in one row. Nulls, order and repeated rows: see `turns`. An empty table
    gives an empty result; other columns are ignored.
    """
    rolled = stored(turns(rows), "rolled")
    keep = stored(maximal(rolled), "maximal").select("conv_id", "n_equal")
    pieces = rolled.join(keep, "conv_id").groupBy("conv_id", "block", "length", "n_equal").agg(
        F.array_sort(F.collect_list(F.struct("position", rendered(F.col("role"), F.col("text")).alias("t")))).alias("all")
    )
    return pieces.select(
        "conv_id", F.col("block").cast("int").alias("part"), F.size("all").alias("n_turns"), "length", "n_equal",
        F.array_join(F.transform("all", lambda s: s["t"]), "").alias("rendered"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


CHECK = f"""
WITH clean AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS position FROM clean
), whole AS (
  SELECT conv_id, count(*) AS length, list({{'r': role, 't': text}} ORDER BY position) AS said FROM numbered GROUP BY conv_id
), kept AS (
  SELECT min(conv_id) AS conv_id, count(*) AS n_equal, length, said FROM whole w
  WHERE NOT EXISTS (SELECT 1 FROM whole o WHERE o.length > w.length AND o.said[1] = w.said[1] AND o.said[1:w.length] = w.said)
  GROUP BY length, said
), blocks AS (
  SELECT n.*, CAST(floor((position - 1) / {BLOCK}) AS INTEGER) AS part, k.n_equal, k.length FROM numbered n JOIN kept k USING (conv_id)
)
SELECT conv_id, part,
  CAST(count(*) AS INTEGER) AS n_turns, length, n_equal,
  string_agg('{OPEN}' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '{CLOSE}' || chr(10), '' ORDER BY position) AS rendered
FROM blocks GROUP BY conv_id, part, length, n_equal
"""
