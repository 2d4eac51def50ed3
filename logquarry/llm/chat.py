"""Chat formatting: logged snapshots of growing conversations, collapsed and rendered.

Every turn of a conversation carries two rolling hashes of all turns up to it. A conversation whose
last hashes are some longer conversation's hashes at the same turn is its prefix; anti-joins keep
the conversations that nothing continues, and one of those that are equal. These are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stage

BLOCK_TURNS = 1_024


def _turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "place", "role", "text", F.col("role").isNull(), F.col("text").isNull()).cast(
        "decimal(38,0)"
    )


def prefix_hashes(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id, place, role, text, a, b``: each turn's place from 1, and the hashes of its prefix.

    A prefix hash is the sum of its turns' hashes, in which their places take part; two such sums tell
    prefixes apart. Places and sums are made in blocks of turns and carried from block to block, so
    that a very long conversation is no one task's work. Turns go by number, null first, then role and text.
    """
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        F.floor(F.col("turn") / block_turns).cast("long").alias("block"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("k"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
    )
    same = lambda left, right: (left["conv_id"].eqNullSafe(right["c"])) & (left["block"].eqNullSafe(right["k"]))
    ranked = rows.withColumn("at", F.row_number().over(inside))
    placed = stage(
        ranked.join(starts, same(ranked, starts))
        .select("conv_id", "block", "role", "text", (F.col("start") + F.col("at")).alias("place"))
        .withColumn("ha", _turn_hash(1))
        .withColumn("hb", _turn_hash(2)),
        "turns",
    )
    up_to = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.groupBy("conv_id", "block").agg(F.sum("ha").alias("ha"), F.sum("hb").alias("hb"))
    before = sums.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("k"),
        F.coalesce(F.sum("ha").over(earlier), F.lit(0)).alias("sa"),
        F.coalesce(F.sum("hb").over(earlier), F.lit(0)).alias("sb"),
    )
    return placed.join(before, same(placed, before)).select(
        "conv_id",
        "place",
        "role",
        "text",
        (F.col("sa") + F.sum("ha").over(up_to)).cast("decimal(38,0)").alias("a"),
        (F.col("sb") + F.sum("hb").over(up_to)).cast("decimal(38,0)").alias("b"),
    )


def collapse(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns`` of the conversations that no other one continues.

    Of equal conversations the one with the least id stays.
    """
    hashed = stage(prefix_hashes(turns).select("conv_id", "place", "a", "b"), "prefixes")
    lengths = hashed.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    ends = lengths.join(
        hashed.withColumnRenamed("conv_id", "c"),
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("place") == F.col("n_turns")),
    ).select("conv_id", "n_turns", "a", "b")
    # Equal conversations first meet in their task, so a group of copies is no hot key; null ids last.
    ends = stage(
        ends.groupBy("n_turns", "a", "b").agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("snapshots")
        ),
        "ends",
    )
    continued = stage(
        hashed.join(lengths.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
        .filter(F.col("place") < F.col("n_turns"))
        .select(F.col("place").alias("n_turns"), "a", "b")
        .distinct(),
        "continued",
    )
    return ends.join(continued, ["n_turns", "a", "b"], "left_anti").select("conv_id", "n_turns", "snapshots")


def rendered(role: Column, text: Column) -> Column:
    """One turn in chat markup; a null role is ``unknown``, a null text empty."""
    return F.concat(
        F.lit("<|im_start|>"),
        F.coalesce(role, F.lit("unknown")),
        F.lit("\n"),
        F.coalesce(text, F.lit("")),
        F.lit("<|im_end|>\n"),
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, snapshots, chat`` of every maximal conversation of ``conv_id, turn, role, text``.

    ``snapshots`` counts the conversations equal to it. Turns go by number, null first, then by role
    and text; repeated rows are turns of their own. Rows with a null id are one conversation. An
    empty table gives no rows; further columns are ignored.
    """
    kept = stage(collapse(turns).withColumnRenamed("conv_id", "kept_id"), "maximal")
    mine = turns.select("conv_id", "turn", "role", "text").join(
        kept, F.col("conv_id").eqNullSafe(F.col("kept_id"))
    )
    return (
        mine.groupBy("kept_id", "n_turns", "snapshots")
        .agg(
            F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(1 << 63))).alias("turn"), "role", "text"))).alias("turns")
        )
        .select(
            F.col("kept_id").alias("conv_id"),
            "n_turns",
            "snapshots",
            F.array_join(F.transform("turns", lambda t: rendered(t["role"], t["text"])), "").alias("chat"),
        )
    )
