"""Mixing sources to target weights by weighted fair queueing. DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stage, text_of

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
ROWS_PER_BUCKET = 50_000
# Equal rows listed at once.
RUN_PART = 10_000
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Targets of ``source, source_size`` rows, one per source.

    Sources in order, null last, take ``weights`` in turn and share the sum of all sizes. A
    target stops at ``max_epochs`` times its source's size and what is over goes to the others by
    weight. With sources ordered by (limit / weight) those that stop are the first ones: the level
    that the rest share is fixed by the first source whose limit is above its share.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ranked) - 1) % len(weights) + 1
    limit = F.col("source_size") * max_epochs
    listed = sources.select(
        "source",
        "source_size",
        F.row_number().over(ranked).alias("source_rank"),
        F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int")).cast("long").alias("weight"),
        limit.alias("size_limit"),
    )
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("size_limit") / F.col("weight"), "source_rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    filled = listed.select(
        "*",
        F.row_number().over(filling).alias("place"),
        (
            F.sum("source_size").over(everything)
            - F.coalesce(F.sum("size_limit").over(before), F.lit(0))
        ).alias("rest_size"),
        (
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
        ).alias("rest_weight"),
    )
    share = F.col("rest_size").cast("double") * F.col("weight") / F.col("rest_weight")
    free = F.when(F.col("size_limit") > share, F.col("place"))
    return (
        filled.withColumn("first_free", F.min(free).over(everything))
        .withColumn(
            "level_size",
            F.min(F.when(F.col("place") == F.col("first_free"), F.col("rest_size"))).over(everything),
        )
        .withColumn(
            "level_weight",
            F.min(F.when(F.col("place") == F.col("first_free"), F.col("rest_weight"))).over(everything),
        )
        .select(
            "source",
            "source_size",
            "source_rank",
            F.when(
                F.col("place") >= F.col("first_free"),
                F.col("level_size").cast("double") * F.col("weight") / F.col("level_weight"),
            )
            .otherwise(F.col("size_limit").cast("double"))
            .alias("target"),
        )
    )


def _queue(docs: DataFrame, weights: Sequence[int], max_epochs: int, seed: str, rows_per_bucket: int) -> DataFrame:
    """``doc_id, text_hash, size, source_size, source_rank, target, key, words_to`` per row: ``words_to`` are
    the words of its source up to its end, in the shuffled order.

    Rows alike in id, source and text are one run until their words are placed, so that a run of any
    length is one row where buckets are put in order.
    """
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = stage(
        docs.select(
            "doc_id",
            "source",
            F.xxhash64(text_of()).alias("text_hash"),
            word_count().alias("size"),
            F.md5(F.concat_ws(":", F.lit(seed), named, F.md5(text_of()))).alias("key"),
        )
        .groupBy("doc_id", "source", "text_hash", "size", "key")
        .agg(F.count(F.lit(1)).alias("rows")),
        "sizes",
    )
    buckets = max(1, -(-runs.count() // rows_per_bucket))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    runs = runs.withColumn("bucket", F.shiftright(place * buckets, 32).cast("int"))
    # A null source needs a key to join on.
    runs = runs.withColumn("name", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))

    sums = stage(
        runs.groupBy("name", "source", "bucket").agg(F.sum(F.col("size") * F.col("rows")).alias("bucket_size")), "sums"
    )
    targets = source_targets(
        sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_epochs
    ).withColumn("name", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    earlier = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        sums.join(targets.drop("source"), "name").select(
            "name",
            "bucket",
            "source_size",
            "source_rank",
            "target",
            F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start"),
        ),
        "starts",
    )
    inside = Window.partitionBy("name", "bucket").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.col("bucket_start") + F.coalesce(F.sum(F.col("size") * F.col("rows")).over(inside), F.lit(0))
    placed = runs.join(starts, ["name", "bucket"]).select("*", before.alias("words_before"))
    # Long runs are spread in parts, so that no row holds a long list.
    firsts = F.sequence(F.lit(1).cast("long"), "rows", F.lit(RUN_PART).cast("long"))
    parts = placed.withColumn("first", F.explode(firsts))
    each = parts.withColumn("nth", F.explode(F.sequence("first", F.least(F.col("rows"), F.col("first") + RUN_PART - 1))))
    return stage(
        each.select(
            "doc_id", "text_hash", "size", "source_size", "source_rank", "target", "key",
            (F.col("words_before") + F.col("nth") * F.col("size")).alias("words_to"),
        ),
        "queued",
    )


def _ordered(queued: DataFrame, max_epochs: int) -> DataFrame:
    """The copies that the mix takes: a row of ``queued`` with ``finish`` and ``position``, the words before it.

    Copies are sorted by ranges of finish time: range sums give each range its first position, and ranges
    are put in order one by one. With n rows there are about sqrt(n) ranges to one unit of time, so
    neither the ranges nor the rows of one outgrow a task. What ends behind the sum of all sizes goes.
    """
    n = max(1, math.isqrt(queued.count()))
    ranges = F.least(F.floor(F.col("finish") * n), F.lit(64 * n)).cast("long")
    copies = F.array(*[_finish(e) for e in range(max_epochs)])
    queue = stage(queued.filter("size > 0").select("*", F.explode(copies).alias("finish")).withColumn("range", ranges), "copies")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = queue.groupBy("range").agg(F.sum("size").alias("range_size")).select(
        "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("range_start")
    )
    budget = queued.agg(F.sum("size")).first()[0] or 0
    inside = Window.partitionBy("range").orderBy("finish", "source_rank", "key").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.col("range_start") + F.sum("size").over(inside)
    return (
        queue.join(stage(starts, "ranges"), "range")
        .withColumn("position", ends - F.col("size"))
        .filter(F.col("position") + F.col("size") <= budget)
    )


def mixed_order(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``doc_id, text_hash, finish, position`` of every copy that :func:`mix` takes of a row of
    ``doc_id, source, text``; positions rise in the order of the mix, in words from 0."""
    queued = _queue(docs, weights, max_epochs, seed, rows_per_bucket)
    return _ordered(queued, max_epochs).select("doc_id", "text_hash", "finish", "position")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """How much of each row of ``doc_id, source, text`` the mix takes.

    Returns ``doc_id, text_hash, size, source_size, target, taken, copies, position`` per row; sizes are in
    words, ``taken`` is ``copies * size`` and ``position`` the words before the first copy in the mix (null
    if there is none). Each source's documents, shuffled by a seeded hash of id and text, are queued
    once per epoch. A copy finishes at virtual time (words of its source up to its end) / target.
    All copies are range-sorted by finish time, source and hash, and taken until one does not fit the
    sum of all sizes.

    The shuffled order runs over buckets of a source, each with about ``rows_per_bucket`` different
    rows, so that no source is summed in one task. Null text has size 0; null is a source of its own,
    the last one; rows that repeat id and text lie next to each other; a null id is shuffled as an
    empty one. An empty table gives no rows; further columns are ignored.
    """
    queued = _queue(docs, weights, max_epochs, seed, rows_per_bucket)
    found = (
        _ordered(queued, max_epochs)
        .groupBy("source_rank", "words_to")
        .agg(F.count(F.lit(1)).cast("int").alias("copies"), F.min("position").alias("position"))
        .select(F.col("source_rank").alias("found_rank"), F.col("words_to").alias("found_to"), "copies", "position")
    )
    # Rows of some size differ in their words up to the end, within a source.
    same = (F.col("size") > 0) & (F.col("source_rank") == F.col("found_rank")) & (F.col("words_to") == F.col("found_to"))
    copies = F.coalesce("copies", F.lit(0))
    return queued.join(stage(found, "taken").hint("merge"), same, "left").select(
        "doc_id",
        "text_hash",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).cast("long").alias("taken"),
        copies.alias("copies"),
        "position",
    )


def _finish(epoch: int) -> Column:
    """Virtual finish time of a document's copy in an epoch, counted from 0."""
    words = F.col("source_size") * epoch + F.col("words_to")
    return F.when(F.col("target") > 0, words.cast("double") / F.col("target")).otherwise(
        F.lit(float("inf"))
    )
