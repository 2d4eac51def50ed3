"""Two-pass external shuffle into shards. DataFrame operations only."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stage

SHARDS = 40
# Held several times over in a task: as rows collected, sorted and shuffled.
BUCKET_BYTES = 16 << 20
BUCKETS_PER_TASK = 8
# Up to this many buckets each has a task of its own.
SINGLE_BUCKETS = 20_000
# More equal rows than this are dealt one by one, and listed so many at once.
EQUAL_ROWS = 1_000
LISTED_AT_ONCE = 10_000
# What a row takes in memory besides its ``size``.
ROW_BYTES = 64
# So many rows of (bucket, offset), about 24 MB, are broadcast; beyond it Spark picks the join.
BROADCAST_BUCKETS = 1_000_000
SEED = 7


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard, from 0, whose hash with ``key`` is highest.

    Only ``key`` and the number of shards decide, and one more shard takes keys only into itself.
    """
    tries = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.struct(F.xxhash64(key, s, F.lit(seed)).alias("h"), s.alias("s")),
    )
    return F.array_max(tries)["s"]


def bucket_counts(weights: DataFrame, shards: int, bucket_bytes: int) -> list[int]:
    """How many buckets each shard has, from the ``weight`` of its own rows; the driver sees a number a shard."""
    summed = {r["shard"]: r["weight"] for r in weights.groupBy("shard").agg(F.sum("weight").alias("weight")).collect()}
    return [max(1, math.ceil(summed.get(i, 0) / bucket_bytes)) for i in range(shards)]


def _weights(scattered: DataFrame, size: str) -> DataFrame:
    """``shard, mixed, rows, weight`` of the rows alike: a row of 32 bytes for each hash."""
    weight = F.sum(F.coalesce(F.col(size), F.lit(0)).cast("double") + ROW_BYTES)
    return stage(scattered.groupBy("shard", "mixed").agg(F.count(F.lit(1)).alias("rows"), weight.alias("weight")), "row-weights")


def _spread(scattered: DataFrame, weights: DataFrame) -> DataFrame:
    """``scattered`` with a number beside its hash: 0, but for rows that have very many equals.

    Those are alike, so it does not matter which of them gets which number: they are counted before they are
    shuffled, and listed again with a number each.
    """
    hot = stage(weights.filter(F.col("rows") > EQUAL_ROWS).select(F.col("mixed").alias("hot")).distinct(), "equal-rows")
    count = hot.count()
    if not count:
        return scattered.withColumn("nth", F.lit(0).cast("long"))
    listed = F.broadcast(hot) if count <= BROADCAST_BUCKETS else hot
    marked = scattered.join(listed, F.col("mixed") == F.col("hot"), "left")
    single = marked.filter("hot is null").select("shard", "mixed", "record", F.lit(0).cast("long").alias("nth"))
    runs = marked.filter("hot is not null").groupBy("shard", "mixed", "record").agg(F.count(F.lit(1)).alias("rows"))
    firsts = F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(LISTED_AT_ONCE).cast("long"))
    parts = runs.withColumn("first", F.explode(firsts))
    last = F.least(F.col("rows") - 1, F.col("first") + LISTED_AT_ONCE - 1)
    return single.unionByName(parts.select("shard", "mixed", "record", F.explode(F.sequence("first", last)).alias("nth")))


def shuffled_shards(
    rows: DataFrame,
    key: str = "doc_id",
    size: str = "size",
    shards: int = SHARDS,
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = SEED,
) -> DataFrame:
    """``rows`` with ``shard`` (from ``key``), and ``slot``, their place in it, gapless from 0.

    Pass one scatters the rows of a shard over buckets by a seeded hash of the whole row, and of a number
    for each of very many equal rows; a shard has as many buckets as keep each near ``bucket_bytes`` of the
    ``size`` column and ``ROW_BYTES`` a row, so that a key with very many rows has more buckets and not
    larger ones. Pass two holds one bucket at a time and shuffles it (Spark's ``shuffle`` is a Fisher-Yates
    shuffle), after sorting it by that hash, so that the order does not depend on how rows arrived. Tasks
    are told by the data alone, so that no setting of Spark changes a slot, and follow the slots.

    Rows with a null key share one shard; a null size counts as 0. All columns are kept, of any
    name but ``shard`` and ``slot``, which are replaced. Equal rows are rows each. An empty table gives no rows.
    """
    rows = rows.drop("shard", "slot")
    record = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rows.columns)])
    mixed = F.xxhash64(F.to_json(record), F.lit(seed)) if _has_map(rows) else F.xxhash64(record, F.lit(seed))
    hashed = rows.select(shard_of(F.col(key), shards, seed).alias("shard"), mixed.alias("mixed"), record.alias("record"), F.col(size).alias("row_size"))
    weights = _weights(hashed, "row_size")
    counts = bucket_counts(weights, shards, bucket_bytes)
    firsts = [0, *accumulate(counts)]
    buckets = firsts.pop()
    of_shard = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("shard"))
    scattered = _spread(hashed.drop("row_size"), weights).withColumn(
        "bucket", of_shard(firsts) + F.pmod(F.xxhash64("mixed", "nth"), of_shard(counts)).cast("int")
    )

    per_task = 1 if buckets <= SINGLE_BUCKETS else BUCKETS_PER_TASK
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        scattered.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    by_hash = lambda a, b: (
        F.when(a["mixed"] < b["mixed"], -1).when(a["mixed"] > b["mixed"], 1)
        .when(a["nth"] < b["nth"], -1).when(a["nth"] > b["nth"], 1).otherwise(0)
    )
    held = (
        scattered.withColumn("task", F.floor(F.col("bucket") / per_task).cast("int"))
        .repartitionById(-(-buckets // per_task), "task")
        .groupBy("task", "shard", "bucket")
        .agg(F.array_sort(F.collect_list(F.struct("mixed", "nth", "record")), by_hash).alias("held"))
        .join(offsets, "bucket")
        .sortWithinPartitions("bucket")
        .select("shard", "offset", F.shuffle("held", seed).alias("held"))
    )
    placed = held.select("shard", "offset", F.posexplode("held").alias("place", "one"))
    return placed.select(
        *[F.col(f"one.record.c{i}").alias(c) for i, c in enumerate(rows.columns)],
        "shard",
        (F.col("offset") + F.col("place")).alias("slot"),
    )


def _has_map(rows: DataFrame) -> bool:
    return any("map<" in kind for _, kind in rows.dtypes)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard; its files in the order of their names hold its rows in slot order. An
    earlier output is replaced."""
    (
        sharded.sortWithinPartitions("shard", "slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )
