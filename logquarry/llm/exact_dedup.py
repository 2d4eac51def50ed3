"""Exact dedup of incoming batches against immutable snapshots.

A snapshot holds one row per distinct text, keyed by its digest, in hash buckets of a
bounded size, and per bucket a static binary fuse filter over the digests. Incoming
digests are grouped among themselves first, then screened by the filter of their bucket.
Most new texts end there. The positives join the exact buckets, and their bytes are compared.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stage, text_of

KEYS_PER_BUCKET = 65_536
FILTER_SCHEMA = "bucket int, seed long, segment int, slots binary"
_MIX = np.uint64(0xFF51AFD7ED558CCD)


# --- the filter ------------------------------------------------------------------------
def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys ^ np.uint64(seed)
    h = (h ^ (h >> np.uint64(33))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _places(keys: np.ndarray, seed: int, segment: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in neighbouring segments, and an 8-bit fingerprint, for each key."""
    h = _mixed(keys, seed)
    starts = size // segment - 2
    first = ((h >> np.uint64(40)) * np.uint64(starts)) >> np.uint64(24)
    mask = np.uint64(segment - 1)
    places = np.stack(
        [(first + np.uint64(i)) * np.uint64(segment) + ((h >> np.uint64(13 * i)) & mask) for i in range(3)]
    ).astype(np.int64)
    return places, ((h ^ (h >> np.uint64(21))) & np.uint64(255)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, bytes]:
    """Seed, segment length and slots of a filter that accepts every one of ``keys`` (uint64).

    Keys are peeled in rounds: those alone in one of their slots go, until none is left; slots
    are filled in the opposite order. A seed that leaves keys unpeeled is replaced by the next.
    """
    keys = np.unique(keys)
    segment = 1 << max(2, min(12, int(np.log2(max(keys.size, 4)) * 0.6)))
    size = (int(keys.size * 1.25) // segment + 4) * segment
    for seed in range(1, 200):
        places, prints = _places(keys, seed * 0x9E3779B97F4A7C15 % (1 << 63), segment, size)
        counts = np.bincount(places.ravel(), minlength=size)
        held = np.zeros(size, np.int64)
        for row in places:
            np.add.at(held, row, np.arange(keys.size))
        rounds = []
        alone = np.flatnonzero(counts == 1)
        left = keys.size
        while alone.size:
            peeled, at = np.unique(held[alone], return_index=True)
            rounds.append((peeled, alone[at]))
            left -= peeled.size
            touched = places[:, peeled]
            np.subtract.at(counts, touched.ravel(), 1)
            np.subtract.at(held, touched.ravel(), np.tile(peeled, 3))
            near = np.unique(touched.ravel())
            alone = near[counts[near] == 1]
        if not left:
            slots = np.zeros(size, np.uint8)
            for peeled, own in reversed(rounds):
                three = places[:, peeled]
                slots[own] = 0
                slots[own] = prints[peeled] ^ slots[three[0]] ^ slots[three[1]] ^ slots[three[2]]
            return seed * 0x9E3779B97F4A7C15 % (1 << 63), segment, slots.tobytes()
    raise RuntimeError("no seed gives a filter for these keys")


def accepts(keys: np.ndarray, seed: int, segment: int, slots: bytes) -> np.ndarray:
    """True for each key that the filter may hold; never False for one that it holds."""
    table = np.frombuffer(slots, np.uint8)
    places, prints = _places(keys, seed, segment, table.size)
    return prints == table[places[0]] ^ table[places[1]] ^ table[places[2]]


def _keys(table: pa.Table) -> np.ndarray:
    """The first 8 bytes of each hex digest."""
    return np.array([int(x[:16], 16) for x in table.column("text_sha256").to_pylist()], np.uint64)


def _filter_of(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    seed, segment, slots = build_filter(_keys(table))
    return pa.table(
        {
            "bucket": pa.array([key[0].as_py()], pa.int32()),
            "seed": pa.array([seed], pa.int64()),
            "segment": pa.array([segment], pa.int32()),
            "slots": pa.array([slots], pa.binary()),
        }
    )


def _screened(
    key: tuple[pa.Scalar, ...], incoming: pa.Table, filters: pa.Table
) -> pa.Table:
    if filters.num_rows and incoming.num_rows:
        one = filters.to_pylist()[0]
        hit = accepts(_keys(incoming), one["seed"], one["segment"], one["slots"])
    else:
        hit = np.zeros(incoming.num_rows, bool)
    return incoming.select(["text_sha256"]).filter(pa.array(hit))


# --- the operator ----------------------------------------------------------------------
class Snapshot(NamedTuple):
    """Distinct texts by digest (``bucket, text_sha256, keep_id, n``) and a filter per bucket."""

    exact: DataFrame
    filters: DataFrame
    buckets: int


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, text_sha256`` of every row of ``doc_id, text``; null text counts as empty."""
    return docs.select("doc_id", F.sha2(text_of(), 256).alias("text_sha256"))


def _distinct(rows: DataFrame) -> DataFrame:
    """One row per digest; equal ones meet in their task first, so a hot text is no hot key."""
    return rows.groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.crc32("text_sha256"), F.lit(buckets)).cast("int"))


def build_snapshot(rows: DataFrame, batch_keys: int = 0) -> Snapshot:
    """A snapshot of digest rows (``doc_id, text_sha256``).

    Buckets are as many as keep the snapshot's keys, and a batch of ``batch_keys``, near
    ``KEYS_PER_BUCKET`` each.
    """
    distinct = stage(_distinct(rows), "snapshot-digests")
    buckets = max(1, -(-max(distinct.count(), batch_keys) // KEYS_PER_BUCKET))
    exact = _bucketed(distinct, buckets)
    filters = exact.select("bucket", "text_sha256").groupBy("bucket").applyInArrow(
        _filter_of, FILTER_SCHEMA
    )
    return Snapshot(exact, stage(filters, "snapshot-filters"), buckets)


def screen(incoming: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The digests of ``incoming`` (one row each) that the snapshot's filters let through."""
    return (
        _bucketed(incoming.select("text_sha256"), snapshot.buckets)
        .groupBy("bucket")
        .cogroup(snapshot.filters.groupBy("bucket"))
        .applyInArrow(_screened, "text_sha256 string")
    )


def exact_dedup(docs: DataFrame, snapshot_docs: DataFrame) -> DataFrame:
    """Decide ``docs`` (the new batch) against ``snapshot_docs``, both ``doc_id, text``.

    Returns a row per input row of either side: ``doc_id, keep_id, group_size, kept, text_sha256``.
    Texts are equal when all their bytes are; null counts as empty. Of equal texts the row with
    the largest id stays. Rows that repeat an id with its text share one decision. A null id
    ranks below all others; where no id of a group is known ``keep_id`` is null and its rows stay.
    Empty inputs give no rows; further columns are ignored.
    """
    sides = stage(
        digests(snapshot_docs)
        .withColumn("side", F.lit(0))
        .unionByName(digests(docs).withColumn("side", F.lit(1))),
        "digests",
    )
    old = sides.filter("side = 0").drop("side")
    new = stage(_distinct(sides.filter("side = 1").drop("side")), "batch-digests")
    snapshot = build_snapshot(old, new.count())
    both = stage(
        screen(new, snapshot)
        .join(new, "text_sha256")
        .join(
            snapshot.exact.select(
                "text_sha256", F.col("keep_id").alias("old_id"), F.col("n").alias("old_n")
            ),
            "text_sha256",
        ),
        "positives",
    )
    checked = stage(_same_bytes(docs, snapshot_docs, both), "equal-texts")
    merged = both.join(checked, "text_sha256").select(
        "text_sha256",
        F.greatest("keep_id", "old_id").alias("both_id"),
        (F.col("n") + F.col("old_n")).alias("both_n"),
    )
    groups = (
        snapshot.exact.drop("bucket").withColumn("side", F.lit(0))
        .unionByName(new.withColumn("side", F.lit(1)))
        .join(merged, "text_sha256", "left")
        .select(
            "text_sha256",
            "side",
            F.coalesce("both_id", "keep_id").alias("keep_id"),
            F.coalesce("both_n", "n").alias("group_size"),
        )
        .filter("group_size > 1")
    )
    decided = sides.join(stage(groups, "groups"), ["text_sha256", "side"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return decided.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def _same_bytes(docs: DataFrame, snapshot_docs: DataFrame, both: DataFrame) -> DataFrame:
    """The digests whose two texts, one of either side, are the same bytes.

    A side without a known id has no text to fetch; there the digest decides. The ids grow with the
    data, so they are shuffled to the texts at every size and not broadcast at some.
    """
    wanted = both.select(
        "text_sha256", F.explode(F.array("keep_id", "old_id")).alias("wanted_id")
    ).filter("wanted_id is not null")
    texts = (
        docs.select("doc_id", "text")
        .unionByName(snapshot_docs.select("doc_id", "text"))
        .withColumn("text", text_of())
        .join(wanted.hint("merge"), F.col("doc_id") == F.col("wanted_id"))
        .filter(F.sha2("text", 256) == F.col("text_sha256"))
    )
    unequal = (
        texts.groupBy("text_sha256")
        .agg(F.min("text").alias("a"), F.max("text").alias("b"))
        .filter("a <> b")
    )
    return both.select("text_sha256").join(unequal, "text_sha256", "left_anti")
