"""SimHash near-dedup by multi-index hashing.

Fingerprints of at most ``RADIUS`` differing bits agree, in one of their two halves, but for one
bit at most. Each half is a table keyed by its 32 bits; a fingerprint probes a table with its own
half and with the half's small ball, and the matches' complete distances are compared.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stage, text_of

SHINGLE_WORDS = 3
HASH_SEED = 42
RADIUS = 2
HALF = 32
# A table entry with more fingerprints than this is split by parts of the other half.
LARGE_ENTRY = 256
NIBBLES = 8
_CHUNK = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# --- fingerprints ----------------------------------------------------------------------
def fingerprint(text: bytes, words_each: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as an unsigned number.

    A-Z are lower-cased; words are parted by ASCII white space. Each shingle counts as often as it
    occurs. A text of fewer words is one shingle; one without words has fingerprint 0.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - words_each + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[-n:].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        part = range(at, min(at + _CHUNK, n))
        hashes = np.fromiter((digest(joined[starts[i] : stops[i]], HASH_SEED) for i in part), np.uint64, len(part))
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        prints = np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(prints)], ["doc_id", "text_hash", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` (a signed long) of every row of ``doc_id, text``; null text counts
    as empty."""
    return docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64(text_of()).alias("text_hash"),
        text_of().cast("binary").alias("text"),
    ).mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long")


# --- links -----------------------------------------------------------------------------
def _halves(prints: DataFrame) -> DataFrame:
    """Both halves of each fingerprint: ``half`` number, its ``own`` bits, the ``other`` bits."""
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("fp", HALF)
    rows = F.array(
        F.struct(F.lit(0).alias("half"), high.alias("own"), low.alias("other")),
        F.struct(F.lit(1).alias("half"), low.alias("own"), high.alias("other")),
    )
    return prints.select("fp", F.explode(rows).alias("h")).select("fp", "h.*")


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= RADIUS


def _other_masked() -> Column:
    """The other half with each pair of its nibbles blanked: two that differ in two bits at most
    agree in one of these, and no more than 256 values do."""
    masks = []
    for pair in combinations(range(NIBBLES), 2):
        blank = sum(0xF << (4 * i) for i in pair)
        masks.append(F.lit(((1 << HALF) - 1) & ~blank))
    return F.transform(F.array(*masks), lambda m: F.struct(m.alias("mask"), F.col("other").bitwiseAND(m).alias("rest")))


def links(prints: DataFrame, large_entry: int = LARGE_ENTRY) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints (rows ``fp``, unique) with at most two differing
    bits, each pair once or more.

    A ball of radius one is enumerated one way only, by clearing a set bit: of two halves one bit
    apart, one has that bit. Table entries above ``large_entry`` fingerprints are matched on pairs
    of nibbles of the other half as well, which keeps every match list within 256 of each half.
    """
    entries = _halves(prints)
    bits = F.array(*[F.lit(1 << i).cast("long") for i in range(HALF)])
    ball = F.concat(
        F.array(F.col("own")),
        F.transform(
            F.filter(bits, lambda b: F.col("own").bitwiseAND(b) != 0),
            lambda b: F.col("own").bitwiseXOR(b),
        ),
    )
    probes = entries.select("fp", "half", "own", "other", F.explode(ball).alias("key"))
    table = entries.select("half", F.col("own").alias("key"), F.col("fp").alias("b"), "other")
    large = stage(
        table.groupBy("half", "key").count().filter(F.col("count") > large_entry).select("half", "key"),
        "large-entries",
    )
    found = _near("fp", "b") & ((F.col("own") != F.col("key")) | (F.col("fp") < F.col("b")))
    has_large = not large.isEmpty()
    small = table.join(large, ["half", "key"], "left_anti") if has_large else table
    pairs = (
        probes.drop("other")
        .join(small.drop("other"), ["half", "key"])
        .filter(found)
        .select(F.col("fp").alias("a"), "b")
    )
    if has_large:
        parts = lambda rows: rows.withColumn("part", F.explode(_other_masked())).select("*", "part.mask", "part.rest").drop("part", "other")
        wide = parts(probes.join(large, ["half", "key"], "left_semi"))
        wide_table = parts(table.join(large, ["half", "key"], "left_semi"))
        more = wide.join(wide_table, ["half", "key", "mask", "rest"]).filter(found)
        pairs = pairs.unionByName(more.select(F.col("fp").alias("a"), "b"))
    return pairs


# --- components ------------------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` edges; the root is the least node it can reach.

    Large-star and small-star steps in turn: each hangs neighbours onto the least node near them,
    until nothing changes. Least nodes are written before they are joined back, so that the join
    has two shuffled sides and Spark can split the rows of a node with very many neighbours.
    """
    edges = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        for large in (True, False):
            edges = _star(edges, large)
        state = tuple(
            edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        )
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges ``u > v``: large hangs the greater neighbours of a node onto the
    least one, small the node and its lesser neighbours."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = stage(
        near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least"
    )
    hung = near.join(least, "u")
    if large:
        moved = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return stage(moved.filter("u <> v").distinct(), "star")


# --- the operator ----------------------------------------------------------------------
def near_duplicates(docs: DataFrame, large_entry: int = LARGE_ENTRY) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, component_size, stays`` of every row of ``doc_id, text``.

    Documents are linked when their fingerprints differ in two bits at most, texts without words
    (fingerprint 0) like all others; ``component_id`` is the least id a document can reach, itself
    included, and ``stays`` marks that document (of several texts with that id, the one of least
    hash). Equal fingerprints are one node, so copies never meet in pairs. Null ids count as greater
    than all; where a component has no other, its id is null. Rows that repeat an id with its
    text are one document. An empty table gives no rows; further columns are ignored.
    """
    prints = stage(fingerprints(docs), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash"))
    nodes = stage(
        prints.groupBy("fp").agg(first.alias("least"), F.count(F.lit(1)).alias("n")), "nodes"
    )
    roots = components(links(nodes.select("fp"), large_entry))
    members = stage(
        nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
            "fp", "least", "n", F.coalesce("root", "fp").alias("root")
        ),
        "members",
    )
    whole = members.groupBy("root").agg(F.min("least").alias("least"), F.sum("n").alias("component_size"))
    groups = stage(
        members.select("fp", "root")
        .join(stage(whole.filter("component_size > 1"), "whole"), "root")
        .drop("root"),
        "components",
    )
    alone = F.col("component_size").isNull()
    return prints.join(groups, "fp", "left").select(
        "doc_id",
        "text_hash",
        "fp",
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        F.coalesce("component_size", F.lit(1).cast("long")).alias("component_size"),
        (
            alone
            | F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
        ).alias("stays"),
    )
