"""Exact top-k search by integer inner product with MaxScore.

Components are terms: a vector's postings are its components, a query's weights its own. What a term, and
what all terms to come, can add to a score has bounds: a term's largest posting times its weight, and
the product of what is left of both norms. The terms of largest bounds are essential: their postings are
traversed for blocks of queries at once, as products of matrices. The rest are probed for those pairs alone
that can still reach the query's threshold. Vectors lie in falling order of norm, so that whole blocks
that cannot reach it are passed over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stage

K = 20
SCALE = 64
SHARD_VECTORS = 32_768
QUERY_BLOCK = 4_096
# So many vectors of largest norm give each query its first threshold; they go to every task.
SAMPLE = 2_048
# Queries and vectors that meet in one product, by how many terms the essential ones change, and pairs
# finished at once.
_QUERIES = 256
_VECTORS = 4_096
_STEP = 4
_PAIRS = 1 << 16
# Below one pair in so many, the terms left are added pair by pair.
_FEW = 16
# Bounds from norms are rounded; they are taken a little wider.
_WIDER = 1 + 1e-9
_SAFE = float(1 << 53)


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of each component as a double, then as a long. Null vectors
    and those that hold a null, NaN or infinite component are left out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    sound = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(F.col("embedding").isNotNull() & sound).select(
        F.col("vec_id").cast("long"),
        F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"),
    )


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """Rows of vectors, short ones filled with zeros, transposed: one line per term."""
    column = table.column("v").combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return np.ascontiguousarray(out.T)


def _longest(table: pa.Table) -> int:
    column = table.column("v").combine_chunks()
    return int(np.diff(column.offsets.to_numpy()).max(initial=0))


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest score of each line."""
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def _exact(*parts: np.ndarray) -> type:
    """Doubles where all sums of products are whole numbers up to 2^53, and so exact and much faster."""
    largest = [float(np.abs(p.astype(np.float64)).max(initial=0)) for p in parts]
    return np.float64 if np.prod(largest) * max(1, len(parts[0])) < _SAFE else np.int64


class _Best:
    """The best of each query so far, and its threshold, which only rises."""

    def __init__(self, thresholds: np.ndarray, k: int):
        self.k, self.thresholds = k, thresholds.copy()
        self.query = np.zeros(0, np.int64)
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def take(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        query, ids = np.concatenate((self.query, query)), np.concatenate((self.ids, ids))
        scores = np.concatenate((self.scores, scores.astype(np.int64)))
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        begins = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if query.size else query
        place = np.arange(query.size) - np.repeat(begins, np.diff(np.append(begins, query.size)))
        keep = place < self.k
        self.query, self.ids, self.scores = query[keep], ids[keep], scores[keep]
        full = place == self.k - 1
        at = query[full]
        self.thresholds[at] = np.maximum(self.thresholds[at], scores[full])


def search_block(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    postings: np.ndarray,
    k: int,
    thresholds: np.ndarray | None = None,
    saved: list | None = None,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (a column of ``queries``), ids and scores of its ``k`` best among the columns of
    ``postings``, ties to smaller ids, vectors of the query's own id left out.

    Both matrices have a line per term. ``thresholds`` are scores that ``k`` other vectors reach. ``saved``
    takes up how many products there would be and how many were made.
    """
    n = len(query_ids)
    best = _Best(np.full(n, np.iinfo(np.int64).min) if thresholds is None else thresholds, k)
    kind = _exact(postings, queries)
    norms = np.sqrt((postings.astype(np.float64) ** 2).sum(axis=0))
    by_norm = np.argsort(-norms, kind="stable")
    lists, ids, norms = postings[:, by_norm].astype(kind), ids[by_norm], norms[by_norm]
    weights = queries.astype(kind)
    for q in range(0, n, _QUERIES):
        own = np.arange(q, min(q + _QUERIES, n))
        # A term's bound is what it can add at most, over the queries of the block.
        bounds = np.abs(weights[:, own]).sum(axis=1) * np.abs(lists).max(axis=1, initial=0)
        order = np.argsort(-bounds, kind="stable")
        w, mine = weights[order][:, own], lists[order]
        w_norms = np.sqrt((w.astype(np.float64) ** 2).sum(axis=0))
        essential, made = len(w) // 2, 0
        for v in range(0, ids.size, _VECTORS):
            part = slice(v, min(v + _VECTORS, ids.size))
            if kind is np.float64:
                # Norms fall, so no vector behind can reach a threshold either.
                able = w_norms * norms[v] * _WIDER >= best.thresholds[own]
                if not able.any():
                    break
            some, essential = _search_cell(best, own, query_ids, w, mine[:, part], ids[part], essential)
            made += some
        if saved is not None:
            saved.append((len(own) * ids.size * len(lists), made))
    out = []
    begins = np.searchsorted(best.query, np.arange(n + 1))
    for s, e in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        out.append((best.ids[s:e], best.scores[s:e]))
    return out


def _search_cell(best: _Best, own, query_ids, w, lists, ids, essential: int) -> tuple[int, int]:
    """Queries ``own`` against some vectors: the first ``essential`` terms for all pairs, the others for those
    that can still reach the threshold, or for all where these are many.

    Returns how many products were made, and how many essential terms to try next.
    """
    thresholds, terms = best.thresholds[own], len(w)
    done, pairs = terms, w.shape[1] * ids.size
    if w.dtype == np.float64 and essential < terms:
        # What is still to come is no more than the terms' bounds, and no more than the product of the norms.
        rest_w, rest_v = w[essential:], lists[essential:]
        reach = np.maximum(rest_v.max(axis=1), -rest_v.min(axis=1))
        by_norm = np.sqrt((rest_w**2).sum(axis=0)) * np.sqrt((rest_v**2).sum(axis=0).max()) * _WIDER
        to_come = np.minimum(np.abs(rest_w).T @ reach, by_norm)
        scores = w[:essential].T @ lists[:essential]
        alive = scores >= (thresholds - to_come)[:, None]
        able = np.count_nonzero(alive)
        if able * _FEW < pairs:
            done = essential
            essential = max(_STEP, essential - _STEP) if able * _FEW * 4 < pairs else essential
        else:
            scores += rest_w.T @ rest_v
            essential += _STEP
    else:
        scores = w.T @ lists
    if done == terms:
        alive = scores >= thresholds[:, None]
    query, vector = np.nonzero(alive)
    found = scores[query, vector]
    if done < terms:
        left_w, left_v = np.ascontiguousarray(w[done:].T), np.ascontiguousarray(lists[done:].T)
        for at in range(0, query.size, _PAIRS):
            some = slice(at, at + _PAIRS)
            found[some] += np.einsum("ij,ij->i", left_w[query[some]], left_v[vector[some]])
    keep = (found >= thresholds[query]) & (query_ids[own][query] != ids[vector])
    best.take(own[query[keep]], ids[vector[keep]], found[keep])
    return pairs * done + query.size * (terms - done), essential


def _searched(k: int):
    def run(key: tuple[pa.Scalar, ...], shard: pa.Table, block: pa.Table) -> pa.Table:
        rows = ([], [], [])
        if shard.num_rows and block.num_rows:
            width = max(_longest(shard), _longest(block))
            query_ids = block.column("vec_id").to_numpy()
            found = search_block(
                query_ids, _matrix(block, width), shard.column("vec_id").to_numpy(), _matrix(shard, width), k,
                block.column("threshold").to_numpy(),
            )
            for own, (near, scores) in zip(query_ids.tolist(), found, strict=True):
                rows[0].append(np.full(near.size, own, np.int64))
                rows[1].append(near)
                rows[2].append(scores)
        columns = [np.concatenate(r) if r else np.zeros(0, np.int64) for r in rows]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns), strict=True)))

    return run


def _with_thresholds(queries: DataFrame, vectors: DataFrame, k: int, sample: int) -> DataFrame:
    """``queries`` with ``threshold``: the score of the ``k``-th best of the ``sample`` vectors of largest norm, the
    query's own left out; the least long where there are fewer. No vector below it is among the best."""
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    rows = vectors.select("vec_id", "v", norm.alias("norm")).orderBy(F.desc("norm"), "vec_id").limit(sample).collect()
    ids = np.array([r["vec_id"] for r in rows], np.int64)
    lists = [np.array(r["v"], np.int64) for r in rows]

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            width = max([_longest(table), *map(len, lists)])
            w = _matrix(table, width)
            seen = np.zeros((width, len(lists)), np.int64)
            for i, v in enumerate(lists):
                seen[: v.size, i] = v
            out = np.full(batch.num_rows, np.iinfo(np.int64).min)
            kind = _exact(seen, w)
            for at in range(0, batch.num_rows, _QUERIES):
                scores = w[:, at : at + _QUERIES].T.astype(kind) @ seen.astype(kind)
                mine = batch.column("vec_id").to_numpy()[at : at + _QUERIES, None] == ids[None, :]
                least = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
                scores[mine] = least
                if ids.size >= k:
                    kth = _kth(scores, k)
                    enough = (~mine).sum(axis=1) >= k
                    out[at : at + _QUERIES][enough] = kth[enough].astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(out)], ["vec_id", "v", "threshold"])

    return queries.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<long>, threshold long")


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    shard_vectors: int = SHARD_VECTORS,
    query_block: int = QUERY_BLOCK,
    sample: int = SAMPLE,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product with each of ``queries``.

    Both are ``vec_id, v`` rows (see :func:`quantised`). Returns ``query_id, rank, vec_id, score``, ranks
    from 1, equal scores by smaller id. Rows with the query's id are no candidates; each other
    row is one, also where its id repeats. Query rows that are equal count once; several queries of
    one id are ranked together. A null id is neither query nor candidate. Missing components of a
    shorter vector are zero. Where fewer rows exist all are returned; an empty side gives no rows. Scores
    of more than 64 bits wrap around.

    A query's threshold comes from the ``sample`` vectors of largest norm, found once and known to every task;
    it leaves no row out that is among the best. Vectors are dealt to shards, queries to blocks; every
    shard meets every block in a task of its own, and each task returns at most ``k`` rows a query, which
    a window merges.
    """
    vectors = stage(vectors.filter("vec_id is not null").select("vec_id", "v"), "vectors")
    queries = stage(queries.filter("vec_id is not null").select("vec_id", "v").distinct(), "queries")
    shards = max(1, -(-vectors.count() // shard_vectors))
    blocks = max(1, -(-queries.count() // query_block))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Rows are dealt one by one, as one id may repeat without end.
    dealt = vectors.withColumn(
        "shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    ).withColumn("block", every(blocks))
    asked = _with_thresholds(queries, vectors, k, sample).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")
    ).withColumn("shard", every(shards))
    found = (
        dealt.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(_searched(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
