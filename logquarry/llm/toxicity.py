"""Toxic passages by maximum-scoring segment search.

Tokens get log-odds of standing in toxic rather than clean labelled documents, smoothed by a
Dirichlet prior and lowered by their standard error; all others a small penalty. A linear-time
scan finds every maximal scoring segment of a document. Scores of chance segments in clean documents
follow an extreme-value law, which turns a segment's score and its document's length into a
significance; the document's sum of these is mapped to a probability.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import batch_lists, groups_of, held_out, stage, text_of
from logquarry.llm.words import BASES, run_hashes, span_hashes, word_spans

# The classifier is fitted on this many labelled documents at most, those of least hash.
TRAIN_DOCUMENTS = 20_000
# Prior count of each token in either class, and how many standard errors its log-odds are lowered by.
PRIOR = 0.5
LOWERED_BY = 2.5
# Lowered log-odds below this tell nothing: copies of a document share their words.
LEAST_ODDS = 1.0
PENALTY = 0.1
SIGN_WORDS = 5
# Longer words also count by their first bytes, so that unseen forms of a stem are known.
STEM_BYTES = 5
THRESHOLD = 0.3
_GROUP = 1 << 20
_BLANKED = bytes(
    c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)
)
_STEM = np.uint64(0x5BD1E995C6A4A793)


class Lexicon(NamedTuple):
    """Token hashes in order and their scores, all above ``LEAST_ODDS``."""

    hashes: np.ndarray
    scores: np.ndarray


class Model(NamedTuple):
    lexicon: Lexicon
    rate: float  # lambda of the extreme-value law
    density: float  # K of the extreme-value law
    slope: float
    offset: float


# --- tokens ----------------------------------------------------------------------------
def folded() -> Column:
    return F.lower(text_of()).cast("binary")


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words and of their stems (0: none) of all texts, and where each text's begin."""
    joined = b" ".join(texts).translate(_BLANKED)
    data = np.frombuffer(joined, np.uint8)
    starts, ends = word_spans(data)
    text_starts = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    if not starts.size:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), text_starts
    words = span_hashes(data, starts, ends)
    stems = span_hashes(data, starts, np.minimum(ends, starts + STEM_BYTES)) ^ _STEM
    stems[ends - starts <= STEM_BYTES] = 0
    return words, stems, text_starts


def _signed(batches):
    """With the least hash of the runs of ``SIGN_WORDS`` words, which near copies share mostly."""
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        signs = []
        for _, group in groups_of(texts, texts, _GROUP):
            words, _, starts = _tokens(group)
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                at = np.arange(max(0, e - s - SIGN_WORDS + 1))
                runs = run_hashes(words[s:e], at, at + SIGN_WORDS, BASES[1]) if at.size else words[s:e]
                signs.append(int(runs.min()) >> 1 if runs.size else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), batch.column("toxic"), pa.array(signs, pa.int64())],
            ["doc_id", "text", "toxic", "sign"],
        )


def _counted(batches):
    """Per batch: in how many toxic and clean documents of either fold a token stands."""
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        kinds = (batch.column("fold").to_numpy() * 2 + batch.column("toxic").to_numpy()).astype(np.int64)
        ids = list(range(len(texts)))
        found = []
        for group, group_texts in groups_of(ids, texts, _GROUP):
            words, stems, starts = _tokens(group_texts)
            own = np.repeat(kinds[group], np.diff(starts))
            doc = np.repeat(np.arange(len(group)), np.diff(starts))
            for hashes in (words, stems):
                some = hashes != 0
                pairs = np.unique(np.stack((hashes[some], doc[some].astype(np.uint64), own[some].astype(np.uint64))), axis=1)
                found.append(pairs[[0, 2]])
        both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.uint64)
        tokens, at = np.unique(both[0], return_inverse=True)
        counts = np.zeros((4, tokens.size), np.int64)
        np.add.at(counts, (both[1].astype(np.int64), at), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens.view(np.int64)), *(pa.array(c) for c in counts)], ["h", "n0", "n1", "n2", "n3"]
        )


# --- segments --------------------------------------------------------------------------
def maximal_segments(places: list[int], scores: list[float], penalty: float = PENALTY) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a sequence that is ``-penalty``
    but for positive ``scores`` at ``places`` (rising), in linear time.

    Candidates are kept with the running total before and after them. A new one is joined to the
    latest that begins at a lower total, if it also ends at a lower one.
    """
    kept: list[tuple[int, int, float, float]] = []
    total, last = 0.0, None
    for place, score in zip(places, scores, strict=True):
        total -= penalty * (place - last - 1 if last is not None else place)
        first, before, total, last = place, total, total + score, place
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= before:
                j -= 1
            if j < 0 or kept[j][3] >= total:
                kept.append((first, place, before, total))
                break
            first, before = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, after - before) for a, b, before, after in kept]


def _scored_tokens(lexicon: Lexicon, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
    """The score of each token, 0 where the lexicon has neither word nor stem."""
    best = np.zeros(words.size)
    if lexicon.hashes.size:
        for hashes in (words, stems):
            at = np.minimum(np.searchsorted(lexicon.hashes, hashes), lexicon.hashes.size - 1)
            best = np.maximum(best, np.where(lexicon.hashes[at] == hashes, lexicon.scores[at], 0))
    return best


def segments_of(texts: list[bytes], lexicon: Lexicon) -> list[tuple[int, list[tuple[int, int, float]]]]:
    """Number of tokens and maximal segments of each (folded) text."""
    words, stems, starts = _tokens(texts)
    scores = _scored_tokens(lexicon, words, stems)
    hit = np.flatnonzero(scores)
    bounds = np.searchsorted(hit, starts).tolist()
    sizes = np.diff(starts).tolist()
    out = []
    for i, n in enumerate(sizes):
        mine = hit[bounds[i] : bounds[i + 1]]
        found = maximal_segments((mine - starts[i]).tolist(), scores[mine].tolist()) if mine.size else []
        out.append((n, found))
    return out


def evidence(n: int, scores: list[float], rate: float, density: float) -> float:
    """The sum of the segments' significance: how far each one's expected number of equals in
    ``n`` clean tokens lies below one, in powers of e."""
    at = np.log(max(density * max(n, 1), 1e-12))
    return float(np.log1p(sum(max(0.0, rate * s - at) for s in scores)))


# --- fitting ---------------------------------------------------------------------------
def _log_odds(toxic: str, clean: str, docs: tuple[float, float]) -> Column:
    """Log-odds ratio of a token's document counts under the prior, lowered by its error."""
    a, b = F.expr(toxic) + F.lit(PRIOR), F.expr(clean) + F.lit(PRIOR)
    toxic_docs, clean_docs = docs[0] + 2 * PRIOR, docs[1] + 2 * PRIOR
    odds = F.log(a / F.greatest(F.lit(toxic_docs) - a, F.lit(PRIOR))) - F.log(
        b / F.greatest(F.lit(clean_docs) - b, F.lit(PRIOR))
    )
    return odds - LOWERED_BY * F.sqrt(1 / a + 1 / b)


def _lexicon(rows, column: str) -> Lexicon:
    some = sorted((r["h"] % (1 << 64), r[column]) for r in rows if r[column] > LEAST_ODDS)
    return Lexicon(np.array([s[0] for s in some], np.uint64), np.array([s[1] for s in some], float))


def fit(docs: DataFrame, labels: DataFrame, documents: int = TRAIN_DOCUMENTS) -> Model:
    """A model from ``doc_id, text`` and the ``doc_id, toxic`` of those that are not held out.

    Ids with several labels are toxic if one is; null ids and labels are left out. The law and the map to
    probabilities come from documents scored by the tokens of the other half of the sample.
    """
    wanted = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(documents)
    )
    labelled = stage(
        docs.select("doc_id", folded().alias("text"))
        .join(F.broadcast(wanted), "doc_id")
        .mapInArrow(_signed, "doc_id long, text binary, toxic int, sign long"),
        "labelled",
    )
    # One of each group of near copies: a passage that was copied is no more evidence than one.
    # An id may repeat without end, so that rows are chosen, not ids, and no more of them than documents.
    row = F.struct("doc_id", F.xxhash64("text").alias("text_hash"))
    singles = (
        labelled.groupBy("sign", "toxic").agg(F.min(row).alias("row"))
        .select("sign", "toxic", "row.doc_id", "row.text_hash")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "sign").limit(documents)
    )
    sample = stage(
        labelled.withColumn("text_hash", F.xxhash64("text"))
        .join(F.broadcast(singles), ["sign", "toxic", "doc_id", "text_hash"])
        .dropDuplicates(["sign", "toxic"])
        .withColumn("fold", F.pmod(F.xxhash64("sign"), F.lit(2)).cast("int")),
        "sample",
    )
    sizes = {(r["fold"], r["toxic"]): float(r["count"]) for r in sample.groupBy("fold", "toxic").count().collect()}
    n = [sizes.get((k // 2, k % 2), 0.0) for k in range(4)]
    if not (n[1] + n[3]):
        return Model(_lexicon([], ""), 1.0, 1.0, 0.0, -9.0)
    rows = (
        sample.select("text", "fold", "toxic")
        .mapInArrow(_counted, "h long, n0 long, n1 long, n2 long, n3 long")
        .groupBy("h")
        .agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(4)])
        .filter("n1 + n3 > 1")
        .select(
            "h",
            _log_odds("n1 + n3", "n0 + n2", (n[1] + n[3], n[0] + n[2])).alias("whole"),
            _log_odds("n1", "n0", (n[1], n[0])).alias("first"),
            _log_odds("n3", "n2", (n[3], n[2])).alias("second"),
        )
        .filter(F.greatest("whole", "first", "second") > LEAST_ODDS)
        .collect()
    )
    halves = (_lexicon(rows, "second"), _lexicon(rows, "first"))
    scored = [
        (r["toxic"], r["n"], list(r["scores"]))
        for r in sample.select("text", "fold", "toxic")
        .mapInArrow(_sample_segments(halves), "toxic int, n long, scores array<double>")
        .collect()
    ]
    rate, density = _law([(n, s) for toxic, n, s in scored if toxic == 0])
    x = np.array([evidence(n, s, rate, density) for _, n, s in scored])
    slope, offset = _logistic(x, np.array([t for t, _, _ in scored], float))
    return Model(_lexicon(rows, "whole"), rate, density, slope, offset)


def _sample_segments(halves: tuple[Lexicon, Lexicon]):
    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            folds = batch.column("fold").to_pylist()
            ns, scores = [], []
            for group, group_texts in groups_of(list(range(len(texts))), texts, _GROUP):
                both = [segments_of(group_texts, half) for half in halves]
                for i, at in enumerate(group):
                    n, found = both[folds[at]][i]
                    ns.append(n)
                    scores.append([s for _, _, s in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(ns, pa.int64()), pa.array(scores, pa.list_(pa.float64()))],
                ["toxic", "n", "scores"],
            )

    return run


def _law(clean: list[tuple[int, list[float]]]) -> tuple[float, float]:
    """Rate and density of chance segments in clean documents.

    Above the least score seen, their number in n tokens is density * n * exp(-rate * score): the
    rate is the inverse mean excess, with one more segment of excess one so that few give a cautious law.
    """
    tokens = sum(n for n, _ in clean) + 1
    scores = np.array([s for _, found in clean for s in found])
    least = float(scores.min()) if scores.size else 0.0
    rate = float((scores.size + 1) / ((scores - least).sum() + 1.0)) if scores.size else 1.0
    rate = min(rate, 5.0)
    return rate, float((scores.size + 1) * np.exp(rate * least) / tokens)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, with a small ridge on the slope."""
    w = np.zeros(2)
    features = np.stack((x, np.ones_like(x)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ features, -30, 30)))
        grad = features @ (p - y) + np.array([0.1 * w[0], 0.01 * w[1]])
        hessian = (features * (p * (1 - p))) @ features.T + np.diag([0.1, 0.01])
        step = np.linalg.solve(hessian, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


# --- scoring ---------------------------------------------------------------------------
_PASSAGE = pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64())])


def _scored(model: Model):
    def run(batches):
        for batch in batches:
            ids, texts = batch_lists(batch)
            scores, passages = [], []
            for _, group in groups_of(ids, texts, _GROUP):
                for n, found in segments_of(group, model.lexicon):
                    x = evidence(n, [s for _, _, s in found], model.rate, model.density)
                    scores.append(1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -30, 30))))
                    least = np.log(max(model.density * max(n, 1), 1e-12))
                    passages.append(
                        [
                            {"first_word": a, "last_word": b, "score": s}
                            for a, b, s in found
                            if model.rate * s > least
                        ]
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(scores, pa.float64()),
                    pa.array(passages, pa.list_(_PASSAGE)),
                ],
                ["doc_id", "score", "passages"],
            )

    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted, passages`` of every row of ``doc_id, text``.

    ``passages`` are the significant segments, by first and last word (runs of letters), with their
    scores. Texts that are null or without words have none and score as clean ones do. Repeated rows
    are scored each; an empty table gives no rows; further columns are ignored.
    """
    rows = docs.select("doc_id", folded().alias("text")).mapInArrow(
        _scored(model),
        "doc_id long, score double, passages array<struct<first_word:int,last_word:int,score:double>>",
    )
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
