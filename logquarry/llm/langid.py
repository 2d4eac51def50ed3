"""Language identification by a byte convolutional network, trained in numpy."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import groups_of, held_out, stage, text_of

UNKNOWN = "und"
WIDTHS = (2, 3, 4)
FILTERS = 16
WINDOW = 512
# The network is fitted on this many labelled documents at most, those of least hash, and on
# this many windows of each.
TRAIN_DOCUMENTS = 4_000
# Of each language this many are taken before others fill the rest.
TRAIN_EACH = 200
TRAIN_WINDOWS = 2
EPOCHS = 6
BATCH = 64
SEED = 11
# Windows scored at once.
_BLOCK = 512


class Network(NamedTuple):
    """Filters by width (``width x 256 x filters``, a weight for each byte at each place), their
    biases, the softmax layer, and the languages it tells apart."""

    filters: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]
    out: np.ndarray
    out_bias: np.ndarray
    langs: tuple[str, ...]


def _cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``WINDOW`` bytes that cover each text whole, zeros behind a text's end, and how
    many of each text. Windows share the bytes of a filter, so that no place is lost."""
    step = WINDOW - max(WIDTHS) + 1
    each = np.array([max(1, -(-len(t) // step)) for t in texts], np.int64)
    padded = np.zeros((int(each.sum()) + 1) * step + WINDOW, np.uint8)
    firsts = np.concatenate(([0], np.cumsum(each)))
    for text, first in zip(texts, firsts[:-1].tolist(), strict=True):
        # Behind a text's last step lies the next text; the text's own windows blank it below.
        padded[first * step : first * step + len(text)] = np.frombuffer(text, np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[:: step][: firsts[-1]].copy()
    lengths = np.array([len(t) for t in texts], np.int64)
    own = np.repeat(lengths, each) - (np.arange(firsts[-1]) - np.repeat(firsts[:-1], each)) * step
    windows[np.arange(WINDOW)[None, :] >= own[:, None]] = 0
    return windows, each


def _sums(windows: np.ndarray, filters: tuple[np.ndarray, ...]):
    """For each width, the filters' sums at each place of each window."""
    for weights in filters:
        width = weights.shape[0]
        places = windows.shape[1] - width + 1
        total = weights[0][windows[:, :places]]
        for o in range(1, width):
            total = total + weights[o][windows[:, o : o + places]]
        yield total


def train(texts: list[bytes], langs: list[str]) -> Network | None:
    """A network fitted by stochastic gradient descent with momentum; None without texts.

    Of each window only the place where a filter is highest takes part in its gradient.
    """
    if not texts:
        return None
    names = tuple(sorted(set(langs)))
    rng = np.random.default_rng(SEED)
    windows, each = _cut(texts)
    chosen, labels, at = [], [], 0
    for n, lang in zip(each.tolist(), langs, strict=True):
        some = rng.permutation(n)[:TRAIN_WINDOWS] + at
        chosen.append(some)
        labels += [names.index(lang)] * some.size
        at += n
    windows, labels = windows[np.concatenate(chosen)], np.array(labels)
    filters = [rng.normal(0, 0.2, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(names))).astype(np.float32)
    out_bias = np.zeros(len(names), np.float32)
    params = [*filters, *biases, out, out_bias]
    speed = [np.zeros_like(p) for p in params]
    steps = EPOCHS * -(-len(windows) // BATCH)
    done = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            x, y = windows[order[i : i + BATCH]], labels[order[i : i + BATCH]]
            pooled, tops = [], []
            for sums, bias in zip(_sums(x, filters), biases, strict=True):
                top = sums.argmax(axis=1)
                tops.append(top)
                pooled.append(np.take_along_axis(sums, top[:, None], 1)[:, 0] + bias)
            hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
            p = _softmax(hidden @ out + out_bias)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ out.T) * (hidden > 0)
            grads = []
            for k, top in enumerate(tops):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                g = np.zeros_like(filters[k])
                for o in range(WIDTHS[k]):
                    np.add.at(g[o], (np.take_along_axis(x, top + o, 1), np.arange(FILTERS)[None, :]), part)
                grads.append(g)
            grads += [back[:, k * FILTERS : (k + 1) * FILTERS].sum(0) for k in range(len(WIDTHS))]
            grads += [hidden.T @ p, p.sum(0)]
            rate = 0.5 * (1 - done / steps)
            done += 1
            for param, v, g in zip(params, speed, grads, strict=True):
                v *= 0.9
                v -= rate * 0.1 * g
                param += v
    return Network(tuple(filters), tuple(biases), out, out_bias, names)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Scorer:
    """A network with tables for pairs of bytes, so that a filter takes half as many look-ups."""

    def __init__(self, net: Network):
        self.net = net
        self.tables = []
        for weights in net.filters:
            pairs = []
            for o in range(0, weights.shape[0], 2):
                if o + 1 < weights.shape[0]:
                    both = weights[o][:, None, :] + weights[o + 1][None, :, :]
                    pairs.append((o, True, both.reshape(65_536, -1).astype(np.float32)))
                else:
                    pairs.append((o, False, weights[o]))
            self.tables.append((weights.shape[0], pairs))

    def logits(self, windows: np.ndarray) -> np.ndarray:
        found = []
        for i in range(0, len(windows), _BLOCK):
            x = windows[i : i + _BLOCK]
            twos = x[:, :-1].astype(np.uint16) * np.uint16(256) + x[:, 1:]
            pooled = []
            for (width, pairs), bias in zip(self.tables, self.net.biases, strict=True):
                places = WINDOW - width + 1
                total = None
                for o, two, table in pairs:
                    part = table.take((twos if two else x)[:, o : o + places], axis=0)
                    total = part if total is None else np.add(total, part, out=total)
                pooled.append(total.max(axis=1) + bias)
            found.append(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.net.out + self.net.out_bias)
        return np.concatenate(found)

    def __call__(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text: the mean of its windows' log-probabilities."""
        windows, each = _cut(texts)
        log_p = np.log(_softmax(self.logits(windows)) + 1e-9)
        firsts = np.concatenate(([0], np.cumsum(each)[:-1]))
        p = _softmax(np.add.reduceat(log_p, firsts, axis=0) / each[:, None])
        best = p.argmax(axis=1)
        return [self.net.langs[b] for b in best], p[np.arange(len(texts)), best].astype(float)


def _scored(net: Network):
    def run(batches):
        score = Scorer(net)
        for batch in batches:
            *kept, folded_text, lettered = batch.columns
            texts = [t or b"" for t in folded_text.to_pylist()]
            langs, probs = [], []
            for _, group in groups_of(texts, texts, 1 << 20):
                some_langs, some_probs = score(group)
                langs += some_langs
                probs += some_probs.tolist()
            sound = lettered.to_pylist()
            kept += [
                pa.array([a if ok else UNKNOWN for a, ok in zip(langs, sound, strict=True)], pa.string()),
                pa.array([p if ok else 1.0 for p, ok in zip(probs, sound, strict=True)], pa.float64()),
                pa.array([not ok for ok in sound], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(kept, [*batch.schema.names[:-2], "lang_pred", "score", "rejected"])

    return run


def folded() -> Column:
    """The text in lower case, as bytes: capitals say little of a language."""
    return F.lower(text_of()).cast("binary")


def fit(labelled: DataFrame, documents: int = TRAIN_DOCUMENTS, each: int = TRAIN_EACH) -> Network | None:
    """A network from rows of ``doc_id, text, lang``: the ``documents`` of least hash, those first that are
    among the ``each`` first of their language. Rows alike in id, language and text are one, and an id
    gives one text to a language, so that one repeated without end takes one place.
    """
    drawn = (
        labelled.filter("lang is not null")
        .select("doc_id", "lang", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("text_hash"))
        .groupBy("doc_id", "lang", "h")
        .agg(F.min("text_hash").alias("text_hash"))
    )
    # Spark keeps the first of each language in every task before rows are shuffled.
    by_lang = drawn.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
    first = stage(by_lang.filter(F.col("place") <= each).select("h", "doc_id", "lang", "text_hash"), "first-of-lang")
    others = drawn.select("h", "doc_id", "lang", "text_hash").orderBy("h", "doc_id", "lang").limit(documents)
    least = F.when(F.col("early"), 0).otherwise(1)
    wanted = stage(
        first.withColumn("early", F.lit(True)).unionByName(others.withColumn("early", F.lit(False)))
        .groupBy("h", "doc_id", "lang", "text_hash").agg(F.max("early").alias("early"))
        .orderBy(least, "h", "doc_id", "lang").limit(documents).select("h", "doc_id", "lang", "text_hash"),
        "wanted",
    )
    rows = (
        labelled.withColumn("text_hash", F.xxhash64("text"))
        .join(F.broadcast(wanted), ["doc_id", "lang", "text_hash"])
        .select("h", "doc_id", "lang", folded().alias("text"))
        .mapInArrow(_training_text, "h long, doc_id long, lang string, text binary")
        .distinct()
        .orderBy("h", "doc_id", "lang", "text")
        .limit(documents)
        .collect()
    )
    rows.sort(key=lambda r: (r["h"], r["doc_id"], r["lang"], r["text"]))
    return train([bytes(r["text"]) for r in rows], [r["lang"] for r in rows])


def _training_text(batches):
    """Long texts give two windows' bytes, from places that their content sets."""
    for batch in batches:
        cut = []
        for text in batch.column("text").to_pylist():
            if len(text) > 2 * WINDOW:
                rng = np.random.default_rng(len(text))
                some = np.sort(rng.integers(0, len(text) - WINDOW, TRAIN_WINDOWS))
                text = b" ".join(text[i : i + WINDOW - 1] for i in some.tolist())
            cut.append(text)
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(cut, pa.binary()))


def identify(docs: DataFrame, net: Network | None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``lang_pred``, ``score`` and ``rejected`` of every row of ``doc_id, text``.

    The whole text is scored, in windows of ``WINDOW`` bytes. Text that is null or has no letter is
    ``und`` with score 1, and it alone is ``rejected``: no text with letters is, however low its score,
    as clean documents must stay. Without a network all is ``und``, others with score 0. Repeated rows are
    scored each; an empty table gives no rows. Kept columns named as the results are replaced.
    """
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    kept = [c for c in keep if c not in ("lang_pred", "score", "rejected")]
    rows = docs.select(*kept, folded().alias("folded_text"), lettered.alias("lettered"))
    if net is None:
        return rows.select(
            *kept,
            F.lit(UNKNOWN).alias("lang_pred"),
            F.when(F.col("lettered"), 0.0).otherwise(1.0).alias("score"),
            (~F.col("lettered")).alias("rejected"),
        )
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(_scored(net), schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: those not held out. A null id is not one of them."""
    return docs.filter(F.col("doc_id").isNotNull() & ~held_out())
