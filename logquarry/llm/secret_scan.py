"""Secret scans: fixed patterns, and a character convolutional network over every other candidate.

Candidates are long runs of the characters that keys and tokens consist of. The fixed patterns label
them: a candidate that a pattern found is a finding. A network of two filter banks, one over the
candidate and one over what surrounds it, is trained on all distinct candidates of both kinds, dealt over
shards: numpy trains each shard from common weights for an epoch, then Spark takes their mean. Findings are also shown among other candidates' surroundings, cut short and in capitals, so that it learns what values look like
and not the patterns' own words alone. Its probabilities are calibrated on labelled candidates it has
not seen, varied in the same way, and each shape of candidate has the highest threshold that keeps
the recall there; both are computed over all shards.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stage, text_of

KINDS = ("assign", "access", "hex", "network")
_ASSIGN = re.compile(
    rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
LEAST_ASSIGNED = 6
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(rb"[0-9a-f]{24,}")
# A candidate has a digit and this many of the characters of values.
LEAST_CANDIDATE = 16
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_.=-]{16,}")
_DIGIT = re.compile(rb"[0-9]")
# Bytes of a candidate that the network sees at once (longer ones are seen in several windows), and
# bytes before and behind it.
VALUE, AROUND = 48, 24
WIDTHS = (2, 4)
FILTERS = 12
# A shard holds about this many distinct candidates of the more frequent kind; a quarter of them is kept apart
# for calibration. Where the other kind is rare, its candidates go to several shards, so that each has some.
TRAIN_CANDIDATES = 4_000
LEAST_SHARD = 250
LEAST_EACH = 8
# Unlabelled candidates that a first network gives this probability or more are not learned from.
UNSURE = 0.005
EPOCHS = 12
BATCH = 64
SEED = 12
RECALL = 0.98
SHAPES = ("hex", "lower", "upper", "mixed")


# --- candidates ------------------------------------------------------------------------
def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """``start, kind, end`` in bytes of the fixed patterns' findings."""
    found = [
        (m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGNED
    ]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidate_spans(text: bytes) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _CANDIDATE.finditer(text) if _DIGIT.search(text, *m.span()))


def windows_of(text: bytes, start: int, to: int, end: int) -> list[bytes]:
    """What the network sees of a candidate's bytes up to ``to``: bytes before the candidate, of it, and
    behind it, zeros where there are none."""
    before = text[max(0, start - AROUND) : start].rjust(AROUND, b"\0")
    behind = text[end : end + AROUND].ljust(AROUND, b"\0")
    return [
        before + text[at : min(at + VALUE, to)].ljust(VALUE, b"\0") + behind for at in range(start, to, VALUE)
    ]


def shape_of(value: bytes) -> int:
    """Which threshold holds: hexadecimal, lower case, upper case, mixed."""
    letters = re.sub(rb"[^A-Za-z]", b"", value)
    if not re.search(rb"[^0-9a-fA-F]", value):
        return 0
    return 1 if letters == letters.lower() else 2 if letters == letters.upper() else 3


def _points(text: bytes, places: list[int]) -> list[int]:
    """Byte places as numbers of code points before them."""
    if text.isascii() or not places:
        return places
    data = np.frombuffer(text, np.uint8)
    return np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[places].tolist()


def labelled_spans(text: bytes) -> tuple[list[tuple[int, int, int]], Iterator[tuple[int, int, bool]]]:
    """The base spans, and of each candidate its place and whether a base span touches it."""
    base = base_spans(text)

    def candidates():
        j, reach = 0, -1
        for start, end in candidate_spans(text):
            while j < len(base) and base[j][0] < end:
                reach = max(reach, base[j][2])
                j += 1
            yield start, end, reach > start

    return base, candidates()


def _labelled(most: int):
    """Each candidate's first window with its label; those alike count once, among ``most`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]):
        kept: dict[tuple[bool, bytes], int] = {}

        def rows() -> pa.RecordBatch:
            hashes = [xxhash.xxh64_intdigest(w) >> 1 for _, w in kept]
            columns = ([f for f, _ in kept], [w for _, w in kept], hashes, list(kept.values()))
            types = (pa.bool_(), pa.binary(), pa.int64(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["found", "window", "h", "shape"]
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                for start, end, found in labelled_spans(text)[1]:
                    key = found, windows_of(text, start, min(end, start + VALUE), end)[0]
                    shape = shape_of(text[start:end])
                    kept[key] = min(shape, kept.get(key, shape))
                    if len(kept) >= most:
                        yield rows()
                        kept.clear()
        yield rows()

    return run


# --- the network -----------------------------------------------------------------------
class Network(NamedTuple):
    """Filters (``width x 256 x filters``) over the value and over its surroundings, the output layer,
    the calibration and a threshold for each shape."""

    filters: tuple[np.ndarray, ...]
    out: np.ndarray
    bias: float
    slope: float
    offset: float
    thresholds: tuple[float, ...]


# Each filter's width and the columns of a window it sees.
_BANKS = tuple((w, part) for part in ("value", "around") for w in WIDTHS)
_COLUMNS = {
    "value": np.arange(AROUND, AROUND + VALUE),
    "around": np.concatenate((np.arange(AROUND), np.arange(AROUND + VALUE, 2 * AROUND + VALUE))),
}


def _pooled(x: np.ndarray, filters) -> tuple[np.ndarray, list[np.ndarray]]:
    """The highest sum of each filter, and where it is."""
    highest, tops = [], []
    for (width, part), weights in zip(_BANKS, filters, strict=True):
        own = x[:, _COLUMNS[part]]
        places = own.shape[1] - width + 1
        total = weights[0][own[:, :places]]
        for o in range(1, width):
            total = total + weights[o][own[:, o : o + places]]
        tops.append(total.argmax(axis=1))
        highest.append(np.take_along_axis(total, tops[-1][:, None], 1)[:, 0])
    return np.concatenate(highest, axis=1), tops


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def gradients(x: np.ndarray, y: np.ndarray, filters, out: np.ndarray, bias: float) -> tuple:
    """Of the mean logistic loss by filters, output layer and bias; through the highest places only."""
    sums, tops = _pooled(x, filters)
    hidden = np.maximum(sums, 0)
    error = (_sigmoid(hidden @ out + bias) - y) / len(y)
    back = error[:, None] * out[None, :] * (sums > 0)
    by_filter = []
    for k, ((width, part), top) in enumerate(zip(_BANKS, tops, strict=True)):
        own, g = x[:, _COLUMNS[part]], np.zeros_like(filters[k])
        each = np.arange(FILTERS)[None, :]
        for o in range(width):
            np.add.at(g[o], (np.take_along_axis(own, top + o, 1), each), back[:, k * FILTERS : (k + 1) * FILTERS])
        by_filter.append(g)
    return by_filter, hidden.T @ error, error.sum()


def logits(x: np.ndarray, filters, out: np.ndarray, bias: float) -> np.ndarray:
    return np.maximum(_pooled(x, filters)[0], 0) @ out + bias


def _arrays(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), 2 * AROUND + VALUE)


def _varied(x: np.ndarray, others: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Findings as they might also look: among the surroundings of others, cut short, in capitals."""
    x = x.copy()
    moved, short, capital = rng.random((3, len(x))) < np.array([[0.5], [0.5], [0.25]])
    moved &= len(others) > 0
    there = others[rng.integers(0, max(1, len(others)), moved.sum())]
    x[np.ix_(moved, _COLUMNS["around"])] = there[:, _COLUMNS["around"]]
    value = x[:, AROUND : AROUND + VALUE]
    sizes = np.maximum(np.count_nonzero(value, axis=1), LEAST_CANDIDATE)
    ends = np.where(short, rng.integers(LEAST_CANDIDATE, sizes + 1), VALUE)
    value[np.arange(VALUE)[None, :] >= ends[:, None]] = 0
    lower = (value >= 97) & (value <= 122) & capital[:, None]
    value[lower] -= 32
    return x


# --- training over shards ----------------------------------------------------------------
class Weights(NamedTuple):
    """Filters, output layer and bias, and the momentum of each."""

    params: list[np.ndarray]
    speed: list[np.ndarray]


_SHAPES_OF = [(w, 256, FILTERS) for w, _ in _BANKS] + [(FILTERS * len(_BANKS),), (1,)]
_SIZES = [int(np.prod(s)) for s in _SHAPES_OF]
_BLOCK_OF = 1 << 12
_SHARD = "shard int, x binary, y binary, shape binary, apart binary, own binary, others long"


def _started(rng: np.random.Generator) -> Weights:
    filters = [rng.normal(0, 0.2, s) for s in _SHAPES_OF[:-2]]
    params = [*filters, rng.normal(0, 0.1, _SHAPES_OF[-2]), np.zeros(1)]
    return Weights(params, [np.zeros_like(p) for p in params])


def _flat(weights: Weights) -> np.ndarray:
    return np.concatenate([p.ravel() for p in (*weights.params, *weights.speed)])


def _unflat(flat: np.ndarray) -> Weights:
    parts = np.split(flat, np.cumsum(_SIZES * 2)[:-1])
    shaped = [p.reshape(s).copy() for p, s in zip(parts, _SHAPES_OF * 2, strict=True)]
    return Weights(shaped[: len(_SIZES)], shaped[len(_SIZES) :])


def _logits(x: np.ndarray, weights: Weights) -> np.ndarray:
    *filters, out, bias = weights.params
    return logits(x, filters, out, bias[0])


def _epoch(x: np.ndarray, y: np.ndarray, weights: Weights, epoch: int, rng: np.random.Generator) -> Weights:
    """The weights after one epoch of stochastic gradient descent with momentum over a shard. Both kinds
    weigh the same: the rarer one is seen more often."""
    params, speed = weights
    kinds = [np.flatnonzero(y == k) for k in (0, 1)]
    others = x[kinds[0]]
    each = max(map(len, kinds))
    order = rng.permutation(np.concatenate([rng.permutation(np.resize(k, each)) for k in kinds if k.size]))
    steps = -(-len(order) // BATCH)
    for i in range(0, len(order), BATCH):
        at = order[i : i + BATCH]
        batch = np.where((y[at] == 1)[:, None], _varied(x[at], others, rng), x[at])
        by_filter, by_out, by_bias = gradients(batch, y[at], params[:-2], params[-2], params[-1][0])
        rate = 0.3 * (1 - (epoch * steps + i // BATCH) / (EPOCHS * steps))
        for param, v, g in zip(params, speed, (*by_filter, by_out, by_bias), strict=True):
            v *= 0.9
            v -= rate * g
            param += v
    return weights


class Shard(NamedTuple):
    number: int
    x: np.ndarray
    y: np.ndarray
    shape: np.ndarray
    apart: np.ndarray
    own: np.ndarray

    def kept(self, which: np.ndarray) -> Shard:
        return Shard(self.number, *[a[which] for a in self[1:]])

    def row(self) -> pa.RecordBatch:
        others = int((self.own & ~self.apart & (self.y == 0)).sum())
        types = (pa.int32(), *[pa.binary()] * 5, pa.int64())
        values = (self.number, *[a.tobytes() for a in self[1:]], others)
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, types, strict=True)],
            ["shard", "x", "y", "shape", "apart", "own", "others"],
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            number, x, y, shape, apart, own = (batch.column(c)[i].as_py() for c in range(6))
            x = np.frombuffer(x, np.uint8).reshape(-1, 2 * AROUND + VALUE)
            flags = [np.frombuffer(b, bool) for b in (apart, own)]
            yield Shard(number, x, np.frombuffer(y, float), np.frombuffer(shape, np.int32), *flags)


def _packed(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([("found", "descending"), ("h", "ascending"), ("window", "ascending")])
    column = lambda name, t: np.array(rows.column(name).to_pylist(), t)
    x = _arrays(rows.column("window").to_pylist())
    shard = Shard(
        rows.column("shard")[0].as_py(), x, column("found", float), column("shape", np.int32), column("apart", bool), column("own", bool)
    )
    return pa.Table.from_batches([shard.row()])


def shards_of(distinct: DataFrame, findings: int, others: int, candidates: int) -> DataFrame:
    """The labelled candidates dealt by hash over shards, a row each.

    Every candidate has one shard of its own; one of a kind that is too rare for all of them is also lent to
    the next ones. Every fourth candidate of a shard is apart, wherever it is lent.
    """
    n = -(-max(findings, others) // candidates)
    lent = [min(n, -(-n * min(LEAST_SHARD, candidates) // count)) for count in (findings, others)]
    home = (F.col("h") % n).alias("home")
    order = Window.partitionBy("found", "home").orderBy("h", "window")
    place = F.row_number().over(order) - 1 + F.when(F.col("found"), 0).otherwise(findings)
    dealt = (
        distinct.select("*", home)
        .withColumn("apart", place % 4 == 3)
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.when(F.col("found"), lent[0]).otherwise(lent[1]) - 1)))
        .select(
            ((F.col("home") + F.col("step")) % n).cast("int").alias("shard"),
            *("found", "window", "h", "shape", "apart"),
            (F.col("step") == 0).alias("own"),
        )
    )
    return stage(dealt.groupBy("shard").applyInArrow(_packed, _SHARD), "shards")


def _learned(weights: Weights, epoch: int, rngs: dict[int, bytes]):
    def run(batches: Iterator[pa.RecordBatch]):
        for shard in _read(batches):
            rng = pickle.loads(rngs[shard.number])
            own = shard.kept(~shard.apart)
            flat = _flat(_epoch(own.x, own.y, _unflat(_flat(weights)), epoch, rng))
            parts = [flat[i : i + _BLOCK_OF].tobytes() for i in range(0, flat.size, _BLOCK_OF)]
            # Below zero: where the shard's random numbers have come to.
            blocks = [*range(len(parts)), -1 - shard.number]
            parts.append(pickle.dumps(rng))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard.number] * len(blocks), pa.int32()), pa.array(blocks, pa.int32()), pa.array(parts, pa.binary())],
                ["shard", "block", "part"],
            )

    return run


def _mean(rows: pa.Table) -> pa.Table:
    """The mean of a block over the shards, added in their order."""
    rows = rows.sort_by("shard")
    if rows.column("block")[0].as_py() >= 0:
        total = sum(np.frombuffer(p) for p in rows.column("part").to_pylist())
        part = (total / rows.num_rows).tobytes()
    else:
        part = rows.column("part")[0].as_py()
    return pa.table({"block": rows.column("block")[:1], "part": pa.array([part], pa.binary())})


def _fitted(shards: DataFrame, rngs: dict[int, bytes]) -> tuple[Weights, dict[int, bytes]]:
    """Weights after all epochs, and the random numbers' states. In each epoch the shards learn side by side
    from the same weights, whose mean is the next epoch's."""
    rng = pickle.loads(rngs[0])
    weights = _started(rng)
    rngs = rngs | {0: pickle.dumps(rng)}
    for epoch in range(EPOCHS):
        each = shards.mapInArrow(_learned(weights, epoch, rngs), "shard int, block int, part binary")
        rows = each.groupBy("block").applyInArrow(_mean, "block int, part binary").collect()
        parts = {r["block"]: bytes(r["part"]) for r in rows}
        weights = _unflat(np.frombuffer(b"".join(parts[b] for b in sorted(parts) if b >= 0)))
        rngs = {-1 - b: part for b, part in parts.items() if b < 0}
    return weights, rngs


def _sure(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]):
        for shard in _read(batches):
            yield shard.kept((shard.y == 1) | (_sigmoid(_logits(shard.x, weights)) < UNSURE)).row()

    return run


def _judged(weights: Weights, rngs: dict[int, bytes]):
    """Logit, label and shape of the candidates kept apart, each in its own shard."""

    def run(batches: Iterator[pa.RecordBatch]):
        for shard in _read(batches):
            seen = shard.kept(shard.apart & shard.own)
            others = shard.x[~shard.apart & (shard.y == 0)]
            varied = _varied(seen.x, others, pickle.loads(rngs[shard.number]))
            z = _logits(np.where((seen.y == 1)[:, None], varied, seen.x), weights)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard.number], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in (z, seen.y, seen.shape)]],
                ["shard", "z", "y", "shape"],
            )

    return run


def _judged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for shard, z, y, shape in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield shard, np.frombuffer(z), np.frombuffer(y), np.frombuffer(shape, np.int32)


def train(shards: DataFrame) -> Network | None:
    """A network from the labelled candidates of :func:`shards_of`; None if the other kind is too rare.

    Candidates that no pattern found may be secrets all the same. A first network tells those that look
    like findings; they are left out, and the network is fitted again to the others.
    """
    numbers = [r["shard"] for r in shards.select("shard").collect()]
    rngs = {n: pickle.dumps(np.random.default_rng([SEED, n] if n else SEED)) for n in {0, *numbers}}
    first, rngs = _fitted(shards, rngs)
    sure = stage(shards.mapInArrow(_sure(first), _SHARD), "sure")
    if sure.agg(F.sum("others")).first()[0] < LEAST_EACH // 2:
        return None
    weights, rngs = _fitted(sure, rngs)
    judged = stage(sure.mapInArrow(_judged(weights, rngs), "shard int, z binary, y binary, shape binary"), "judged")
    slope, offset = _calibrated(judged)
    *filters, out, bias = weights.params
    return Network(
        tuple(f.astype(np.float32) for f in filters), out.astype(np.float32), float(bias[0]), slope, offset, _thresholds(judged, slope, offset)
    )


def _newton(w: np.ndarray):
    """A shard's part of the gradient and of the second derivatives."""

    def run(batches: Iterator[pa.RecordBatch]):
        for shard, z, y, _ in _judged_rows(batches):
            features = np.stack((z, np.ones_like(z)))
            p = _sigmoid(w @ features)
            sums = [*(features @ (p - y)), *((features * (p * (1 - p))) @ features.T).ravel()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([sums], pa.list_(pa.float64()))], ["shard", "sums"]
            )

    return run


def _calibrated(judged: DataFrame) -> tuple[float, float]:
    """Slope and offset that map logits to probabilities: logistic regression with a small ridge."""
    w = np.array([1.0, 0.0])
    for _ in range(50):
        rows = judged.mapInArrow(_newton(w), "shard int, sums array<double>").collect()
        sums = sum(np.array(r["sums"]) for r in sorted(rows, key=lambda r: r["shard"]))
        grad = sums[:2] + np.array([0.01 * (w[0] - 1), 0.01 * w[1]])
        step = np.linalg.solve(sums[2:].reshape(2, 2) + 0.01 * np.eye(2), grad)
        w -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def _thresholds(judged: DataFrame, slope: float, offset: float) -> tuple[float, ...]:
    """For each shape the highest threshold that keeps ``RECALL`` of its findings, 0.5 at least; a shape
    with few findings takes the threshold of all."""

    def findings(batches: Iterator[pa.RecordBatch]):
        for _, z, y, shape in _judged_rows(batches):
            p = _sigmoid(slope * z + offset)
            yield pa.RecordBatch.from_arrays([pa.array(shape[y == 1]), pa.array(p[y == 1])], ["shape", "p"])

    found = stage(judged.mapInArrow(findings, "shape int, p double"), "findings")
    counts = {r["shape"]: r["count"] for r in found.groupBy("shape").count().collect()}

    def least(rows: DataFrame, count: int) -> float:
        at = rows.orderBy("p").offset(int((1 - RECALL) * count)).limit(1).first() if count else None
        return float(max(0.5, at["p"])) if at else 0.5

    of_all = least(found, sum(counts.values()))
    own = lambda s: least(found.filter(F.col("shape") == s), counts[s])
    return tuple(own(s) if counts.get(s, 0) >= LEAST_EACH else of_all for s in range(len(SHAPES)))


def fit(docs: DataFrame, candidates: int = TRAIN_CANDIDATES) -> Network | None:
    """A network from all labelled candidates of ``text``, in shards of about ``candidates`` of either kind;
    None if a kind is too rare.

    Candidates alike in value and surroundings count once, so one that is copied without end takes one place.
    """
    texts = docs.select(text_of().cast("binary").alias("text"))
    each = texts.mapInArrow(_labelled(4 * TRAIN_CANDIDATES), "found boolean, window binary, h long, shape int")
    distinct = stage(each.groupBy("found", "window").agg(F.min("h").alias("h"), F.min("shape").alias("shape")), "labelled")
    counts = {r["found"]: r["count"] for r in distinct.groupBy("found").count().collect()}
    findings, others = counts.get(True, 0), counts.get(False, 0)
    if min(findings, others) < LEAST_EACH:
        return None
    return train(shards_of(distinct, findings, others, candidates))


# --- findings --------------------------------------------------------------------------
_SPANS = "array<struct<start:long,kind:int,end:long>>"
_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_BLOCK = 512


def network_spans(text: bytes, candidates: Iterator[tuple[int, int, bool]], net: Network) -> list[tuple[int, int, int]]:
    """The candidates without a label that the network takes for secrets, in blocks of windows."""
    found: list[tuple[int, int, int]] = []
    block: list[tuple[int, int]] = []
    windows: list[bytes] = []
    each: list[int] = []

    def score() -> None:
        if not windows:
            return
        z = np.concatenate(
            [logits(_arrays(windows[i : i + _BLOCK]), net.filters, net.out, net.bias) for i in range(0, len(windows), _BLOCK)]
        )
        firsts = np.cumsum([0, *each])[:-1]
        p = _sigmoid(net.slope * np.maximum.reduceat(z, firsts) + net.offset)
        for (start, end), score_of in zip(block, p.tolist(), strict=True):
            if score_of >= net.thresholds[shape_of(text[start:end])]:
                found.append((start, KINDS.index("network"), end))
        block.clear(), windows.clear(), each.clear()

    for start, end, labelled in candidates:
        if not labelled:
            own = windows_of(text, start, end, end)
            block.append((start, end))
            windows.extend(own)
            each.append(len(own))
            if len(windows) >= _BLOCK:
                score()
    score()
    return found


def _found(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            columns: tuple[list, list] = ([], [])
            for text in batch.column("text").to_pylist():
                base, candidates = labelled_spans(text)
                added = network_spans(text, candidates, net) if net else []
                spans = [*base, *added]
                at = _points(text, [p for s, _, e in spans for p in (s, e)])
                rows = [{"start": at[2 * i], "kind": k, "end": at[2 * i + 1]} for i, (_, k, _) in enumerate(spans)]
                columns[0].append(rows[: len(base)])
                columns[1].append(rows[len(base) :])
            made = [pa.array(c, pa.list_(_SPAN)) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", "base", "added"])

    return run


def find_secrets(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id, base, added`` of every row of ``doc_id, text``: spans ``start, kind, end`` in code points.

    ``base`` are the fixed patterns' findings by start and kind; ``kind`` is a place in ``KINDS``.
    ``added`` are candidates that no pattern touches and that ``net`` (see :func:`fit`) takes for secrets;
    without a network there are none. Whole texts are scanned; null ones count as empty; repeated rows are
    scanned each; an empty table gives no rows; further columns are ignored.
    """
    rows = docs.select("doc_id", text_of().cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_found(net), f"doc_id {kind}, base {_SPANS}, added {_SPANS}")


def spans_text(spans):
    """Spans as ``kind:start:end`` by start and kind, joined by commas."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")
