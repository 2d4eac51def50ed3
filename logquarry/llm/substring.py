"""Exact substring dedup by fixed-block anchors.

Every document is cut into non-overlapping blocks of ``(window + 1) // 2`` words; these are the
index. Every run of that many words, rolling word by word, probes it. A repeat of ``window``
words holds a whole block in either copy, so each repeat is hit. Hits are extended to all full
windows around them, and a window is a repeat when its 96-bit hash occurs more than once.

Hashes of a group of texts (about 4 MB) meet in the group first. What repeats there is known
without anyone else, and one entry stands for it outside, so a passage that is everywhere costs
one entry a group. Entries travel in packed rows, one for each group and bucket of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import GROUP_BYTES, stage, text_of
from logquarry.llm.words import BASES, is_space, mix, run_hashes, span_hashes, word_spans

WINDOW = 35
# Buckets of hashes are as many as leave the words of this many text bytes to each.
BUCKET_TEXT_BYTES = 8 << 20
PIECE_WORDS = 600_000


# --- hashes ----------------------------------------------------------------------------
def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, taken over pieces of the text so that memory stays bounded."""
    found, at = [], 0
    while at < len(text):
        end = min(at + GROUP_BYTES, len(text))
        if end < len(text):
            # A piece ends before white space, or where the text has none, with it.
            data = np.frombuffer(text, np.uint8, GROUP_BYTES, at)
            spaces = np.flatnonzero(is_space(data))
            if spaces.size:
                end = at + int(spaces[-1])
            else:
                rest = np.flatnonzero(is_space(np.frombuffer(text, np.uint8, -1, end)))
                end = end + int(rest[0]) if rest.size else len(text)
        data = np.frombuffer(text, np.uint8, end - at, at)
        starts, ends = word_spans(data)
        if starts.size:
            found.append(span_hashes(data, starts, ends))
        at = max(end, at + 1)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


# --- groups of documents ---------------------------------------------------------------
# A group is an array of word hashes with, for each part, its document and the number of its first
# word there. Only documents of over PIECE_WORDS words have several parts; these share the words
# of the windows that begin in the earlier one.
def _groups(rows: Iterator[tuple], window: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """``(parts, hashes, starts)`` from rows of (document key, word hashes, extra)."""
    parts, held, words = [], [], 0
    for key, hashes, extra in rows:
        for at in range(0, max(1, hashes.size - window + 1), PIECE_WORDS):
            piece = hashes[at : at + PIECE_WORDS + window - 1]
            if held and words + piece.size > PIECE_WORDS + window:
                yield parts, np.concatenate(held), np.cumsum([0] + [h.size for h in held])
                parts, held, words = [], [], 0
            parts.append((key, at, extra))
            held.append(piece)
            words += piece.size
    if held:
        yield parts, np.concatenate(held), np.cumsum([0] + [h.size for h in held])


def _windows(starts: np.ndarray, words: int) -> np.ndarray:
    """Places in a group where a run of ``words`` words begins that lies in one part."""
    last = np.repeat(starts[1:], np.diff(starts)) - words
    place = np.arange(starts[-1])
    return place[place <= last]


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Bytes of equal weight side by side: those that are zero then compress away."""
    flat = values.astype(kind)
    return flat.view(np.uint8).reshape(flat.size, flat.itemsize).T.tobytes()


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


_FIELDS = [
    ("bucket", pa.int32()),
    ("grp", pa.int64()),
    ("parts", pa.binary()),  # of the group itself: ids, text hashes, first words, starts
    ("hits", pa.binary()),  # places of the group that repeat
    ("places", pa.binary()),  # entries: places, and below their hashes
    ("low", pa.binary()),
    ("high", pa.binary()),
    ("indexed", pa.binary()),
]
_ROWS = "bucket int, grp long, parts binary, hits binary, places binary, low binary, high binary, indexed binary"
_HITS = "grp long, parts binary, hits binary"


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(n) for r in rows], kind) for n, kind in _FIELDS], [n for n, _ in _FIELDS]
    )


def _group_rows(parts, starts, place, low, high, indexed, buckets) -> list[dict]:
    """The rows that a group sends. ``indexed`` (or None: all) marks places that are index blocks;
    a class of equal hashes without any is no hit."""
    keys = np.array([(-1 if k[0] is None else k[0], k[1], at) for k, at, _ in parts], np.int64)
    head = np.concatenate((keys.ravel(), starts.astype(np.int64))).tobytes()
    name = int.from_bytes(hashlib.blake2b(head, digest_size=8).digest(), "little", signed=True)
    rows = [{"bucket": name % buckets, "grp": name, "parts": head}]
    if not place.size:
        return rows
    order = np.argsort(low, kind="stable") if high is None else np.lexsort((high, low))
    same = low[order][1:] == low[order][:-1]
    if high is not None:
        same &= high[order][1:] == high[order][:-1]
    first = np.concatenate(([True], ~same))
    many = np.concatenate((same, [False])) | ~first
    block = np.ones(low.size, bool)
    if indexed is not None:
        at = np.flatnonzero(first)
        block = np.repeat(np.logical_or.reduceat(indexed[order], at), np.diff(np.append(at, low.size)))
    hits = np.sort(place[order[many & block]])
    if hits.size:
        rows[0]["hits"] = _planes(np.diff(hits, prepend=0), "<u4")
    mark = np.zeros(low.size, bool)
    mark[order] = block
    kept = np.sort(order[first])
    bucket = low[kept] % np.uint64(buckets)
    by_bucket = np.argsort(bucket.astype(np.int32), kind="stable")
    kept, bucket = kept[by_bucket], bucket[by_bucket]
    for one in np.split(np.arange(kept.size), np.flatnonzero(np.diff(bucket)) + 1):
        own = kept[one]
        rest = low[own] // np.uint64(buckets)
        rows.append(
            {
                "bucket": int(bucket[one[0]]),
                "grp": name,
                "places": _planes(np.diff(place[own], prepend=0), "<u4"),
                # A block probe is settled later by the window's hash, so 32 bits beside the bucket do.
                "low": rest.astype("<u4" if high is None else "<u8").tobytes(),
                "high": None if high is None else high[own].astype("<u4").tobytes(),
                "indexed": None if indexed is None else np.packbits(mark[own]).tobytes(),
            }
        )
    return rows


def _block_rows(window: int, buckets: int):
    block = (window + 1) // 2

    def texts(batches):
        for batch in batches:
            for doc_id, text_hash, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = word_hashes(text)
                if hashes.size >= window:
                    yield (doc_id, text_hash), hashes, None

    def run(batches):
        for parts, hashes, starts in _groups(texts(batches), window):
            place = _windows(starts, block)
            low = run_hashes(hashes, place, place + block, BASES[1])
            own = np.repeat(starts[:-1], np.diff(starts))[place]
            offsets = np.repeat([at for _, at, _ in parts], np.diff(starts))[place]
            indexed = (place - own + offsets) % block == 0
            yield _batch(_group_rows(parts, starts, place, low, None, indexed, buckets))

    return run


def _window_rows(window: int, buckets: int):
    block = (window + 1) // 2

    def texts(batches):
        for batch in batches:
            cols = (batch.column(n).to_pylist() for n in ("doc_id", "text_hash", "text", "words"))
            for doc_id, text_hash, text, words in zip(*cols, strict=True):
                yield (doc_id, text_hash), word_hashes(text), np.frombuffer(words, "<i8")

    def run(batches):
        for parts, hashes, starts in _groups(texts(batches), window):
            near = np.zeros(hashes.size + 1, np.int64)
            for (_, at, words), start, end in zip(parts, starts[:-1], starts[1:], strict=True):
                # Windows that begin up to window - block words before a hit hold its block.
                from_word = np.clip(words - at - (window - block), 0, end - start)
                to_word = np.clip(words - at + 1, 0, end - start)
                np.add.at(near, start + from_word, 1)
                np.subtract.at(near, start + to_word, 1)
            place = _windows(starts, window)
            place = place[np.cumsum(near)[place] > 0]
            low = run_hashes(hashes, place, place + window, BASES[1])
            high = run_hashes(mix(hashes), place, place + window, BASES[2]) >> np.uint64(32)
            yield _batch(_group_rows(parts, starts, place, low, high, None, buckets))

    return run


def _matched(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of one bucket: the entries whose hash other entries have too, and the groups' own rows."""
    rows = table.to_pylist()
    out = [(r["grp"], r["parts"], r["hits"]) for r in rows if r["parts"] is not None]
    rows = [r for r in rows if r["places"] is not None]
    if rows:
        strong = rows[0]["high"] is not None
        low = np.concatenate([np.frombuffer(r["low"], "<u8" if strong else "<u4") for r in rows])
        sizes = [len(r["low"]) // (8 if strong else 4) for r in rows]
        order = np.argsort(low, kind="stable")
        if strong:
            high = np.concatenate([np.frombuffer(r["high"], "<u4") for r in rows])
            order = np.lexsort((high, low))
        same = low[order][1:] == low[order][:-1]
        if strong:
            same &= high[order][1:] == high[order][:-1]
        first = np.concatenate(([True], ~same))
        hit = np.concatenate((same, [False])) | ~first
        if not strong:
            marks = np.concatenate(
                [np.unpackbits(np.frombuffer(r["indexed"], np.uint8), count=n) for r, n in zip(rows, sizes, strict=True)]
            ).astype(bool)
            at = np.flatnonzero(first)
            hit &= np.repeat(np.logical_or.reduceat(marks[order], at), np.diff(np.append(at, low.size)))
        found = np.zeros(low.size, bool)
        found[order] = hit
        for row, mine in zip(rows, np.split(found, np.cumsum(sizes)[:-1]), strict=True):
            if mine.any():
                places = np.cumsum(_unplanes(row["places"], "<u4").astype(np.int64))[mine]
                out.append((row["grp"], None, _planes(np.diff(places, prepend=0), "<u4")))
    return pa.table(
        {
            "grp": pa.array([r[0] for r in out], pa.int64()),
            "parts": pa.array([r[1] for r in out], pa.binary()),
            "hits": pa.array([r[2] for r in out], pa.binary()),
        }
    )


def _spread(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of one group: each document's hit words. An entry that stood for others of its group is
    among the group's own hits, and so are they."""

    rows = table.to_pylist()
    head = np.frombuffer(next(r["parts"] for r in rows if r["parts"] is not None), np.int64)
    n = (head.size - 1) // 4
    keys, starts = head[: 3 * n].reshape(n, 3), head[3 * n :]
    hits = [np.cumsum(_unplanes(r["hits"], "<u4").astype(np.int64)) for r in rows if r["hits"] is not None]
    places = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
    part = np.searchsorted(starts, places, side="right") - 1
    out: dict[tuple, list] = {}
    for mine in np.split(np.arange(places.size), np.flatnonzero(np.diff(part)) + 1):
        if mine.size:
            doc_id, text_hash, at = keys[part[mine[0]]].tolist()
            out.setdefault((doc_id, text_hash), []).append(places[mine] - starts[part[mine[0]]] + at)
    return pa.table(
        {
            "doc_key": pa.array([k[0] for k in out], pa.int64()),
            "text_hash": pa.array([k[1] for k in out], pa.int64()),
            "words": pa.array([np.unique(np.concatenate(w)).astype("<i8").tobytes() for w in out.values()], pa.binary()),
        }
    )


def _repeats(rows: DataFrame) -> DataFrame:
    """``doc_key, text_hash, words``: the words where something begins that occurs elsewhere too."""
    grouped = rows.groupBy("bucket").applyInArrow(_matched, _HITS)
    spread = grouped.groupBy("grp").applyInArrow(
        _spread, "doc_key long, text_hash long, words binary"
    )
    # Only a document in several pieces has more than one row.
    return spread.groupBy("doc_key", "text_hash").agg(
        F.array_join(F.transform(F.collect_list("words"), lambda w: F.hex(w)), "").alias("hex")
    ).select("doc_key", "text_hash", F.unhex("hex").alias("words"))


# --- removal ---------------------------------------------------------------------------
def _removed(window: int):
    def run(batches):
        for batch in batches:
            cols = (batch.column(n).to_pylist() for n in ("text", "words"))
            out = [_kept(text, words, window) for text, words in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([o[2].decode("utf-8", "replace") for o in out], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def _kept(text: bytes, words: bytes | None, window: int) -> tuple[int, int, bytes]:
    data = np.frombuffer(text + b" ", np.uint8)
    starts, ends = word_spans(data)
    gone = np.zeros(starts.size + 1, np.int64)
    if words:
        begins = np.frombuffer(words, "<i8")
        np.add.at(gone, begins, 1)
        np.subtract.at(gone, np.minimum(begins + window, starts.size), 1)
    kept = np.cumsum(gone)[:-1] == 0
    edge = np.zeros(data.size + 1, np.int8)
    edge[starts[kept]] += 1
    edge[ends[kept] + 1] -= 1  # with the white space behind the word
    out = data.copy()
    out[ends] = 32
    joined = out[np.cumsum(edge[:-1], dtype=np.int8) > 0].tobytes()
    return starts.size, int(starts.size - kept.sum()), joined[:-1]


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Remove every word under a window of ``window`` words that also begins anywhere else.

    Returns ``doc_id, n_words, n_removed, kept_text`` per row of ``doc_id, text``; the kept words are
    joined by single spaces. Windows are judged on the input. Words are compared unchanged; null
    text has none; a document of fewer than ``window`` words keeps them all. Rows that repeat an
    id or a text are documents of their own, whose windows count each time. An empty table gives
    no rows; further columns are ignored.
    """
    keyed = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_key"),
        F.xxhash64(text_of()).alias("text_hash"),
        text_of().cast("binary").alias("text"),
    )
    total = docs.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0
    buckets = max(1, int(-(-total // BUCKET_TEXT_BYTES)))
    probes = keyed.select("doc_id", "text_hash", "text").mapInArrow(_block_rows(window, buckets), _ROWS)
    hits = stage(_repeats(probes), "anchor-hits")

    key = ["doc_key", "text_hash"]
    # Both joins below shuffle the same texts; Spark runs that exchange once.
    extended = keyed.join(hits, key).mapInArrow(_window_rows(window, buckets), _ROWS)
    repeats = _repeats(extended)
    return keyed.join(repeats, key, "left").mapInArrow(
        _removed(window), "doc_id long, n_words long, n_removed long, kept_text string"
    )
