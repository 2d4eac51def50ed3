"""Tokenising documents and packing them into windows by best-fit decreasing."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logquarry.llm.common import GROUP_BYTES, groups_of, stage, text_of
from logquarry.llm.words import span_hashes, word_spans

WINDOW = 4096
END_ID = 2
PIECES_PER_GROUP = 100_000
# A task that remembers more encoded words than this forgets those not in use; about 50 bytes each.
REMEMBERED_WORDS = 400_000

# Fixed values of the tokenizer file: its word end, and its splitting pattern.
_WORD_END = "</w>"
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Printable ASCII but for "<", which may begin a special token, and Latin letters: composed
# already, lower-cased letter by letter.
_PLAIN = re.compile("[\n\x21-\x3b\x3d-\x7e¡-ɏ]+")
# The splitting pattern over such text, and the newline between words.
_LETTERS = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_OTHERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_FIND = re.compile(
    f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_OTHERS}]|[^\\s{_LETTERS}{_OTHERS}]+"
).findall


class WordEncoder:
    """Ids of texts, the same as the tokenizer file gives through ``tokenizers``.

    White space always parts tokens in such a file, so each distinct word of a group of texts is
    encoded once, and remembered by its 64-bit hash. Plain words go through a byte-pair encoder
    built from the same merges, with the word's end as one more byte; all others, and files of
    another kind, through ``tokenizers`` itself.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_WORDS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        model = spec["model"]
        splits = [p.get("pattern", {}).get("Regex") for p in spec["pre_tokenizer"].get("pretokenizers", [])]
        self.words_apart = model.get("end_of_word_suffix") == _WORD_END and splits[:1] == [_SPLIT]
        if self.words_apart:
            self.bpe, self.id_of, self.between = _byte_pairs(model)
        # Hashes in order; where each one's ids begin in ``ids``, and how many they are.
        self.hashes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.begins, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin (and the last ends)."""
        if not self.words_apart:
            found = [self._plainly(t.decode("utf-8", "replace")) for t in texts]
            return np.concatenate([*found, np.zeros(0, np.uint32)]), np.cumsum([0, *map(len, found)])
        joined = b" ".join(texts)
        data = np.frombuffer(joined, np.uint8)
        starts, ends = word_spans(data)
        if not starts.size:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        hashes, first, word = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = self._places(hashes)
        known = self.hashes[at] == hashes if self.hashes.size else np.zeros(hashes.size, bool)
        new = first[~known]
        if new.size:
            spans = zip(starts[new].tolist(), ends[new].tolist(), strict=True)
            self._remember(hashes, known, at, self._learn([joined[s:e] for s, e in spans]))
            at = self._places(hashes)
        counts = self.counts[at][word]
        before = np.concatenate(([0], np.cumsum(counts)))
        ids = self.ids[np.repeat(self.begins[at][word] - before[:-1], counts) + np.arange(before[-1])]
        text_starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return ids, before[np.searchsorted(starts, text_starts)]

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.hashes, hashes), max(0, self.hashes.size - 1))

    def _remember(self, hashes, known, at, learned: list[np.ndarray]) -> None:
        """Add the words not ``known``; of those before, only the group's own stay when there are many."""
        old = np.arange(self.hashes.size)
        if old.size > self.remembered:
            old = at[known]
        begins, counts = self.begins[old], self.counts[old]
        kept = self.ids
        if old.size < self.hashes.size:
            before = np.cumsum(counts) - counts
            kept = self.ids[np.repeat(begins - before, counts) + np.arange(counts.sum())]
            begins = before
        more = np.fromiter(map(len, learned), np.int64, len(learned))
        self.ids = np.concatenate([kept, *learned])
        every = np.concatenate((self.hashes[old], hashes[~known]))
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.begins = np.concatenate((begins, kept.size + np.cumsum(more) - more))[order]
        self.counts = np.concatenate((counts, more))[order]

    def _plainly(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word."""
        lines = b"\n".join(words).decode("utf-8", "replace")
        odd: dict[int, np.ndarray] = {}
        if not _PLAIN.fullmatch(lines):
            texts = [w.decode("utf-8", "replace") for w in words]
            odd = {i: self._plainly(t) for i, t in enumerate(texts) if not _PLAIN.fullmatch(t)}
            lines = "\n".join(t for i, t in enumerate(texts) if i not in odd)
        if not lines:
            return list(odd.values())
        # Pieces end with a newline each; between two words stands one more, a piece of its own.
        ranks = self.bpe.encode_to_numpy("\n".join(_FIND(lines.lower())) + "\n", disallowed_special=())
        between = np.flatnonzero(ranks == self.between)
        ids = self.id_of[ranks]
        plain = iter(ids[s:e] for s, e in zip([0, *(between + 1).tolist()], [*between.tolist(), ids.size], strict=True))
        return [odd[i] if i in odd else next(plain) for i in range(len(words))]


def _byte_pairs(model: dict):
    """A byte-pair encoder of newline-ended pieces, the id of each rank, and the rank of the
    newline piece that stands between words (words hold no newline, so it has no other use).

    A word's last byte and its end are joined first of all, then pairs in the order of the merges.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def raw(token: str) -> bytes:
        ended = token.endswith(_WORD_END)
        body = token.removesuffix(_WORD_END) if ended else token
        return bytes(letters[c] for c in body) + (b"\n" if ended else b"")

    merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocab = model["vocab"]
    order = [c + _WORD_END for c in letters] + list(letters) + ["".join(m) for m in merged]
    order = [t for t in dict.fromkeys(order) if t in vocab]
    ranks = {raw(t): i for i, t in enumerate(order)}
    bpe = tiktoken.Encoding("pieces", pat_str=r"[^\n]+\n|\n\n", mergeable_ranks=ranks, special_tokens={})
    return bpe, np.array([vocab[t] for t in order], "<u4"), ranks[b"\n\n"]


def _slices(text: bytes) -> Iterator[bytes]:
    """The text in parts of about GROUP_BYTES, cut before white space."""
    space = re.compile(rb"[\x20\x09-\x0d]")
    at = 0
    while at < len(text):
        cut = space.search(text, at + GROUP_BYTES)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _tokenised(path: str, window: int, end_id: int, with_ids: bool):
    end = np.array([end_id], np.uint32)

    def pieces_of(encode, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text in full windows and a rest."""
        if len(texts) > 1 or len(texts[0]) <= GROUP_BYTES:
            ids, starts = encode(texts)
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                own = np.concatenate((ids[s:e], end))
                yield [own[i : i + window] for i in range(0, own.size, window)]
            return
        own, held = [], np.zeros(0, np.uint32)
        for part in _slices(texts[0]):
            held = np.concatenate((held, encode([part])[0]))
            full = held.size // window * window
            own += np.split(held[:full].copy(), range(window, full, window)) if full else []
            held = held[full:]
        held = np.concatenate((held, end))
        yield own + [held[i : i + window] for i in range(0, held.size, window)]

    def run(batches):
        encode = WordEncoder(path).encode
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            rows: list[tuple] = []
            for group, group_texts in groups_of(ids, texts):
                for doc_id, own in zip(group, pieces_of(encode, group_texts), strict=True):
                    tokens = sum(piece.size for piece in own)
                    for i, piece in enumerate(own):
                        data = piece.astype("<u4").tobytes()
                        row = (doc_id, i * window, piece.size, zlib.crc32(data), tokens)
                        rows.append((*row, data) if with_ids else row)
            columns = list(zip(*rows, strict=True)) or [()] * (6 if with_ids else 5)
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            arrays += [pa.array(c, pa.binary()) for c in columns[5:]]
            names = [*(f.split()[0] for f in _PIECES.split(", ")), "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return run


class CapacityTree:
    """How many open windows have each remaining capacity; finds the tightest that fits."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        node = capacity + self.leaves
        while node:
            self.counts[node] += n
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least capacity of an open window that is at least ``length``."""
        node = length + self.leaves
        if self.counts[node]:
            return length
        while node > 1:
            if not node & 1 and self.counts[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.counts[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece, for pieces in order of falling length."""
    tree, open_windows = CapacityTree(window), {}
    windows, offsets, used = [], [], 0
    for length in lengths:
        capacity = tree.tightest(length)
        if capacity is None:
            number, capacity, used = used, window, used + 1
        else:
            tree.add(capacity, -1)
            number = open_windows[capacity].pop()
        windows.append(number)
        offsets.append(window - capacity)
        if capacity > length:
            tree.add(capacity - length, 1)
            open_windows.setdefault(capacity - length, []).append(number)
    return windows, offsets


def _packed(window: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        windows, offsets = best_fit_decreasing(table.column("length").to_pylist(), window)
        first = key[0].as_py() << 32
        return (
            table.drop_columns(["pack_group"])
            .append_column("sequence_id", pa.array([first + w for w in windows], pa.int64()))
            .append_column("offset", pa.array(offsets, pa.int64()))
        )

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = False,
    pieces_per_group: int = PIECES_PER_GROUP,
) -> DataFrame:
    """Pack the rows of ``doc_id, text`` into sequences of at most ``window`` tokens.

    Returns a row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``,
    and ``ids`` (little-endian unsigned 32-bit) where asked for. A document's tokens end with
    ``end_id``. Longer ones are cut into full windows and a rest. Pieces are dealt evenly to groups
    of about ``pieces_per_group``, and each group is packed by best-fit decreasing, so no task holds more.
    A group holds lengths only; ids meet their places afterwards, in a join by the piece's number.

    Null or empty text is the end id alone. Ties go by id and start; rows that repeat an id are
    packed each for itself. An empty table gives no rows; further columns are ignored.
    """
    schema = _PIECES + (", ids binary" if with_ids else "")
    pieces = docs.select(F.col("doc_id").cast("long"), text_of().cast("binary").alias("text")).mapInArrow(
        _tokenised(tokenizer_path, window, end_id, with_ids), schema
    )
    if with_ids:
        pieces = pieces.withColumn("piece", F.monotonically_increasing_id())
    pieces = stage(pieces, "pieces")
    groups = max(1, -(-pieces.count() // pieces_per_group))
    # Dealt by row and not by id, as one id may repeat without end.
    number = F.col("piece") if with_ids else F.monotonically_increasing_id()
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64(number), F.lit(groups)))
    placed = dealt.drop("ids").groupBy("pack_group").applyInArrow(
        _packed(window), _PIECES + (", piece long" if with_ids else "") + ", sequence_id long, offset long"
    )
    if not with_ids:
        return placed
    places = stage(placed.select("piece", "sequence_id", "offset"), "places")
    columns = [f.split()[0] for f in schema.split(", ")]
    return pieces.join(places.hint("merge"), "piece").select(*columns, "sequence_id", "offset")
