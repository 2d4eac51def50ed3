"""Words of UTF-8 texts as numpy arrays."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20_240).integers(1, 1 << 63, 256, dtype=np.uint64)
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xF1357AEA2E62A9C5)


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in UTF-8 bytes; words are parted by ASCII white space."""
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def run_hashes(values: np.ndarray, first: np.ndarray, after: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of ``values[first:after]`` for each pair; it depends on those values alone."""
    n = values.size
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(base, n), out=sums[1:])
    return mix((sums[after] - sums[first]) * _powers(pow(base, -1, 1 << 64), n + 1)[first])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    return run_hashes(_BYTE[data], starts, ends, BASES[0])
