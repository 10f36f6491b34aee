"""Rolling 64-bit hashes of words, word runs and byte runs over whole arrays.

A run's hash is a difference of two prefix sums, times an inverse power, so
every run of a text is hashed in a few array passes. Hashes depend on content
only, hence agree between documents, tasks and executors.
"""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_IDX_BITS = 31  # positions within one text: a string column holds no longer one
_IDX = _U((1 << _IDX_BITS) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LONG = 32
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS.get("up", ())) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, _U)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def _prefix(values: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    inside = ~_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edges[0::2], edges[1::2]


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span of a text."""
    sums = _prefix(_BYTE[np.frombuffer(data, np.uint8)])
    return mix((sums[ends] - sums[starts]) * _powers(len(data) + 1)[1][starts])


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hashes`` for words that must differ if their hashes do; words over ``LONG`` bytes by XXH3.

    Prefix sums modulo 2**64 give the same hash to certain texts of a thousand
    letters and more, whatever the base.
    """
    out = span_hashes(data, starts, ends)
    for n in np.flatnonzero(ends - starts > LONG).tolist():
        out[n] = xxhash.xxh3_64_intdigest(data[starts[n] : ends[n]])
    return out


def byte_values(data: bytes) -> np.ndarray:
    return _BYTE[np.frombuffer(data, np.uint8)]


def run_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values; empty when there are fewer."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    sums = _prefix(values)
    return mix((sums[k:] - sums[:-k]) * _powers(len(values) + 1)[1][:n])


def minimizers(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each ``window`` consecutive hashes, where the leftmost smallest stands.

    Returns the distinct places and, for each window, the index of its place
    among them. Places follow from the window's content alone: equal windows of
    two texts choose the same place within them.
    """
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = (hashes & ~_IDX) | np.arange(len(hashes), dtype=_U)
    step = 1
    while 2 * step <= window:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < window:
        rest = window - step
        low = np.minimum(low[:-rest], low[rest:])
    at = (low & _IDX).astype(np.int64)
    new = np.flatnonzero(np.diff(at, prepend=-1))
    return at[new], np.repeat(np.arange(len(new)), np.diff(new, append=n))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Boolean mask of 0..n-1 covered by half-open spans."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0
