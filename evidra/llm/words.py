"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

import ctypes

import numpy as np

_rng = np.random.default_rng(20240229)
#: A random value for each byte, and an odd multiplier for places.
_BYTE = _rng.integers(1, 2**64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: White space is 0x20 and 0x09-0x0D; A-Z count as a-z.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
LOWER_BYTE = _BYTE[_LOWER]
#: 0 white space, 1 letters, digits, underscore and non-ASCII bytes, 2 other signs.
KIND = np.full(256, 2, np.uint8)
KIND[SPACE] = 0
KIND[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = 1
WORD_KIND = (~SPACE).astype(np.uint8)

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        n = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            a = np.full(n, base)
            a[0] = 1
            _powers[name] = np.cumprod(a)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def split(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray = WORD_KIND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """starts, ends (byte places) of the words of the texts data[bounds[i]:bounds[i+1]], and each text's first word.

    A word is a longest run of bytes of one kind other than 0.
    """
    k = kind[data]
    edge = np.empty(len(k) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(k[1:], k[:-1], out=edge[1:-1])
    edge[bounds] = True
    at = np.flatnonzero(edge)
    at_kind = k[at[:-1]] != 0 if len(k) else np.zeros(0, bool)
    starts, ends = at[:-1][at_kind], at[1:][at_kind]
    return starts, ends, np.searchsorted(starts, bounds)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(LOWER_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def shingles(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of `width` words within a text, and each text's first; a shorter text with words is one run."""
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    begin = np.concatenate([[0], np.cumsum(count)])
    if not begin[-1]:
        return np.zeros(0, np.uint64), begin
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], count)
    size = np.repeat(np.minimum(n, width), count)
    out = mix(size.astype(np.uint64) * _BASE)
    for i in range(width):
        there = i < size
        step = mix(out * _BASE + h[np.where(there, at + i, at)])
        out = step if there.all() else np.where(there, step, out)
    return out, begin


def digests(x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each run x[begin[i]:end[i]], wherever it lies."""
    up, down = _power(len(x) + 1)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * up[: len(x)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def texts(batch_column, limit: int = (1 << 19) - 64):
    """(first row, last row, bytes, bounds) of an Arrow string column, cut at about `limit` bytes, half a megabyte by default; null is empty."""
    import pyarrow as pa

    col = batch_column.cast(pa.large_string()).fill_null("")
    if not len(col):
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: Python workers stay when a stage is over, and what they keep counts as their executor's."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
