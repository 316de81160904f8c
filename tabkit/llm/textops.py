"""Vectorised text primitives for Arrow batches (NumPy, inside tasks).

Texts are handled as one flat UTF-8 byte buffer with row offsets. Word,
line and window hashes are 64-bit and the same on every machine. All
functions treat a null text as an empty one.
"""

from __future__ import annotations

import numpy as np

# Bytes of text worked on at a time (a single longer row is taken whole).
CHUNK_BYTES = 2 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection on 64-bit values."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _stream(seed: int, n: int) -> np.ndarray:
    return mix(_U(seed) + np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))


_BYTE_VALUE = _stream(11, 256)
_BASE = int(_stream(12, 1)[0]) | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_WINDOW = _stream(13, 64) | _U(1)
_LENGTH = _stream(14, 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_kept: dict[tuple, object] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _BASE, _U), np.full(size, _BASE_INV, _U)
        up[0] = down[0] = 1
        _powers[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers[size]


def release() -> None:
    """Gives back what earlier tasks of other operators left in this Python
    worker: the kept tables, and freed memory that the allocators hold."""
    import ctypes

    import pyarrow as pa

    _kept.clear()
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def kept(key: tuple, make):
    """The value of ``make()``, kept in this Python worker for its later
    tasks. A worker keeps one value, so that the tables of the stages that
    it has run do not add up."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


def utf8(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; offsets start at 0 and a
    null row has no bytes."""
    import pyarrow as pa

    if arr.null_count:
        arr = arr.fill_null("")
    arr = arr.cast(pa.large_string())
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8)
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges (lo, hi) of at most ``limit`` bytes each, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def chunked(arr, limit: int = CHUNK_BYTES):
    """(lo, hi, bytes, offsets) of each row range of an Arrow string array."""
    data, off = utf8(arr)
    for lo, hi in row_chunks(off, limit):
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


def byte_table(chars) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


# Word separators of the contracts.
WHITE_SPACE = byte_table([0x20, *range(0x09, 0x0E)])
NOT_WORD = byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(ASCII_LOWER.tobytes()), np.uint8)


def stable_order(x: np.ndarray) -> np.ndarray:
    """The places of 64-bit values in ascending order, those of equal values
    ascending as well (two quick sorts take less than a stable one)."""
    order = np.argsort(x)
    ordered = x[order]
    run = np.cumsum(np.concatenate(([False], ordered[1:] != ordered[:-1]))[:len(x)], dtype=_U)
    return (np.sort(run << _U(32) | order.astype(_U)) & _U(0xFFFFFFFF)).astype(np.int64)


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray):
    """(starts, ends, per_row): byte spans of the maximal runs without a
    separator byte, none reaching over a row's end, and the number of them
    in each row."""
    n = len(data)
    if n == 0:
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(offsets) - 1, np.int64)
    word = ~separator[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(word & (first[:-1] | np.concatenate(([True], ~word[:-1]))))
    ends = np.flatnonzero(word & (first[1:] | np.concatenate((~word[1:], [True])))) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _power_tables(len(data))
    value = _BYTE_VALUE[data]
    value *= up[:len(data)]
    total = np.empty(len(data) + 1, _U)
    total[0] = 0
    np.cumsum(value, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


def window_hashes(words: np.ndarray, per_row: np.ndarray, width: int):
    """(hashes, first word, per_row): a 64-bit hash of each window of
    ``width`` consecutive words of a row; a row with fewer words, but not
    none, gives one window of all of them."""
    row_first = np.concatenate(([0], np.cumsum(per_row)))
    count = np.where(per_row >= width, per_row - width + 1, np.minimum(per_row, 1))
    out_first = np.concatenate(([0], np.cumsum(count)))
    at = np.arange(out_first[-1]) + np.repeat(row_first[:-1] - out_first[:-1], count)
    padded = np.concatenate((words, np.zeros(width, _U)))
    h = np.zeros(len(at), _U)
    full = np.repeat(per_row >= width, count)
    left = np.repeat(per_row, count)
    for k in range(width):
        part = padded[at + k] * _WINDOW[k]
        h += part if full.all() else np.where(full | (k < left), part, _U(0))
    h += _LENGTH[np.minimum(left, width)]
    return mix(h), at, count


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hashes that ``window_hashes`` gives for the windows of one row of
    ``width`` words or more."""
    n = max(0, len(words) - width + 1)
    h = np.full(n, _LENGTH[width])
    for k in range(width):
        h += words[k:k + n] * _WINDOW[k]
    return mix(h)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
