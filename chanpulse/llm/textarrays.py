"""Arrow text columns as numpy bytes, in slices of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; the arrays over them are many times as large.
SLICE_BYTES = 1 << 19
#: Texts handled at once: what is held for each, whatever its length, is bounded as well.
SLICE_ROWS = 2_000


def release() -> None:
    """Give freed memory back: a worker lives on after its task, beside others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own counsel
        pass


def plain(arr) -> pa.Array:
    return arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr


def spans(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values (uint8) and their len + 1 offsets; null is empty."""
    arr = plain(arr)
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type)
                            else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = arr.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind, len(arr) + 1, arr.offset * np.dtype(kind).itemsize)
    at = at.astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0]:at[-1]], at - at[0]


def slices(arr: pa.Array, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.Array]:
    """Runs of at most ``rows`` values of about ``limit`` bytes in all; one larger value is
    a run of its own."""
    arr = plain(arr)
    _, at = spans(arr)
    start = 0
    while start < len(arr):
        end = int(np.searchsorted(at, at[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), start + rows, len(arr))
        yield arr.slice(start, end - start)
        start = end


def texts(arr: pa.Array) -> list[str]:
    """Values as str; null is empty, bytes that aren't UTF-8 are replaced."""
    body, at = spans(arr)
    raw = body.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True
# fixed choice: an odd multiplier and its inverse modulo 2 ** 64
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> list[np.ndarray]:
    """The first n powers of the multiplier and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_STEP, _BACK)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers


def word_bounds(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each word (a run without ASCII white space)."""
    n = len(body)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_GAP[body]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, by one running sum over the text."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _grown(len(body) + 1)
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(mix64(body.astype(np.uint64) + np.uint64(1)) * up[:len(body)], out=sums[1:])
    own = (sums[ends] - sums[starts]) * down[starts]
    return mix64(own + (ends - starts).astype(np.uint64) * np.uint64(_STEP))
