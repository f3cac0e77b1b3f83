"""Arrow text columns as numpy words: what the text operators share.

The word rules work on UTF-8 bytes.  All white space the rules name is ASCII, so no multi-byte
character is ever cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 18


_RESIDENT: dict[tuple, object] = {}


def resident(make):
    """``make``, whose result a worker keeps for its next task, in place of any other: workers live on
    from step to step, and each step's model would stay beside those of the steps before."""

    @wraps(make)
    def kept(*key):
        if (make, key) not in _RESIDENT:
            _RESIDENT.clear()
            _RESIDENT[make, key] = make(*key)
        return _RESIDENT[make, key]

    return kept


def tidy(run):
    """The same step, a step without a resident model, which gives free memory back to the system when it ends: a
    Python worker lives on beside others on its executor, and allocators keep what large arrays have used."""

    def wrapped(batches):
        _RESIDENT.clear()
        yield from run(batches)
        release()

    return wrapped


def release() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text stands alone, whole."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def word_spans(
    data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; a word never crosses two rows."""
    inside = ~space[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    row = np.searchsorted(offsets, starts, "right") - 1
    return starts, np.flatnonzero(ends) + 1, row


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    up[1:], down[1:] = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    return np.cumprod(up), np.cumprod(down)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, by prefix sums of a polynomial over the bytes.

    Words are hashed in blocks of about 256 KB, so that a very long text needs no more memory: at 64 bits a byte, a block's
    sums and powers take some 12 MB.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, "right")))
        base, top = starts[i], ends[j - 1]
        size = 1 << max(18, int(top - base).bit_length())
        up, down = _powers(size)
        sums = np.zeros(top - base + 1, np.uint64)
        np.cumsum((data[base:top].astype(np.uint64) + np.uint64(1)) * up[:top - base], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix(((sums[e] - sums[s]) * down[s]) ^ ((e - s).astype(np.uint64) * _STEP))
        i = j
    return out


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words' bytes with one space between them."""
    raw = data.tobytes()
    return b" ".join([raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())])
