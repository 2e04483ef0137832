"""Words of many texts at once: spans and 64-bit hashes straight from the UTF-8 bytes of an Arrow column.

A word is ``[^\\x20\\x09-\\x0D]+``. All functions work on whole arrays; no Python object is made for a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes hashed at a time, so that the arrays of eight bytes a byte stay small.
_SLICE = 1 << 20
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n + 1:
        size = max(n, _SLICE) + 1
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def buffers(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n + 1 indices at which each text's words begin."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(space)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    before[-1] = True
    before[:-1] = space[1:]
    ends = np.flatnonzero(~space & (before | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span, equal for equal bytes wherever they stand."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SLICE, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _power_tables(hi - lo)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data[lo:hi]] * up[: hi - lo], out=total[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)
        i = j
    return mix(out)


def doubled(h: np.ndarray, shift: int) -> np.ndarray:
    """Hash of the window made of the one at i and the one at i + shift; ``shift`` shorter than ``h``."""
    return mix(h[: len(h) - shift] * np.uint64(0xD6E8FEB86659FD93) + h[shift:] * np.uint64(0xA0761D6478BD642F))


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` items, by doubling; texts' ends are not heeded. Empty when there are too few."""
    if len(h) < length:
        return np.zeros(0, np.uint64)
    have = 1
    while have < length:
        step = min(have, length - have)
        h, have = doubled(h, step), have + step
    return h
