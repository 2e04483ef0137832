"""BagMinHash: signatures of multisets whose agreement estimates weighted Jaccard similarity without bias.

The weight axis of an item is cut at whole numbers (the discretised weights) and grouped into intervals [0, 1), [1, 2),
[2, 4), [4, 8) and so on. On each interval runs a Poisson process in time with a rate of its length; every point has a random register
and a random whole weight in the interval, and counts if that weight is below the item's. All of this comes from hashes
of item, interval and the point's number, so two multisets share exactly the points below the smaller of their weights.
A register holds the time of its first point. Processes advance together, a point each a round, and one stops as soon
as its time is past the latest register of its multiset: large multisets need little more than one point an item.
"""

from __future__ import annotations

import numpy as np

from ._words import mix

_STEP, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def signatures(owner: np.ndarray, items: np.ndarray, weights: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Times, float64[n, registers], of n multisets; ``items`` (uint64, distinct in each owner) have weights of 1 or more.

    A multiset without items has infinite times.
    """
    lows, lengths, which = [np.zeros(len(items), np.int64)], [np.ones(len(items), np.int64)], [np.arange(len(items))]
    low = 1
    while len(more := np.flatnonzero(weights > low)):
        lows.append(np.full(len(more), low))
        lengths.append(np.full(len(more), low))
        which.append(more)
        low *= 2
    low, length, which = np.concatenate(lows), np.concatenate(lengths), np.concatenate(which)
    seed = mix(items[which] + low.astype(np.uint64) * _SECOND)
    owner, weight = owner[which], weights[which]
    time, latest = np.zeros(len(which)), np.full(n, np.inf)
    times = np.full(n * registers, np.inf)
    turn = 0
    while len(seed):
        turn += 1
        random = mix(seed + np.uint64(turn * int(_STEP) % 2**64))
        time = time - np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / length
        live = time < latest[owner]
        if not live.all():
            seed, time, owner, low, length, weight, random = (x[live] for x in (seed, time, owner, low, length, weight, random))
        second = mix(random ^ _SECOND)
        register = ((second >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        at = low + ((second & np.uint64(0xFFFFFFFF)) * length.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        counts = at < weight
        slot = owner * registers + register
        np.minimum.at(times, slot if counts.all() else slot[counts], time if counts.all() else time[counts])
        if turn == 1 or turn % 4 == 0:
            busy = np.unique(owner) if len(owner) < n else np.arange(n)
            latest[busy] = times.reshape(n, registers)[busy].max(axis=1)
    return times.reshape(n, registers)


def bands(times: np.ndarray, n_bands: int) -> np.ndarray:
    """int64[n, n_bands]: a hash of each band's registers and its number."""
    bits = times.view(np.uint64).reshape(len(times), n_bands, times.shape[1] // n_bands)
    out = np.repeat(mix(np.arange(1, n_bands + 1, dtype=np.uint64))[None], len(times), 0)
    for k in range(bits.shape[2]):
        out = mix(out * _STEP + bits[:, :, k])
    return out.view(np.int64)


def short_registers(times: np.ndarray) -> np.ndarray:
    """uint16 of each register, for estimates."""
    return (mix(times.view(np.uint64)) >> np.uint64(48)).astype("<u2")
