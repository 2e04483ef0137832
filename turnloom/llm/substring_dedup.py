"""Removal of word passages that occur earlier in the corpus, by level-wise doubling.

Lengths double from about five words to the wanted one. At each length a window of the wanted length stands for itself
by the one of its windows of that length with the smallest hash: equal windows choose equal ones, so none is missed,
and only a fraction of all positions is sent. Windows whose chosen one occurs at one place of the corpus only are done
with; the others are extended to twice that length, until no candidates survive or the wanted length is reached. Of
windows that are repeated at that length, all but the first occurrence lose their words.

A block without candidates sends nothing more and does not look at its texts again before the end.

Defined results. Null text: no words. Null doc_id: kept, ordered after all ids, by a hash of the text. Several rows of
one doc_id: separate texts, ordered by text. Texts shorter than a window lose nothing. Words and windows are known by
64-bit hashes; on the last level windows of different blocks are also told apart by 32 bits of other words' hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _words
from ._blocks import PACKED, Exchange, answers, deal, in_order, packed, received, unpacked

WINDOW, SHORTEST = 20, 5
_SHORT = np.dtype([("h", "<u8"), ("twice", "u1")])
_LONG = np.dtype([("h", "<u8"), ("check", "<u4"), ("key", "<i8")])
_HASH = np.dtype([("h", "<u8")])


def levels(window: int) -> list[int]:
    """Lengths from about SHORTEST words to the window, each at most twice the one before: 20 gives 5, 10, 20."""
    if window < 2:
        raise ValueError("a window has two words at least")
    out = [window]
    while out[0] >= 2 * SHORTEST or len(out) == 1:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _sliding(pick, x: np.ndarray, width: int) -> np.ndarray:
    """pick (np.minimum, np.maximum) over every run of ``width`` values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x, have = pick(x[: len(x) - step], x[step:]), have + step
    return x


class _Text:
    """The words of a block's documents and where full windows may start."""

    def __init__(self, block: pa.Table, window: int):
        self.data, self.offsets = _words.buffers(block.column("text"))
        starts, ends, self.first = _words.spans(self.data, self.offsets)
        self.n_words, self.window, self.length = np.diff(self.first), window, 1
        self.words = self.hashes = _words.hashes(self.data, starts, ends)
        ends_at = np.repeat(self.first[1:], self.n_words)  # for each word, where its text ends
        n = max(0, len(self.words) - window + 1)
        self.alive = np.arange(n) + window <= ends_at[:n]

    def extend(self, length: int) -> None:
        """Hashes of the windows of this length, at most twice the one before."""
        while self.length < length and len(self.hashes):
            step = min(self.length, length - self.length)
            self.hashes = _words.doubled(self.hashes, step) if len(self.hashes) > step else self.hashes[:0]
            self.length += step
        self.length = length

    def chosen(self) -> np.ndarray:
        """For every full window the smallest hash of its windows of the present length."""
        return _sliding(np.minimum, self.hashes, self.window - self.length + 1)[: len(self.alive)]

    def anchors(self) -> np.ndarray:
        """Hashes at all positions that some full window still alive has chosen."""
        if not self.alive.any():
            return np.zeros(0, np.uint64)
        width = self.window - self.length + 1
        least = np.where(self.alive, self.chosen(), np.uint64(0))
        pad = np.zeros(width - 1, np.uint64)
        most = _sliding(np.maximum, np.concatenate((pad, least, pad)), width)
        return self.hashes[: len(most)][(self.hashes[: len(most)] == most) & (most > 0)]

    def keep(self, repeated: np.ndarray) -> None:
        """Full windows stay alive whose chosen hash is among the sorted ones."""
        if not len(repeated):
            self.alive[:] = False
        elif len(self.alive):
            chosen = self.chosen()
            self.alive &= repeated[np.minimum(np.searchsorted(repeated, chosen), len(repeated) - 1)] == chosen

    def candidates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Full windows alive sorted by hash, then position: positions, hashes, and whether each is its hash's first in the block."""
        self.extend(self.window)
        at = np.flatnonzero(self.alive)
        h = self.hashes[at]
        order = np.argsort(h, kind="stable")
        at, h = at[order], h[order]
        return at, h, np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)


def _surviving(block: pa.Table, told: pa.Table, window: int, upto: int) -> _Text:
    """The block's text with what is alive after the levels before number ``upto``; ``told`` has their answers."""
    text, level = _Text(block, window), told.column("level").to_numpy()
    for k, length in enumerate(levels(window)[:upto]):
        text.extend(length)
        text.keep(np.unique(received(told.filter(pa.array(level == k)), _HASH)["h"]))
    return text


_NOTHING = pa.table({"part": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), "payload": pa.array([], pa.binary())})


def _send_short(block: pa.Table, told: pa.Table | None, window: int, level: int, exchange: Exchange) -> pa.Table:
    """The block's candidates of one level, each hash once."""
    if not block.num_rows or level and not (told.num_rows and (told.column("level").to_numpy() == level - 1).any()):
        return _NOTHING
    number, block = block.column("block")[0].as_py(), in_order(block)
    text = _surviving(block, told, window, level) if level else _Text(block, window)
    text.extend(levels(window)[level])
    got, count = np.unique(text.anchors(), return_counts=True)
    records = np.empty(len(got), _SHORT)
    records["h"], records["twice"] = got, count > 1
    return packed(number, records, exchange)


def _sender(window: int, level: int, exchange: Exchange) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda block, told: _send_short(block, told, window, level, exchange)


def _find_repeated(part: pa.Table, exchange: Exchange) -> pa.Table:
    """To each block its own hashes that occur twice, in it or in several blocks."""
    records, origin = unpacked(part, _SHORT, exchange)
    order = np.argsort(records["h"], kind="stable")
    records, origin = records[order], origin[order]
    same = records["h"][1:] == records["h"][:-1]
    keep = records["twice"].astype(bool)
    keep[1:] |= same
    keep[:-1] |= same
    out = np.empty(int(keep.sum()), _HASH)
    out["h"] = records["h"][keep]
    return answers(part, out, origin[keep], exchange)


def _send_long(block: pa.Table, told: pa.Table, window: int, exchange: Exchange) -> pa.Table:
    """The first occurrence in the block of each full window that is alive, with its document."""
    last = len(levels(window)) - 1
    if not block.num_rows or not (told.num_rows and (told.column("level").to_numpy() == last - 1).any()):
        return _NOTHING
    number, block = block.column("block")[0].as_py(), in_order(block)
    text = _surviving(block, told, window, last)
    at, h, first = text.candidates()
    at, h = at[first], h[first]
    records = np.empty(len(h), _LONG)
    check = text.words[at] * np.uint64(31) + text.words[at + window // 2] * np.uint64(37) + text.words[at + window - 1]
    records["h"], records["check"] = h, (_words.mix(check) >> np.uint64(32)).astype(np.uint32)
    records["key"] = block.column("key").to_numpy()[np.searchsorted(text.first, at, "right") - 1]
    return packed(number, records, exchange)


def _find_later(part: pa.Table, exchange: Exchange) -> pa.Table:
    """To each block the windows that a smaller document of another block holds."""
    records, origin = unpacked(part, _LONG, exchange)
    order = np.lexsort((records["key"], records["check"], records["h"]))
    records, origin = records[order], origin[order]
    later = np.zeros(len(records), bool)
    later[1:] = (records["h"][1:] == records["h"][:-1]) & (records["check"][1:] == records["check"][:-1])
    out = np.empty(int(later.sum()), _HASH)
    out["h"] = records["h"][later]
    return answers(part, out, origin[later], exchange)


def _remove(block: pa.Table, told: pa.Table, window: int, with_text: bool) -> pa.Table:
    """Kept words of each document; the answers of the last level are the windows that an earlier document holds."""
    block, last = in_order(block), len(levels(window)) - 1
    level = told.column("level").to_numpy()
    if (level == last - 1).any():
        text = _surviving(block, told, window, last)
        at, h, first = text.candidates()
    else:
        text, at = _Text(block, window), np.zeros(0, np.int64)
    gone = np.zeros(len(text.words) + 1, np.int64)
    if len(at):
        earlier, drop = np.unique(received(told.filter(pa.array(level == last)), _HASH)["h"]), ~first
        if len(earlier):
            drop |= earlier[np.minimum(np.searchsorted(earlier, h), len(earlier) - 1)] == h
        np.add.at(gone, at[drop], 1)
        np.add.at(gone, at[drop] + window, -1)
    gone = np.cumsum(gone[:-1]) > 0
    raw, sums, kept = text.data.tobytes(), [], []
    removed = np.add.reduceat(np.append(gone, False).astype(np.int64), text.first[:-1]) if len(text.n_words) else np.zeros(0, np.int64)
    removed = np.where(text.n_words > 0, removed, 0)
    for i, n in enumerate(removed):
        words = raw[text.offsets[i] : text.offsets[i + 1]].split()
        out = b" ".join(compress(words, ~gone[text.first[i] : text.first[i + 1]]) if n else words)
        sums.append(hashlib.sha256(out).hexdigest())
        if with_text:
            kept.append(out)
    columns = {"doc_id": block.column("doc_id"), "n_words": pa.array(text.n_words.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)), "kept_sha256": pa.array(sums, pa.string())}
    return pa.table(columns | ({"kept_text": pa.array(kept, pa.binary()).cast(pa.string())} if with_text else {}))


def dedup_substrings(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (words joined by one space).

    Every level and the end read the documents, dealt to blocks once; see ``_blocks`` for what goes between them.
    """
    last = len(levels(window)) - 1
    dealt, exchange = deal(docs, 1.0)
    by_block = dealt.groupBy("block")

    def at(level: int, sent: DataFrame, kind: np.dtype, decide) -> DataFrame:
        ranges = exchange.to_ranges(sent, kind).groupBy("part")
        return exchange.to_blocks(ranges.applyInArrow(lambda t: decide(t, exchange), PACKED), _HASH).withColumn("level", F.lit(level))

    told = at(0, by_block.applyInArrow(lambda t: _send_short(t, None, window, 0, exchange), PACKED), _SHORT, _find_repeated)
    for level in range(1, last):
        sent = by_block.cogroup(told.groupBy("block")).applyInArrow(_sender(window, level, exchange), PACKED)
        told = told.unionByName(at(level, sent, _SHORT, _find_repeated))
    sent = by_block.cogroup(told.groupBy("block")).applyInArrow(lambda t, x: _send_long(t, x, window, exchange), PACKED)
    told = told.unionByName(at(last, sent, _LONG, _find_later))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return by_block.cogroup(told.groupBy("block")).applyInArrow(lambda t, x: _remove(t, x, window, with_text), schema)
