"""Byte-level BPE encoding and decoding with a given rank file.

Each match of the pattern is encoded by itself. A worker keeps the ids of the pieces it has met; the pieces of a batch
that are new are encoded together: grouped by length into padded matrices of ids, where in each round every row merges
its leftmost pair of minimum rank. The rank of a pair comes from a hash table of pairs held in arrays; finished rows
leave the matrix and the matrix narrows as its rows shorten. Pieces over ``LONG`` bytes go to a heap of pairs instead,
which merges in the same order in n log n steps.

Defined results. Null text: like empty text, no ids. A piece that is itself a token gets its id at once. Special
tokens are ordinary text. Texts of any length are encoded in runs of pieces, so their ids are not held as one list
unless they are asked for.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._words import mix

LONG, RUN, CACHE, CACHE_BYTES = 256, 1 << 16, 800_000, 64 << 20
#: Characters of text encoded together.
GROUP_CHARS = 1 << 20
_NONE = np.int32(2**31 - 1)


class PairTable:
    """Open addressing over arrays: (left id, right id) -> id of the joined token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray):
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        self.mask = np.uint64((1 << max(4, int(np.ceil(np.log2(4 * max(1, len(keys))))))) - 1)
        self.keys = np.full(int(self.mask) + 1, 2**64 - 1, np.uint64)
        self.joined = np.full(int(self.mask) + 1, _NONE, np.int32)
        slot, todo, self.probes = mix(keys) & self.mask, np.arange(len(keys)), 0
        while len(todo):
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            taken, first = np.unique(slot[todo[free]], return_index=True)
            put = todo[free][first]
            self.keys[taken], self.joined[taken] = keys[put], joined[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask
            self.probes += 1

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Joined ids, or _NONE; a negative id joins with nothing."""
        out = np.full(left.shape, _NONE, np.int32)
        live = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left.ravel()[live].astype(np.uint64) << np.uint64(32)) | right.ravel()[live].astype(np.uint64)
        slot, flat = mix(keys) & self.mask, out.reshape(-1)
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == keys
            flat[live[hit]] = self.joined[slot[hit]]
            on = ~hit & (there != np.uint64(2**64 - 1))
            if not on.any():
                break
            live, keys, slot = live[on], keys[on], (slot[on] + np.uint64(1)) & self.mask
        return out


class Encoder:
    """Ranks are ids; every byte must be a token."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        self.vocab = {i: t for t, i in self.ranks.items()}
        self.texts = {i: str(i) for i in self.vocab}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        splits = [(self.ranks[t[:k]], self.ranks[t[k:]], i) for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        self.pairs = PairTable(*(np.array(x, np.int64) for x in zip(*splits))) if splits else PairTable(*(np.zeros(0, np.int64),) * 3)
        self.joined = {(a, b): i for a, b, i in splits}
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.held = 0  # about how many bytes the cache holds

    def _matrix(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of pieces of at most LONG bytes, of about one length."""
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        ids = np.full((len(pieces), width + 1), -1, np.int32)
        filled = np.arange(width + 1) < lengths[:, None]
        ids[filled] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self.pairs.find(ids[:, :-1], ids[:, 1:])
        out: list[tuple[int, ...]] = [()] * len(pieces)
        row, left = np.arange(len(pieces)), lengths.copy()
        while len(row):
            at = ranks.argmin(axis=1)
            every = np.arange(len(row))
            best = ranks[every, at]
            done = best == _NONE
            if done.any():
                for i in np.flatnonzero(done).tolist():
                    out[row[i]] = tuple(ids[i, : left[i]].tolist())
                on = ~done
                row, left, at, best = row[on], left[on], at[on], best[on]
                width = int(left.max()) if len(left) else 0
                ids, ranks, every = ids[on, : width + 1], ranks[on, :width], np.arange(len(row))
                if not len(row):
                    break
            ids[every, at] = best
            # close the gap at at + 1 in ids, and at at in ranks, whose neighbours are looked up anew
            columns = np.arange(width)
            ids[:, :-1] = np.take_along_axis(ids, columns + (columns > at[:, None]), 1)
            ids[:, -1] = -1
            ranks[:, :-1] = np.take_along_axis(ranks, columns[:-1] + (columns[:-1] >= at[:, None]), 1)
            ranks[:, -1] = _NONE
            ranks[every, at] = self.pairs.find(ids[every, at], ids[every, at + 1])
            some = at > 0
            ranks[every[some], at[some] - 1] = self.pairs.find(ids[every[some], at[some] - 1], ids[every[some], at[some]])
            left -= 1
        return out

    def _heap(self, piece: bytes) -> tuple[int, ...]:
        """The same merges with a linked list and a heap of (rank, position)."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := self.joined.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.joined.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return tuple(x for x in ids if x >= 0)

    def learn(self, pieces: Iterable[str]) -> None:
        """Puts the ids of all pieces into the cache."""
        wanted = set(pieces)
        new = [p for p in wanted if p not in self.cache]
        self.held += 8 * sum(map(len, new))
        if len(self.cache) + len(new) > CACHE or self.held > CACHE_BYTES:
            self.cache.clear()
            new = list(wanted)
            self.held = 8 * sum(map(len, new))
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for p in new:
            raw = p.encode()
            if (i := self.ranks.get(raw)) is not None:
                self.cache[p] = (i,)
            elif len(raw) > LONG:
                self.cache[p] = self._heap(raw)
            else:
                buckets.setdefault((len(raw) - 1).bit_length(), []).append((p, raw))
        for bucket in buckets.values():
            for k in range(0, len(bucket), 8192):
                some = bucket[k : k + 8192]
                self.cache.update(zip((p for p, _ in some), self._matrix([raw for _, raw in some])))

    def runs(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, a bounded number at a time."""
        if len(text) <= GROUP_CHARS:
            yield self.pattern.findall(text)
            return
        matches = self.pattern.finditer(text)
        while run := [m[0] for m in islice(matches, RUN)]:
            yield run

    def encode(self, pieces: list[str]) -> list[int]:
        """Ids of pieces that have been learned."""
        return list(chain.from_iterable(map(self.cache.__getitem__, pieces)))

    def encode_text(self, text: str) -> list[int]:
        ids: list[int] = []
        for run in self.runs(text):
            self.learn(run)
            ids += self.encode(run)
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


_encoders: dict[tuple[int, str], Encoder] = {}


def encoder(rank_file: bytes, pattern: str) -> Encoder:
    """One for each worker process and rank file."""
    key = (hash(rank_file), pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(rank_file, pattern)
    return _encoders[key]


def _digests(coder: Encoder, texts: list[str]) -> Iterator[tuple[int, str, str]]:
    """For each text the number of ids, the SHA-256 of their decimal list and that of the decoded bytes."""
    group: list[list[str]] = []
    size = 0

    def flush():
        coder.learn(chain.from_iterable(group))
        for pieces in group:
            ids = coder.encode(pieces)
            listed = " ".join(map(coder.texts.__getitem__, ids))
            yield len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()

    for text in texts:
        if len(text) > GROUP_CHARS:
            yield from flush()
            group, size = [], 0
            listed, decoded, n = hashlib.sha256(), hashlib.sha256(), 0
            for run in coder.runs(text):
                coder.learn(run)
                ids = coder.encode(run)
                listed.update((" " * bool(n and ids) + " ".join(map(coder.texts.__getitem__, ids))).encode())
                decoded.update(coder.decode(ids))
                n += len(ids)
            yield n, listed.hexdigest(), decoded.hexdigest()
            continue
        group.append(coder.pattern.findall(text))
        size += len(text)
        if size > GROUP_CHARS:
            yield from flush()
            group, size = [], 0
    yield from flush()


def _sent(spark: SparkSession, rank_path: str) -> Broadcast[bytes]:
    """The rank file, read by the driver and sent to each executor once; some hundred kilobytes."""
    with open(rank_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    rank_file = _sent(docs.sparkSession, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(rank_file.value, pattern)
        for batch in batches:
            rows = list(_digests(coder, batch.column("text").to_pylist()))
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return wanted.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array<int>) of every document."""
    rank_file = _sent(docs.sparkSession, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(rank_file.value, pattern)
        for batch in batches:
            ids = [coder.encode_text(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return wanted.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id and text (binary, as ids need not make up whole characters) of rows of doc_id and ids; null ids: empty."""
    rank_file = _sent(encoded.sparkSession, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(rank_file.value, pattern)
        for batch in batches:
            texts = [coder.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text binary")
