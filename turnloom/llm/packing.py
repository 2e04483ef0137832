"""Best-fit packing of documents into sequences of several permitted lengths.

Items are laid by decreasing length into the open bin with the least room that is enough. If none has it, a new bin is opened in the
permitted size of the least cost for each place that will be used: the cost of a size grows faster than the size
(``attention``), but a larger bin's room can be used by the items still to come, as far as other open bins do
not take them. At the end each bin gets the smallest permitted size that holds its contents.

Items are dealt by a hash of key and row to shards of about ``SHARD`` items, so that rows of one id fill no shard, and
packed each shard by itself: what the cut costs is at most a few half-filled bins a shard. Documents longer than the
largest size are cut into pieces of that size, which fill bins of their own, and a rest.

Defined results. A document's length is its number of words (``[^\\x20\\x09-\\x0D]+``) and one for its end; so a null
or empty text has length 1. A length of 0 or less, if lengths are given, has no piece. Ties in length go by key, then doc_id, then piece. Every row is packed, repeated rows each by itself.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import document_key, shuffle_partitions

CAPACITIES, ATTENTION, SHARD = (1024, 2048, 4096, 8192), 1 / 16384, 20_000


def n_words(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, attention: float = ATTENTION) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the final size of each bin. Items must be sorted by decreasing length, none over the largest size."""
    sizes = sorted(capacities)
    n = len(lengths)
    later = np.concatenate((np.cumsum(lengths[::-1])[::-1], [0]))  # tokens of item i and all that follow
    rising = -lengths
    bins, offsets, used, room = np.zeros(n, np.int64), np.zeros(n, np.int64), [], []
    open_bins: dict[int, list[int]] = {}
    mask = free = 0  # bit r: some bin has room r; free: all open room
    for i, length in enumerate(lengths.tolist()):
        above = mask >> length
        if above:
            r = length + (above & -above).bit_length() - 1
            b = open_bins[r].pop()
            if not open_bins[r]:
                mask ^= 1 << r
            free -= r
        else:
            best = None
            for size in sizes:
                if size >= length:
                    spare = size - length
                    first = max(i + 1, int(np.searchsorted(rising, -spare, "left")))
                    fill = min(spare, max(0, int(later[min(first, n)]) - free))
                    cost = size * (1 + attention * size) / (length + fill)
                    if best is None or cost < best[0]:
                        best = (cost, size)
            b, r = len(used), best[1]
            used.append(0)
            room.append(r)
        bins[i], offsets[i] = b, used[b]
        used[b] += length
        r -= length
        if r:
            open_bins.setdefault(r, []).append(b)
            mask |= 1 << r
            free += r
    return bins, offsets, np.array([sizes[int(np.searchsorted(sizes, u))] for u in used], np.int64)


_PACKED = "doc_id long, piece long, start long, length long, bin_id string, capacity long, offset long"


def _shard(t: pa.Table, capacities: tuple[int, ...], attention: float) -> pa.Table:
    t = t.sort_by([("length", "descending"), ("key", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
    bins, offsets, sizes = pack(t.column("length").to_numpy(), capacities, attention)
    shard = t.column("shard")[0].as_py()
    return pa.table({"doc_id": t.column("doc_id"), "piece": t.column("piece"), "start": t.column("start"), "length": t.column("length"), "bin_id": pa.array([f"shard-{shard}-{b}" for b in bins.tolist()]), "capacity": pa.array(sizes[bins]), "offset": pa.array(offsets)})


def pack_documents(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, attention: float = ATTENTION, length: Column | None = None) -> DataFrame:
    """A row for each piece of a document: doc_id, piece, start, length, bin_id, capacity, offset."""
    largest = F.lit(max(capacities)).cast("long")
    measured = docs.select(document_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), (n_words(F.col("text")) + 1 if length is None else length.cast("long")).alias("total"))
    n = docs.count()
    shards = max(1, math.ceil(n / SHARD), min(shuffle_partitions(docs.sparkSession), math.ceil(n / 2000)))
    pieces = measured.where("total > 0").select("key", "doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / largest).cast("long"))).alias("piece"))
    cut = pieces.select("key", "doc_id", "piece", (F.col("piece") * largest).alias("start"), F.least(largest, F.col("total") - F.col("piece") * largest).alias("length"))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("key", F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(lambda t: _shard(t, capacities, attention), _PACKED)
