"""Exchange of hashed items between blocks of documents and ranges of hashes, in packed arrays.

Documents are dealt to blocks of a bounded size by a hash of their id. A block sends one binary row to each range of
the hash space, holding its items of that range, already combined: a hash that a block holds many times is sent once.
A range answers each block with one binary row again. So a hash that a third of all documents hold costs one item a
block, no task sees more than its share of items, and only arrays are shuffled besides the texts themselves.

With many blocks and ranges a row for each pair of them would hold an item or two. Then items go in two steps: a block
sends a row to each group of about sqrt(ranges) ranges; neighbouring blocks, about sqrt(blocks) of them, are one
district, and a task for each district and group joins what these blocks sent and cuts it by range. Answers come back
the same way. So there are (blocks x groups) + (districts x ranges) rows, of hundreds of items each even at 100 TB, in place of blocks x ranges.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import blocks_for, document_key, nullable, shuffle_partitions, text_bytes

PACKED = "part int, block int, payload binary"
ANSWER = "block int, payload binary"
#: Bytes of text in a block, and of items in a range, about; items that a row should hold on average, at least.
BLOCK_BYTES, RANGE_BYTES, ROW_ITEMS = 12 << 20, 32 << 20, 256


@dataclass(frozen=True)
class Exchange:
    """How many blocks and ranges there are, into how many districts and groups they fall (1 and 0: rows go straight)."""

    blocks: int
    ranges: int
    districts: int = 1
    groups: int = 0

    @staticmethod
    def planned(text_bytes: int, item_bytes_per_text_byte: float, least: int, item_bytes: int = 16) -> Exchange:
        blocks, ranges = blocks_for(text_bytes, BLOCK_BYTES, least), blocks_for(int(text_bytes * item_bytes_per_text_byte), RANGE_BYTES, least)
        items = text_bytes * item_bytes_per_text_byte / item_bytes
        if items / blocks / ranges >= ROW_ITEMS or ranges <= 2 * least:
            return Exchange(blocks, ranges)
        return Exchange(blocks, ranges, math.isqrt(blocks - 1) + 1, math.isqrt(ranges - 1) + 1)

    @property
    def by_group(self) -> int:
        """Ranges in a group."""
        return -(-self.ranges // self.groups)

    @property
    def by_district(self) -> int:
        return -(-self.blocks // self.districts)

    def range_of(self, h: np.ndarray) -> np.ndarray:
        return (h // np.uint64(-(-(2**64) // self.ranges))).astype(np.int32)

    def to_ranges(self, sent: DataFrame, kind: np.dtype) -> DataFrame:
        """Rows of PACKED from blocks (``packed``) as rows to be grouped by ``part``, a range."""
        if not self.groups:
            return sent
        district = F.floor(F.col("block") / self.by_district).cast("int")
        return sent.withColumn("district", district).groupBy("district", "part").applyInArrow(lambda t: _joined(t, kind, self), PACKED)

    def to_blocks(self, told: DataFrame, kind: np.dtype) -> DataFrame:
        """Rows of PACKED from ranges (``answers``) as rows of ANSWER, to be grouped by ``block``."""
        if not self.groups:
            return told.select("block", "payload")
        group = F.floor(F.col("part") / self.by_group).cast("int")
        return told.withColumn("group", group).groupBy("block", "group").applyInArrow(lambda t: _split(t, kind), ANSWER)


def _routed(kind: np.dtype) -> np.dtype:
    """Items that know their block."""
    return np.dtype([*kind.descr, ("from", "<u4")])


def _arrays(table: pa.Table, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All items of the rows, and for each the row that it came in."""
    arrays = [np.frombuffer(x.as_buffer(), kind) for x in table.column("payload")]
    if not arrays:
        return np.zeros(0, kind), np.zeros(0, np.int64)
    return np.concatenate(arrays), np.repeat(np.arange(len(arrays)), [len(x) for x in arrays])


def _cut(keys: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The distinct keys, which must be sorted, and the bytes of the items of each."""
    got, first = np.unique(keys, return_index=True)
    bounds = np.append(first, len(items))
    return got, [items[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def _rows(part: np.ndarray | int, block: np.ndarray | int, payload: list[bytes]) -> pa.Table:
    whole = lambda x: pa.array(np.broadcast_to(np.asarray(x, np.int32), len(payload)))
    return pa.table({"part": whole(part), "block": whole(block), "payload": pa.array(payload, pa.binary())})


def _joined(table: pa.Table, kind: np.dtype, exchange: Exchange) -> pa.Table:
    """What the blocks of a district sent to a group of ranges, by range, as items that know their block."""
    items, rows = _arrays(table, kind)
    out = np.empty(len(items), _routed(kind))
    for name in kind.names:
        out[name] = items[name]
    out["from"] = table.column("block").to_numpy()[rows]
    out = out[np.argsort(out["h"], kind="stable")]
    parts, payload = _cut(exchange.range_of(out["h"]), out)
    return _rows(parts, table.column("district")[0].as_py(), payload)


def _split(table: pa.Table, kind: np.dtype) -> pa.Table:
    """What the ranges of a group answered a district, by block."""
    items, _ = _arrays(table, _routed(kind))
    items = items[np.argsort(items["from"], kind="stable")]
    out = np.empty(len(items), kind)
    for name in kind.names:
        out[name] = items[name]
    blocks, payload = _cut(items["from"], out)
    return _rows(0, blocks, payload).select(["block", "payload"])


def deal(docs: DataFrame, item_bytes_per_text_byte: float, carry: bool = False) -> tuple[DataFrame, Exchange]:
    """Columns block, key, doc_id, text, if asked for ``rest`` (a struct of all columns but the text), and the exchange
    for such blocks.
    """
    exchange = Exchange.planned(text_bytes(docs), item_bytes_per_text_byte, shuffle_partitions(docs.sparkSession))
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    rest = rest.cast(nullable(docs.select(rest.alias("rest")).schema["rest"].dataType)) if carry else rest
    dealt = docs.select(document_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([rest.alias("rest")] if carry else []))
    return dealt.select(F.pmod(F.xxhash64("key"), F.lit(exchange.blocks)).cast("int").alias("block"), *dealt.columns), exchange


def in_order(block: pa.Table) -> pa.Table:
    """The documents of a block by key; rows of one key by text, nulls first."""
    return block.sort_by([("key", "ascending"), ("text", "ascending")]) if block.num_rows > 1 else block


def packed(block: int, records: np.ndarray, exchange: Exchange) -> pa.Table:
    """One row for each range, or group of ranges, that has records; they must be sorted by their field ``h``."""
    parts = exchange.range_of(records["h"])
    got, payload = _cut(parts // exchange.by_group if exchange.groups else parts, records)
    return _rows(got, block, payload)


def unpacked(table: pa.Table, kind: np.dtype, exchange: Exchange) -> tuple[np.ndarray, np.ndarray]:
    """All records of a range, and the origin of each, as ``answers`` needs it."""
    items, rows = _arrays(table, _routed(kind) if exchange.groups else kind)
    origin = np.empty(len(items), [("row", "<i8"), ("from", "<u4")])
    origin["row"], origin["from"] = rows, items["from"] if exchange.groups else 0
    return items, origin


def answers(table: pa.Table, records: np.ndarray, origin: np.ndarray, exchange: Exchange) -> pa.Table:
    """One row for each block, or district, that gets records back."""
    order = np.argsort(origin["row"], kind="stable")
    records, origin = records[order], origin[order]
    if exchange.groups:
        plain, records = records, np.empty(len(records), _routed(records.dtype))
        for name in plain.dtype.names:
            records[name] = plain[name]
        records["from"] = origin["from"]
    rows, payload = _cut(origin["row"], records)
    return _rows(table.column("part")[0].as_py() if table.num_rows else 0, table.column("block").to_numpy()[rows], payload)


def received(table: pa.Table, kind: np.dtype) -> np.ndarray:
    """What all ranges answered one block."""
    return _arrays(table, kind)[0]
