"""Removal of lines that many documents share; every such line stays in one document.

A line's key is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased. The keys' hashes are
cut into ranges and each range is sorted by hash, then by document from the last to the first and place in it;
streaming through it, the first row of each hash names the document that keeps the line. What comes back to the
documents is no text but the hashes to drop, from which a bitmap of kept lines is made for each document, compressed to
the lengths of its runs: ``3,1,5`` keeps three lines, drops one and keeps five; it begins with ``0,`` where the first
line goes. Texts are made from the bitmaps.

Defined results. Null or empty text: one empty line. Keys shorter than ``min_chars`` code points are never dropped.
Null doc_id: ordered after all ids, by a hash of the text; rows of one doc_id count as one document and each keeps its
lines where that id is the largest. Other columns pass unchanged. Lines are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from itertools import compress, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ._blocks import PACKED, Exchange, answers, deal, in_order, packed, received, unpacked
from ._words import SPACES, buffers

MIN_CHARS, MIN_DOCS = 40, 5
_LINE = np.dtype([("h", "<u8"), ("h2", "<u8"), ("docs", "<i4"), ("place", "<u4"), ("key", "<i8")])
_DROP = np.dtype([("h", "<u8"), ("h2", "<u8"), ("key", "<i8")])


def _key(line: bytes, min_chars: int) -> bytes | None:
    if len(line) < min_chars:
        return None
    key = line.strip(SPACES).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _texts(block: pa.Table) -> list[bytes]:
    data, offsets = buffers(block.column("text"))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _send(block: pa.Table, min_chars: int, exchange: Exchange) -> pa.Table:
    """For each key of the block, how many documents hold it, which is the last and the first line of that with it."""
    block = in_order(block)
    seen: dict[bytes, list[int]] = {}
    for key, text in zip(block.column("key").to_pylist(), _texts(block)):
        for place, line in enumerate(text.split(b"\n")):
            if (h := _key(line, min_chars)) is not None:
                if (x := seen.get(h)) is None:
                    seen[h] = [1, place, key]
                elif x[2] != key:
                    x[:] = x[0] + 1, place, key
    records = np.empty(len(seen), _LINE)
    both = np.frombuffer(b"".join(seen), ">u8").reshape(-1, 2)
    told = np.array(list(seen.values()), np.int64).reshape(-1, 3)
    records["h"], records["h2"], records["docs"], records["place"], records["key"] = both[:, 0], both[:, 1], *told.T
    return packed(block.column("block")[0].as_py(), records[np.argsort(records["h"], kind="stable")], exchange)


def _decide(part: pa.Table, min_docs: int, exchange: Exchange) -> pa.Table:
    """To each block, its keys of ``min_docs`` documents and the document that keeps each."""
    records, origin = unpacked(part, _LINE, exchange)
    order = np.lexsort((records["place"], -records["key"], records["h2"], records["h"]))
    records, origin = records[order], origin[order]
    new = np.ones(len(records), bool)
    new[1:] = (records["h"][1:] != records["h"][:-1]) | (records["h2"][1:] != records["h2"][:-1])
    group = np.cumsum(new) - 1
    docs = np.bincount(group, records["docs"]).astype(np.int64) if len(group) else np.zeros(0, np.int64)
    keep = docs[group] >= min_docs if len(group) else np.zeros(0, bool)
    out = np.empty(int(keep.sum()), _DROP)
    out["h"], out["h2"], out["key"] = records["h"][keep], records["h2"][keep], records["key"][new][group][keep]
    return answers(part, out, origin[keep], exchange)


def run_lengths(stays: list[bool]) -> str:
    """A bitmap as lengths of runs, kept lines first."""
    runs = [str(len(list(run))) for _, run in groupby(stays)]
    return ",".join(runs if not stays or stays[0] else ["0", *runs])


def kept_lines(bitmap: str, n_lines: int) -> list[bool]:
    """Which of its lines a bitmap keeps."""
    out: list[bool] = []
    for i, n in enumerate(bitmap.split(",")):
        out += [i % 2 == 0] * int(n)
    if len(out) != n_lines:
        raise ValueError("the bitmap is of another text")
    return out


def _apply(block: pa.Table, told: pa.Table, min_chars: int, with_text: bool, carry: bool = False) -> pa.Table:
    block, drops = in_order(block), received(told, _DROP)
    both = np.stack((drops["h"], drops["h2"]), 1).astype(">u8").tobytes()
    keeper = {both[16 * i : 16 * i + 16]: key for i, key in enumerate(drops["key"].tolist())}
    n_lines, n_dropped, maps, sums, kept = [], [], [], [], []
    for key, text in zip(block.column("key").to_pylist(), _texts(block)):
        lines = text.split(b"\n")
        stays = [True] * len(lines)
        if keeper:
            for i, line in enumerate(lines):
                if (h := _key(line, min_chars)) is not None and keeper.get(h, key) != key:
                    stays[i] = False
        bitmap = run_lengths(stays)
        out = b"\n".join(compress(lines, kept_lines(bitmap, len(lines)))) if "," in bitmap else text
        n_lines.append(len(lines))
        n_dropped.append(stays.count(False))
        maps.append(bitmap)
        sums.append(hashlib.sha256(out).hexdigest())
        if with_text:
            kept.append(out)
    columns = {"doc_id": block.column("doc_id"), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64()), "keep_bitmap": pa.array(maps, pa.string()), "kept_sha256": pa.array(sums, pa.string())}
    if carry:
        none = block.column("text").is_null().to_pylist()
        return pa.table({"rest": block.column("rest"), "text": pa.array([None if n else t for n, t in zip(none, kept)], pa.binary()).cast(pa.string())})
    return pa.table(columns | ({"kept_text": pa.array(kept, pa.binary()).cast(pa.string())} if with_text else {}))


def _told(by_block: GroupedData, exchange: Exchange, min_chars: int, min_docs: int) -> DataFrame:
    sent = exchange.to_ranges(by_block.applyInArrow(lambda t: _send(t, min_chars, exchange), PACKED), _LINE)
    return exchange.to_blocks(sent.groupBy("part").applyInArrow(lambda t: _decide(t, min_docs, exchange), PACKED), _DROP)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, keep_bitmap, kept_sha256 and, if asked for, kept_text."""
    dealt, exchange = deal(docs, 0.3)
    by_block = dealt.groupBy("block")
    told = _told(by_block, exchange, min_chars, min_docs)
    schema = "doc_id long, n_lines long, n_dropped long, keep_bitmap string, kept_sha256 string" + ", kept_text string" * with_text
    return by_block.cogroup(told.groupBy("block")).applyInArrow(lambda t, x: _apply(t, x, min_chars, with_text), schema)


def without_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents themselves, all columns in their order, with the kept lines as text; a null text stays null."""
    dealt, exchange = deal(docs, 0.3, carry=True)
    by_block = dealt.groupBy("block")
    told = _told(by_block, exchange, min_chars, min_docs)
    schema = StructType([dealt.schema["rest"], StructField("text", StringType())])
    kept = by_block.cogroup(told.groupBy("block")).applyInArrow(lambda t, x: _apply(t, x, min_chars, True, True), schema)
    return kept.select(*("text" if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns))
