"""Merkle fixity audit of WARC records.

Each record is known by its archive, its byte offset there, its length and the SHA-256 of its bytes. The records of a
range of ``RANGE_BYTES`` offsets, in order, are hashed into a leaf; sixteen neighbouring leaves into a node, and so up to
one node an archive; archives go by the hex digits of their name's hash into a tree above, up to one root. Two
replicas are compared from the root: only children of nodes that differ are looked at, and only records of leaves
that differ are joined, to name what is corrupt, missing or extra.

A leaf holds at most RANGE_BYTES / 100 records, a node at most 16 children, so every list is bounded. Nothing but the
tree's height comes to the driver.

Defined results. Null html or url: empty. A null page_id belongs to archive ``none-<hash>``, dealt by a hash of the page.
Pages of one page_id are ordered by digest; repeated rows are records of their own. Several records at one offset are compared as the sorted list of their digests.
"""

from __future__ import annotations

import gzip
import io
import math
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import with_checkpoints

RANGE_BYTES, FANOUT_BITS, RECORDS = 1 << 16, 4, 256


def records_of_pages(pages: DataFrame, per_archive: int = RECORDS) -> DataFrame:
    """archive, page_id, offset, length, digest and record (the bytes as text) of pages as WARC/1.1 resource records.

    An archive holds the pages of ``per_archive`` consecutive ids, so its size is bounded.
    """
    html, url = F.coalesce(F.col("html"), F.lit("")), F.coalesce(F.col("url"), F.lit(""))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), name, F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"),
    )
    number = F.floor(F.col("page_id") / per_archive).cast("long")
    archive = F.coalesce(F.concat(F.lit("pages-"), number.cast("string")), F.concat(F.lit("none-"), F.pmod(F.xxhash64("url", "html"), F.lit(4096)).cast("string")))
    out = pages.select(archive.alias("archive"), F.col("page_id").cast("long").alias("page_id"), record.alias("record"))
    out = out.withColumn("length", F.octet_length("record").cast("long")).withColumn("digest", F.sha2("record", 256))
    so_far = Window.partitionBy("archive").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("offset", F.sum("length").over(so_far) - F.col("length"))


_MEMBER, _RECORD, _END, _CHUNK = b"\x1f\x8b\x08", b"\r\n\r\nWARC/", b"\r\n\r\n", 1 << 16


def parse_warc(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and bytes of each record of an archive, plain or compressed record by record.

    What is damaged (a member that does not decompress, a record without a proper length or end) is one record of its raw
    bytes, up to where the next one begins. Linear in the size of the archive.
    """
    return _members(data) if data[:2] == _MEMBER[:2] else _records(data)


def _inflated(data: bytes, at: int, most: int = 0) -> tuple[bytes, int] | None:
    """The member at a place and where it ends, or its first ``most`` bytes; None if it is damaged or cut off."""
    view, member, out, place = memoryview(data), zlib.decompressobj(31), [], at
    try:
        while not member.eof and place < len(data):
            out.append(member.decompress(view[place : place + _CHUNK], most))
            place += _CHUNK
            if most and out[-1]:
                return out[-1], place
    except zlib.error:
        return None
    return (b"".join(out), min(place, len(data)) - len(member.unused_data)) if member.eof else None


def _members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    at = 0
    while at < len(data):
        if (found := _inflated(data, at)) is not None:
            content, end = found
        else:
            end = data.find(_MEMBER, at + 1)
            while end >= 0 and not ((head := _inflated(data, end, 5)) and head[0] == b"WARC/"):
                end = data.find(_MEMBER, end + 1)
            end = len(data) if end < 0 else end
            content = data[at:end]
        yield at, end - at, content
        at = end


def _length(head: bytes) -> int | None:
    """The Content-Length of a record's head, if it is a whole number."""
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            value = value.strip()
            return int(value) if value.isdigit() and len(value) < 19 else None
    return None


def _records(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    at = 0
    while at < len(data):
        end, head = -1, data.find(_END, at) if data.startswith(_RECORD[4:], at) else -1
        if head >= 0 and (size := _length(data[at:head])) is not None:
            end = head + 4 + size + 4
        if end < 0 or end > len(data) or data[end - 4 : end] != _END:
            end = data.find(_RECORD, at + 1) + 4
            end = len(data) if end < 4 else end
        yield at, end - at, data[at:end]
        at = end


def scan_warc(spark: SparkSession, path: str) -> DataFrame:
    """archive, offset, length, digest of the records of WARC files. A task holds one file, by custom of about 1 GB at
    most; Spark reads no file of over 2 GB so. Archives are known by their name without the folder.
    """
    import hashlib

    def table(name: str, rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        o, n, d = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(o, pa.int64()), pa.array(n, pa.int64()), pa.array(d, pa.string())], ["archive", "offset", "length", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(batch.column("archive").to_pylist()):
                records = parse_warc(batch.column("content")[i].as_py())
                while rows := [(o, n, hashlib.sha256(r).hexdigest()) for o, n, r in islice(records, 10_000)]:
                    yield table(name, rows)

    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content").mapInArrow(run, "archive string, offset long, length long, digest string")


def compressed(records: list[bytes]) -> bytes:
    """An archive of records, compressed each by itself."""
    out = io.BytesIO()
    for r in records:
        out.write(gzip.compress(r, mtime=0))
    return out.getvalue()


def _up(nodes: DataFrame) -> DataFrame:
    """Parents of nodes (node, parent, place, hash), hashed over the children in order."""
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "hash"))), lambda c: F.concat(c.place, F.lit(":"), c.hash)), "\n")
    return nodes.groupBy("parent").agg(F.sha2(listed, 256).alias("hash"))


def merkle_levels(records: DataFrame, archive_levels: int, name_levels: int) -> list[DataFrame]:
    """From the leaves to the root, each (node, parent, hash); the last has the one node ''. Levels are few against the
    records; each is kept, so that none above it goes back to the records.
    """
    with_checkpoints(records.sparkSession)
    keyed = records.withColumn("range", F.floor(F.col("offset") / RANGE_BYTES).cast("long"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "length", "digest"))), lambda r: F.concat_ws(":", r.offset, r.length, r.digest)), "\n")
    level = keyed.groupBy("archive", "range").agg(F.sha2(rows, 256).alias("hash")).checkpoint()

    def named(df: DataFrame, height: int) -> DataFrame:
        return df.withColumn("node", F.concat_ws("|", "archive", F.lit(height), "range"))

    levels = []
    for height in range(archive_levels):
        up = F.shiftright("range", FANOUT_BITS)
        now = named(level, height).withColumn("above", up).withColumn("parent", F.concat_ws("|", "archive", F.lit(height + 1), "above"))
        levels.append(now.select("node", "parent", "hash"))
        listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("range", "hash"))), lambda c: F.concat(c["range"], F.lit(":"), c.hash)), "\n")
        level = now.groupBy("archive", F.col("above").alias("range")).agg(F.sha2(listed, 256).alias("hash")).checkpoint()
    digits = F.sha2("archive", 256)
    top = named(level, archive_levels).select("node", F.substring(digits, 1, name_levels).alias("parent"), F.col("archive").alias("place"), "hash")
    levels.append(top.select("node", "parent", "hash"))
    for depth in range(name_levels, 0, -1):
        top = _up(top).select(F.col("parent").alias("node"), F.substring("parent", 1, depth - 1).alias("parent"), F.col("parent").alias("place"), "hash").checkpoint()
        levels.append(top.select("node", "parent", "hash"))
    levels.append(_up(top).select(F.col("parent").alias("node"), F.lit(None).cast("string").alias("parent"), "hash"))
    return levels


def audit(expected: DataFrame, found: DataFrame) -> DataFrame:
    """archive, offset, status (corrupt, missing, extra), expected and found lengths and digests of the records that differ.

    Both sides need archive, offset, length, digest.
    """
    spark = expected.sparkSession
    with_checkpoints(spark)
    columns = ["archive", "offset", "length", "digest"]
    sides = [x.select(*columns).checkpoint() for x in (expected, found)]
    both = sides[0].select("archive", "offset").unionByName(sides[1].select("archive", "offset"))
    far, archives = both.agg(F.coalesce(F.max("offset"), F.lit(0)), F.approx_count_distinct("archive")).first()
    archive_levels = max(1, math.ceil(math.log2(far // RANGE_BYTES + 1) / FANOUT_BITS))
    name_levels = max(0, math.ceil(math.log2(max(1, archives)) / FANOUT_BITS) - 1)
    trees = [merkle_levels(x, archive_levels, name_levels) for x in sides]
    wrong = None
    for mine, theirs in zip(reversed(trees[0]), reversed(trees[1])):
        if wrong is not None:
            mine, theirs = (x.join(wrong, x.parent == wrong.wrong, "left_semi") for x in (mine, theirs))
        m, t = mine.select("node", F.col("hash").alias("h1")), theirs.select("node", F.col("hash").alias("h2"))
        wrong = m.join(t, "node", "full_outer").where(~F.col("h1").eqNullSafe(F.col("h2"))).select(F.col("node").alias("wrong")).checkpoint()
    leaf = F.concat_ws("|", "archive", F.lit(0), F.floor(F.col("offset") / RANGE_BYTES).cast("long"))

    def at_offsets(side: DataFrame, name: str) -> DataFrame:
        near = side.withColumn("leaf", leaf).join(wrong, F.col("leaf") == F.col("wrong"), "left_semi")
        return near.groupBy("archive", "offset").agg(F.max("length").alias(f"{name}_length"), F.array_join(F.array_sort(F.collect_list("digest")), ",").alias(f"{name}_digest"))

    pairs = at_offsets(sides[0], "expected").join(at_offsets(sides[1], "found"), ["archive", "offset"], "full_outer")
    status = F.when(F.col("expected_digest").isNull(), "extra").when(F.col("found_digest").isNull(), "missing").otherwise("corrupt")
    return pairs.where(~F.col("expected_digest").eqNullSafe(F.col("found_digest"))).select("archive", "offset", status.alias("status"), "expected_length", "found_length", "expected_digest", "found_digest")


def damaged_copy(records: DataFrame) -> DataFrame:
    """A replica with known faults: one byte changed in the records of some pages, and those of some pages lost."""
    bad = F.concat(F.substring("record", 1, 4), F.lit("~"), F.expr("substring(record, 6)"))
    hurt = F.col("page_id") % 97 == 13
    out = records.where(F.coalesce(F.col("page_id") % 211 != 5, F.lit(True))).withColumn("digest", F.when(hurt, F.sha2(bad, 256)).otherwise(F.col("digest")))
    return out.drop("record")
