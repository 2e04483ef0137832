"""Near duplicates by weighted Jaccard similarity of word shingles, found with BagMinHash signatures.

A document is the multiset of its runs of ``SHINGLE`` words (``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased);
a shorter one is one shingle. Texts with the same words are one class at once. Of the others, signatures are cut into
bands; documents that share a band are candidates, and a candidate pair is a link if the exact multiset similarity is
at least ``SIMILARITY``. Classes are the connected components of the links.

How candidates are found without all pairs of a bucket: buckets of at most ``SMALL`` members are compared in full. In a
larger one every member is compared with the smallest member, its pivot, and keeps the items in which they differ.
Where a pivot then has members outside its class, these are compared with its other members, chunk by chunk and
exactly, from the items in which both differ from the pivot; a row is made for each member and other class it is linked
to, not for each pair. So no bucket is cut short, and copies cost one row each.

With 32 bands of 5 registers a pair at similarity 0.8 shares no band with a chance of 3e-6; one of a small bucket is
estimated under ``ESTIMATE``, and then not verified, with about 1e-6.

Defined results. Null text and text without words: alone in its class. Null doc_id: its key is a hash of the text above all
ids. Rows of one doc_id are one document for the classes. class_id is the smallest key of the class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _words
from ._common import document_key, with_checkpoints
from .bagminhash import bands, short_registers, signatures
from .components import connected_components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 5
SMALL, CHUNK, CHUNK_BYTES, ESTIMATE = 16, 2048, 4 << 20, 0.65
_GROUP_BYTES = 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(column: pa.ChunkedArray | pa.Array, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, the n + 1 bounds of each text's, and a hash of each text's words in order (0: none)."""
    data, offsets = _words.buffers(column)
    data = _LOWER[data]
    starts, ends, first = _words.spans(data, offsets)
    h = _words.hashes(data, starts, ends)
    n_words = np.diff(first)
    n_shingles = np.where(n_words >= length, n_words - length + 1, np.minimum(n_words, 1))
    bounds = np.concatenate(([0], np.cumsum(n_shingles)))
    owner = np.repeat(np.arange(len(n_words)), n_shingles)
    at = first[:-1][owner] + np.arange(bounds[-1]) - bounds[owner]
    runs = _words.windows(h, length)
    out = runs[np.minimum(at, max(0, len(runs) - 1))] if len(runs) else np.zeros(len(at), np.uint64)
    for i in np.flatnonzero((n_words > 0) & (n_words < length)):
        x = np.array([n_words[i]], np.uint64)
        for k in range(first[i], first[i + 1]):
            x = _words.mix(x * np.uint64(31) + h[k : k + 1])
        out[bounds[i]] = x[0]
    # words weighted by position, summed: equal for equal sequences
    place = _words.mix(np.arange(len(h), dtype=np.uint64) - np.repeat(first[:-1], n_words).astype(np.uint64))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_words.mix(h ^ place), dtype=np.uint64)))
    exact = _words.mix(total[first[1:]] - total[first[:-1]] + n_words.astype(np.uint64))
    return out, bounds, np.where(n_words > 0, exact, 0)


def _groups(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about _GROUP_BYTES of text."""
    _, offsets = _words.buffers(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _GROUP_BYTES, "right")) - 1)
        yield a, min(b, len(column))
        a = min(b, len(column))


def sign(docs: DataFrame) -> DataFrame:
    """key, exact1, exact2 (hashes of the words in order), bands and registers of every document that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _groups(batch.column("text")):
                text = batch.column("text").slice(a, b - a)
                h, bounds, exact = shingles(text)
                items, weights, sizes, second = [], [], np.zeros(len(exact), np.int64), np.zeros(len(exact), np.uint64)
                for i in range(len(exact)):
                    u, c = np.unique(h[bounds[i] : bounds[i + 1]], return_counts=True)
                    items.append(u)
                    weights.append(c)
                    sizes[i] = len(u)
                    second[i] = np.bitwise_xor.reduce(_words.mix(u * np.uint64(7) + c.astype(np.uint64))) if len(u) else 0
                times = signatures(np.repeat(np.arange(len(exact)), sizes), np.concatenate(items), np.concatenate(weights), len(exact), BANDS * ROWS)
                keep = np.flatnonzero(exact)
                times = times[keep]
                table = bands(times, BANDS)
                short = short_registers(times)
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").slice(a, b - a).take(pa.array(keep)), pa.array(exact[keep].view(np.int64)), pa.array(second[keep].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, table.size + 1, BANDS, dtype=np.int32)), pa.array(table.ravel())), pa.array([r.tobytes() for r in short], pa.binary()),
                ], ["key", "exact1", "exact2", "bands", "registers"])

    return docs.select(document_key().alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(run, "key long, exact1 long, exact2 long, bands array<long>, registers binary")


def _estimate(a: str, b: str):
    """True where two rows' registers agree in at least ESTIMATE of places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = BANDS * ROWS
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, n) for c in (a, b))
            near = (x == y).sum(axis=1) >= ESTIMATE * n
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(near))

    return run


def _near(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose signatures are near. Each pair meets the data of b first, as a may be a pivot of many."""
    one = signed.select(F.col("key").alias("b"), F.col("registers").alias("rb"))
    two = signed.select(F.col("key").alias("a"), F.col("registers").alias("ra"))
    return pairs.join(one, "b").join(two, "a").select("a", "b", "ra", "rb").mapInArrow(_estimate("ra", "rb"), "a long, b long")


def _as_set(h: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the k-th copy of a hash is an item of its own."""
    h = np.sort(h)
    new = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
    copy = np.arange(len(h)) - start
    return np.sort(_words.mix(h + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) if copy.any() else h


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two multisets of hashes as ``_as_set`` gives them."""
    if not len(a) or not len(b):
        return 0.0
    there = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[there] == a).sum())
    return both / (len(a) + len(b) - both)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """a, b of the pairs whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            keys, good = batch.column("a").to_pylist(), []
            for i, key in enumerate(keys):
                if key != last[0]:
                    last = (key, _as_set(shingles(batch.column("ta").slice(i, 1))[0]))
                good.append(weighted_jaccard(last[1], _as_set(shingles(batch.column("tb").slice(i, 1))[0])) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = texts.select(F.col("key").alias("b"), F.col("text").alias("tb"))
    two = texts.select(F.col("key").alias("a"), F.col("text").alias("ta"))
    return pairs.join(one, "b").join(two, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


_COMPARED = "a long, b long, n_a int, lost int, n_b int, apart binary"


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """For pivots a and members b: sizes of both multisets, how many of a's items b lacks, and the items that only one of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            rows = []
            for i, key in enumerate(batch.column("a").to_pylist()):
                if key != last[0]:
                    last = (key, _as_set(shingles(batch.column("ta").slice(i, 1))[0]))
                one, two = last[1], _as_set(shingles(batch.column("tb").slice(i, 1))[0])
                lost, added = np.setdiff1d(one, two, True), np.setdiff1d(two, one, True)
                rows.append((len(one), len(lost), len(two), np.concatenate((lost, added)).tobytes()))
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *(pa.array(c, pa.int32()) for c in columns[:3]), pa.array(columns[3], pa.binary())], ["a", "b", "n_a", "lost", "n_b", "apart"])

    one = texts.select(F.col("key").alias("b"), F.col("text").alias("tb"))
    two = texts.select(F.col("key").alias("a"), F.col("text").alias("ta"))
    return pairs.join(one, "b").join(two, "a").select("a", "b", "ta", "tb").mapInArrow(run, _COMPARED)


def _similarity_to_pivot() -> Column:
    """Of rows of _COMPARED."""
    both = F.col("n_a") - F.col("lost")
    return both / (F.col("lost") + F.col("n_b"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Members of a pivot's group packed into chunks: a, chunk, n_a, and arrays of keys, components, lost, sizes, items and their counts."""
    schema = "a long, chunk int, n_a int, keys binary, components binary, lost binary, sizes binary, counts binary, items binary"

    def run(t: pa.Table) -> pa.Table:
        whole = lambda c, kind: pa.array([t.column(c).to_numpy().astype(kind).tobytes()], pa.binary())
        apart = t.column("apart").to_pylist()
        return pa.table({
            "a": t.column("a").slice(0, 1), "chunk": t.column("chunk").slice(0, 1), "n_a": t.column("n_a").slice(0, 1), "keys": whole("b", "<i8"), "components": whole("component", "<i8"), "lost": whole("lost", "<i8"), "sizes": whole("n_b", "<i8"),
            "counts": pa.array([np.array([len(x) // 8 for x in apart], "<i8").tobytes()], pa.binary()), "items": pa.array([b"".join(apart)], pa.binary()),
        })

    return rows.select("a", "chunk", "n_a", "b", "component", "lost", "n_b", "apart").groupBy("a", "chunk").applyInArrow(run, schema)


_PARTS = ("keys", "components", "lost", "sizes", "counts", "items")


def _across(similarity: float):
    """Pairs of components that a link between members of two chunks joins; one row for each member and other component.

    Both differ from one pivot in known items, so their common part follows from how many of these items they share,
    which is counted for all members of the other chunk at once in an index of its items.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                mine, other = (dict(zip(_PARTS, (np.frombuffer(row[f"{s}{c}"], "<u8" if c == "items" else "<i8") for c in _PARTS))) for s in ("", "o_"))
                owner = np.repeat(np.arange(len(other["keys"])), other["counts"])
                order = np.argsort(other["items"], kind="stable")
                items, owner = other["items"][order], owner[order]
                bounds = np.concatenate(([0], np.cumsum(mine["counts"])))
                for i in range(len(mine["keys"])):
                    own = mine["items"][bounds[i] : bounds[i + 1]]
                    lo, hi = np.searchsorted(items, own, "left"), np.searchsorted(items, own, "right")
                    n = hi - lo
                    at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                    shared = np.bincount(owner[at], minlength=len(other["keys"]))
                    both = row["n_a"] - mine["lost"][i] - other["lost"] + shared
                    near = (both >= similarity * (mine["sizes"][i] + other["sizes"] - both)) & (other["components"] != mine["components"][i])
                    if near.any():
                        to = np.unique(other["components"][near])
                        own = mine["components"][i]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(to, own)), pa.array(np.maximum(to, own))], ["a", "b"])

    return run


def near_duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """key and class_id (the smallest key of its class) of every document that has words, one row for each key."""
    spark = docs.sparkSession
    with_checkpoints(spark)
    texts = docs.select(document_key().alias("key"), F.col("text").cast("string").alias("text"))
    signed = sign(docs).checkpoint()
    firsts = signed.groupBy("exact1", "exact2").agg(F.min("key").alias("first"))
    copies = signed.select("key", "exact1", "exact2").join(firsts, ["exact1", "exact2"]).select("key", "first").distinct().checkpoint()
    distinct = signed.join(copies.where("key = first").select("key"), "key", "left_semi").dropDuplicates(["key"]).select("key", "bands", "registers").checkpoint()
    exploded = distinct.select("key", F.explode("bands").alias("band"))
    sizes = exploded.groupBy("band").agg(F.count("*").alias("n"), F.min("key").alias("pivot")).where("n > 1")
    members = exploded.join(sizes, "band").checkpoint()
    pairs_of = lambda rows: rows.where("key != pivot").select(F.col("pivot").alias("a"), F.col("key").alias("b"))
    small = members.where(F.col("n") <= SMALL)
    within = small.where("n > 2").select("band", F.col("key").alias("a")).join(small.where("n > 2").select("band", F.col("key").alias("b")), "band").where("a < b").select("a", "b")
    own = texts.join(distinct.select("key"), "key", "left_semi")
    stars = pairs_of(members.where(F.col("n") > SMALL)).distinct()
    compared = _compared(stars, own).withColumn("similarity", _similarity_to_pivot()).checkpoint()
    found = _verified(_near(pairs_of(small).unionByName(within).distinct(), distinct), own, similarity)
    links = found.unionByName(compared.where(F.col("similarity") >= similarity).select("a", "b")).checkpoint()
    labels = connected_components(links)

    # where members of a larger bucket are outside the class of its smallest: these against all that can be near them
    of = lambda side, name: labels.select(F.col("node").alias(side), F.col("component").alias(name))
    groups = compared.join(of("b", "component"), "b", "left").join(of("a", "main"), "a", "left").withColumn("component", F.coalesce("component", "b")).withColumn("outside", F.col("component") != F.coalesce("main", "a"))
    mixed = groups.where("outside").groupBy("a").agg(F.max("similarity").alias("nearest"))
    # distances obey the triangle inequality: a link reaches members at most 1 - similarity nearer to the pivot
    reach = F.col("outside") | (F.col("similarity") <= F.col("nearest") + (1 - similarity) + 1e-9)
    open_groups = groups.join(mixed, "a").where(reach).checkpoint()
    if open_groups.limit(1).count():
        size = F.greatest(F.ceil(F.count("*") / F.lit(CHUNK)), F.ceil(F.sum(F.octet_length("apart")) / F.lit(CHUNK_BYTES)))
        chunks = open_groups.groupBy("a").agg(size.cast("int").alias("chunks"))
        chunked = open_groups.join(chunks, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"))
        others = _blocks(chunked).select("a", F.col("chunk").alias("meets"), *(F.col(c).alias(f"o_{c}") for c in _PARTS))
        asked = _blocks(chunked.where("outside")).join(chunks, "a").withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        more = asked.join(others, ["a", "meets"]).select("n_a", *_PARTS, *(f"o_{c}" for c in _PARTS)).mapInArrow(_across(similarity), "a long, b long").distinct()
        # the graph of components is small: only what these links join gets a new label
        joined = connected_components(more).select(F.col("node").alias("component"), F.col("component").alias("joined"))
        known = copies.where("key = first").select(F.col("key").alias("node")).join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        labels = known.join(joined, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
    return copies.join(labels.withColumnRenamed("node", "first"), "first", "left").groupBy("key").agg(F.min(F.coalesce("component", "first")).alias("class_id"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id and is_first (whether it is the one of its class that stays) of every row."""
    classes = near_duplicate_classes(docs, similarity)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), document_key().alias("key"))
    return keyed.join(classes, "key", "left").select("doc_id", F.coalesce("class_id", "key").alias("class_id"), (F.coalesce("class_id", "key") == F.col("key")).alias("is_first"))
