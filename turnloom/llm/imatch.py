"""I-Match fingerprints of documents, in DataFrame functions only.

A term is a run of letters and digits of the lower-cased text. The lexicon holds the terms
whose inverse document frequency, ln(documents / documents with the term), lies in a chosen band; a document keeps its
distinct terms of the lexicon, sorted by their 64-bit hashes. ``SUBSETS`` randomised subsets of the lexicon leave as many short lists, whose
hashes are the fingerprint; two fingerprints are as like as the share of equal hashes among the subsets that either
document has terms of.

The subsets come in five densities, from a quarter of the lexicon to a 1024th, so that texts of ten terms and of ten
thousand both have subsets of which they hold one or two terms: those survive when half of a text is rewritten. Which
subset of a density a term is in is read from bits of its hash that no other density uses. The four densest subsets divide the
whole lexicon, so each of its terms is in one.

Size of the lexicon: a term of the band occurs in at least exp(-``IDF_BAND``[1]) of all documents, so there are at most
(mean number of distinct terms) x exp(``IDF_BAND``[1]) of them, however many documents there are. Up to ``LOOKUP`` terms
go with the tasks as one hash table, in which each term of a text is looked up once; a larger lexicon is joined as a table.

Defined results. Null text: like empty text. A text with no term of the lexicon has its SHA-256 as fingerprint, which
is like an equal one only. Null doc_id: ordered after all ids, by a hash of the text; rows of one doc_id are ordered by
text. The only row of a table is its own next document. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import document_key, shuffle_partitions, with_checkpoints

IDF_BAND = (1.0, 5.0)
LOOKUP = 1 << 17
#: For each density: first bit of a term's hash, number of bits, and how many of the 2 ** bits values are subsets.
DENSITIES = ((0, 2, 4), (2, 4, 8), (6, 6, 16), (12, 8, 16), (20, 10, 16))
SUBSETS = sum(n for _, _, n in DENSITIES)


def terms(text: Column) -> Column:
    """The distinct terms; an empty string may be among them and is in no lexicon."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def learn_lexicon(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """The column ``term`` of the band's terms, from all documents."""
    n = docs.count()
    seen = docs.select(F.explode(terms(F.coalesce(F.col("text"), F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    low, high = math.ceil(n * math.exp(-band[1])), math.floor(n * math.exp(-band[0]))
    return seen.where(F.col("df").between(max(2, low), high) & (F.col("term") != "")).select("term")


def lookup_table(lexicon: DataFrame, most: int) -> list[str] | None:
    """The lexicon as a hash table: place pmod(xxhash64(term), places) holds `` term ... ``. None if there are over ``most`` terms."""
    n = lexicon.count()
    if n > most:
        return None
    places = [[] for _ in range(n)]
    for r in lexicon.select("term", F.pmod(F.xxhash64("term"), F.lit(max(1, n))).alias("place")).collect():
        places[r.place].append(r.term)
    return [f" {' '.join(sorted(p))} " for p in places]


def with_known(docs: DataFrame, text: str, lexicon: DataFrame, table: list[str] | None) -> DataFrame:
    """The rows with ``known``: the sorted hashes of the lexicon's terms that are in the column ``text``.

    Each term is looked up in the ``table``; without one the lexicon is joined, on rows of key and text.
    """
    if table is not None:
        places, n = F.split(F.lit("|".join(table)), r"\|"), max(1, len(table))
        there = F.filter(terms(F.col(text)), lambda t: F.contains(F.get(places, F.pmod(F.xxhash64(t), F.lit(n)).cast("int")), F.concat(F.lit(" "), t, F.lit(" "))))
        return docs.withColumn("known", F.sort_array(F.transform(there, lambda t: F.xxhash64(t))))
    rows = docs.withColumn("text_hash", F.sha2(text, 256))
    met = rows.select("key", "text_hash", F.explode(terms(F.col(text))).alias("term")).distinct().join(lexicon, "term")
    known = met.groupBy("key", "text_hash").agg(F.sort_array(F.collect_list(F.xxhash64("term"))).alias("known"))
    return rows.join(known, ["key", "text_hash"], "left").withColumn("known", F.coalesce("known", F.array().cast("array<bigint>"))).drop("text_hash")


def density(known: Column, number: int, bit: int, bits: int, subsets: int) -> Column:
    """The hashes, in hex, of the known terms of each subset of one density; ``-`` for a subset that has none."""
    value = lambda t: F.shiftrightunsigned(t, bit).bitwiseAND(F.lit(2**bits - 1))
    shown = lambda c, j: F.when(F.size(c) > 0, F.lpad(F.lower(F.hex(F.xxhash64(c, j, F.lit(number)).bitwiseAND(F.lit(2**32 - 1)))), 8, "0")).otherwise("-")
    one = lambda kept, j: F.transform(F.array(F.filter(kept, lambda t: value(t) == j)), lambda c: shown(c, j))[0]
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(subsets - 1).cast("long"))
    kept = known if subsets == 2**bits else F.filter(known, lambda t: value(t) < subsets)
    return F.transform(F.array(kept), lambda kept: F.transform(numbers, lambda j: one(kept, j)))[0]


def subset_hashes(known: Column) -> Column:
    return F.concat(*(density(known, k, *d) for k, d in enumerate(DENSITIES)))


def with_fingerprint(docs: DataFrame, text: str, name: str, lexicon: DataFrame, table: list[str] | None) -> DataFrame:
    """The rows with their fingerprint as a column ``name``: the hashes with commas, or the text's SHA-256 if no subset has terms."""
    known = with_known(docs, text, lexicon, table)
    whole = F.transform(F.array("known"), lambda k: F.when(F.size(k) > 0, F.array_join(subset_hashes(k), ",")))[0]
    return known.withColumn(name, F.coalesce(whole, F.sha2(text, 256))).drop("known")


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints as strings."""
    pairs = F.zip_with(F.split(a, ","), F.split(b, ","), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    total = F.size(F.filter(pairs, lambda p: (p.x != "-") | (p.y != "-")))
    same = F.size(F.filter(pairs, lambda p: (p.x != "-") & (p.x == p.y)))
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(same / F.greatest(total, F.lit(1)), F.lit(0.0)))


def _longs(values: list[int | None]) -> str:
    return "array(" + ",".join("CAST(NULL AS BIGINT)" if v is None else f"CAST('{v}' AS BIGINT)" for v in values) + ")"


def _place(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most the key: first among every step-th bound, then among those up to the next."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) or 1
    heads = F.expr(_longs(bounds[::step]))
    parts = F.expr("array(" + ",".join(_longs(bounds[i : i + step]) for i in range(0, len(bounds), step)) + ")")
    head = F.size(F.filter(heads, lambda b: b <= key))
    return F.when(head == 0, 0).otherwise((head - 1) * step + F.size(F.filter(F.get(parts, head - 1), lambda b: b <= key)))


def in_buckets(docs: DataFrame) -> DataFrame:
    """The rows dealt to tasks by ``bucket``, a number for a range of keys between approximate quantiles, so that the order is
    found bucket by bucket. Each bucket also gets the first row of the next one, with ``copied`` 1; the last gets that of
    the first. Only four keys a partition come to the driver.
    """
    wanted = max(16, 4 * shuffle_partitions(docs.sparkSession))
    bounds = sorted(set(docs.agg(F.percentile_approx("key", [i / wanted for i in range(1, wanted)], 20 * wanted)).first()[0] or []))
    bucketed = docs.withColumn("bucket", _place(F.col("key"), bounds))
    first = {r.bucket: r.key for r in bucketed.groupBy("bucket").agg(F.min("key").alias("key")).collect()}
    there = sorted(first)
    before = {b: there[i - 1] for i, b in enumerate(there)}
    keys, places = ([x.get(b) for b in range(len(bounds) + 1)] for x in (first, before))
    copy = F.when(F.expr(_longs(keys))[F.col("bucket")] == F.col("key"), F.expr(_longs(places))[F.col("bucket")].cast("int"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("copied"))
    dealt = bucketed.withColumn("copy", copy).withColumn("place", F.explode(F.when(F.col("copy").isNotNull(), F.array(own, F.struct(F.col("copy").alias("bucket"), F.lit(1).alias("copied")))).otherwise(F.array(own))))
    return dealt.select(*docs.columns, F.col("place.bucket").alias("bucket"), F.col("place.copied").alias("copied")).repartition("bucket")


def with_next(dealt: DataFrame, columns: list[str]) -> DataFrame:
    """Each row of ``in_buckets`` with ``next_<column>``, of the row that follows by ``key`` (then text), after the last the first."""
    order = Window.partitionBy("bucket").orderBy("copied", "key", "text")
    return dealt.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns)).where("copied = 0").drop("bucket", "copied")


def fingerprint_documents(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    base = docs.select(document_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    with_checkpoints(docs.sparkSession)
    lexicon = learn_lexicon(docs, band).checkpoint()
    table = lookup_table(lexicon, LOOKUP)
    marked = with_fingerprint(in_buckets(base), "text", "fingerprint", lexicon, table)
    pairs = with_next(marked, ["text", "fingerprint"]).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - half), F.col("next_text").substr(F.lit(1), half))
    done = with_fingerprint(pairs.withColumn("edited", edited).drop("text", "next_text"), "edited", "edited_fingerprint", lexicon, table)
    return done.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
