"""Language identification by rank-order profiles of character n-grams.

Runs of letters, lower-cased, with one boundary mark between them, give n-grams of one to three characters. A language's profile
is its ``PROFILE`` most frequent n-grams over all its documents; a document's is made likewise of its whole text. The
distance of a document to a language is the sum, over the document's n-grams, of how far their ranks lie apart, at
most ``PROFILE`` each; the nearest language is predicted.

Defined results. Null text, or one without a letter: ``und``, score 0; so is everything if no language was learned.
Ties: the smaller name. An n-gram is known by the code points of its characters. Texts are read in slices of about
``SLICE`` characters, which lose and double no n-gram. Score: the gap between the two nearest languages over the second distance; with one language, one
minus the distance over its maximum.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import document_key

PROFILE, SLICE, GROUP_BYTES, FARTHEST = 300, 1 << 19, 1 << 20, 0.95
STEPS, LEAST, ALL = 1000, 10, 3
#: Bits of a character in a code of three; the boundary mark is 0, and _NONE stands where an n-gram has ended.
_BITS, _NONE = 21, (1 << 21) - 1
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def _slices(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Characters (0: boundary, runs of them closed up) of about SLICE characters at a time, the index of the text of each, and
    from where on n-grams start in the next slice.

    A text that is cut in a run of letters goes on in the next slice, which begins without a mark; this one looks two
    characters into it.
    """
    table = letters()

    def made(parts: list[str], numbers: list[int], marked: bool, ahead: str) -> tuple[np.ndarray, np.ndarray, int]:
        joined = "\n" * marked + "\n".join(parts) + (ahead or "\n")
        raw = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        raw = np.where(table[raw], raw, 0)
        owner = np.repeat([numbers[0]] * marked + numbers + [numbers[-1]] * bool(ahead), [1] * marked + [len(x) + (i + 1 < len(parts) or not ahead) for i, x in enumerate(parts)] + [len(ahead)] * bool(ahead))
        keep = np.ones(len(raw), bool)
        keep[1:] = (raw[1:] > 0) | (raw[:-1] > 0)
        return raw[keep], owner[keep], int(keep[: len(raw) - len(ahead)].sum()) if ahead else int(keep.sum())

    held, numbers, size, marked = [], [], 0, True
    for i, text in enumerate(texts):
        text = (text or "").lower()
        while text:
            part, ahead = text, ""
            if len(text) > SLICE:
                cut = max(text.rfind(" ", 0, SLICE), text.rfind("\n", 0, SLICE)) + 1 or SLICE
                part, text = text[:cut], text[cut:]
                ahead = (text[:2] + "\n")[:2] if table[ord(part[-1])] else ""
            else:
                text = ""
            if held and size + len(part) > SLICE:
                yield made(held, numbers, marked, "")
                held, numbers, size, marked = [], [], 0, True
            held.append(part)
            numbers.append(i)
            size += len(part)
            if ahead:
                yield made(held, numbers, marked, ahead)
                held, numbers, size, marked = [], [], 0, False
    if held:
        yield made(held, numbers, marked, "")


def _grams(chars: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where n-grams start, before ``limit``, and their three characters; boundaries stand at ends only."""
    letter, n = chars > 0, len(chars)
    one = np.flatnonzero(letter)
    two = np.flatnonzero(letter[:-1] | letter[1:])
    three = np.flatnonzero(letter[1:-1]) if n > 2 else np.zeros(0, np.int64)
    none = lambda at: np.full(len(at), _NONE)
    at = np.concatenate((one, two, three))
    second, third = np.concatenate((none(one), chars[two + 1], chars[three + 1])), np.concatenate((none(one), none(two), chars[three + 2]))
    if limit < n:
        inside = at < limit
        at, second, third = at[inside], second[inside], third[inside]
    return at, chars[at], second, third


def _counted(keys: tuple[np.ndarray, ...], counts: np.ndarray | None = None) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Distinct rows of the keys, sorted by the first, then the second, and the sums of their counts."""
    if len(keys) == 1:
        order = np.argsort(keys[0], kind="stable")
    else:
        order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    new = np.zeros(max(0, len(order) - 1), bool)
    for k in keys:
        new |= k[1:] != k[:-1]
    first = np.flatnonzero(np.concatenate(([True], new))) if len(order) else np.zeros(0, np.int64)
    sums = np.diff(np.append(first, len(order))) if counts is None else np.add.reduceat(counts[order], first) if len(first) else counts
    return tuple(k[first] for k in keys), sums


def _slice_counts(chars: np.ndarray, owner: np.ndarray, limit: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """(owner, code) and counts of a slice. Its own characters are numbered, so that owner and n-gram mostly fit one word."""
    there = np.zeros(1 << _BITS, bool)
    there[chars] = there[0] = there[_NONE] = True
    known = np.flatnonzero(there)
    number = np.zeros(1 << _BITS, np.int64)
    number[known] = np.arange(len(known))
    at, a, b, c = _grams(chars, limit)
    # an n-gram that begins with the mark before a text belongs to the text of its next character
    whose = owner[np.minimum(at + (a == 0), len(owner) - 1)].astype(np.int64)
    bits = max(1, int(len(known) - 1).bit_length())
    low = (number[a] << 2 * bits) | (number[b] << bits) | number[c]
    base = int(whose[0]) if len(whose) else 0
    if (int(whose.max(initial=0)) - min(base, int(whose.min(initial=base)))).bit_length() + 3 * bits < 63:
        base = int(whose.min(initial=base))
        packed = np.sort((whose - base) << 3 * bits | low)
        first = np.flatnonzero(np.concatenate(([True], packed[1:] != packed[:-1]))) if len(packed) else np.zeros(0, np.int64)
        counts, packed = np.diff(np.append(first, len(packed))), packed[first]
        whose, low = (packed >> 3 * bits) + base, packed & ((1 << 3 * bits) - 1)
    else:
        (whose, low), counts = _counted((whose, low))
    mask = (1 << bits) - 1
    return (whose, known[low >> 2 * bits] << 2 * _BITS | known[low >> bits & mask] << _BITS | known[low & mask]), counts


def _document_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, code and count, sorted."""
    parts = [_slice_counts(*x) for x in _slices(texts)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return *parts[0][0], parts[0][1]
    keys, counts = _counted(tuple(np.concatenate([p[0][j] for p in parts]) for j in (0, 1)), np.concatenate([p[1] for p in parts]))
    return *keys, counts


def _ranges(column: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of runs of texts of about ``GROUP_BYTES`` together, so that the arrays made of them stay small."""
    ends, a = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + GROUP_BYTES, "right")))
        yield a, b - a
        a = b


def _ngram_counts(labelled: DataFrame) -> DataFrame:
    """lang, part, code and n, several rows for one code, from columns text, lang and part of the rows that have a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = list(zip(batch.column("lang").to_pylist(), batch.column("part").to_pylist()))
            names = sorted(set(sources))
            place = {x: i for i, x in enumerate(names)}
            number, none = np.array([place[x] for x in sources], np.int64), np.zeros(0, np.int64)
            keys, counts = (none, none), none
            for start, n in _ranges(batch.column("text")):
                owner, code, some = _document_counts(batch.column("text").slice(start, n).to_pylist())
                keys, counts = _counted((np.concatenate((keys[0], number[start + owner])), np.concatenate((keys[1], code))), np.concatenate((counts, some)))
            source = pa.array(keys[0])
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in names], pa.string()).take(source), pa.array([x for _, x in names], pa.int32()).take(source), pa.array(keys[1]), pa.array(counts.astype(np.int64))], ["lang", "part", "code", "n"])

    return labelled.select("text", "lang", F.col("part").cast("int").alias("part")).where("lang is not null").mapInArrow(count, "lang string, part int, code long, n long")


def _most_frequent(counts: DataFrame, profile: int) -> dict[int, dict[str, list[int]]]:
    """For each part of ``counts`` (lang, part, code, n; one row a code) the profiles of its languages."""
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("part", "lang").orderBy(F.desc("n"), "code")))
    out: dict[int, dict[str, list[int]]] = {}
    for r in ranked.where(F.col("rank") <= profile).orderBy("part", "lang", "rank").collect():
        out.setdefault(r.part, {}).setdefault(r.lang, []).append(r.code)
    return out


def learn_profiles(labelled: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """The codes of each language's most frequent n-grams, most frequent first (ties: smaller code), from columns text and
    lang of all rows; null languages are left out. Only languages x ``profile`` codes come to the driver.
    """
    counts = _ngram_counts(labelled.withColumn("part", F.lit(0))).groupBy("lang", "part", "code").agg(F.sum("n").alias("n"))
    return _most_frequent(counts, profile).get(0, {})


def learn_profiles_and_limits(docs: DataFrame, profile: int = PROFILE) -> tuple[dict[str, list[int]], dict[str, float]]:
    """Profiles of all labelled documents, and for each language the distance beyond which a text is none of it.

    Every labelled document is measured with profiles that nothing of its own third is in. With q the 99th percentile of a
    language's documents and m their median, in steps of 1/``STEPS``, the limit of every language is the largest q + (q - m)
    of any, so that texts in two languages stay. Languages with fewer than ``LEAST`` documents that can be measured so
    have no limit.
    """
    parts = docs.select("text", "lang", _third().alias("part")).where("lang is not null")
    counts = _ngram_counts(parts).groupBy("lang", "code").agg(*(F.sum(F.when(F.col("part") != k, F.col("n"))).alias(f"n{k}") for k in range(3)), F.sum("n").alias(f"n{ALL}"))
    some = counts.select("lang", "code", F.explode(F.array(*(F.struct(F.lit(k).alias("part"), F.col(f"n{k}").alias("n")) for k in range(ALL + 1)))).alias("x"))
    others = _most_frequent(some.select("lang", "code", "x.part", "x.n").where("n is not null"), profile)
    profiles = others.pop(ALL, {})

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = {k: Profiles(x, profile) for k, x in others.items()}
        for batch in batches:
            seen: Counter = Counter()
            for k, model in models.items():
                own = batch.filter(pc.equal(batch.column("part"), k))
                langs, _, far = model.predict_column(own.column("text"))
                seen.update((x, math.ceil(f * STEPS)) for x, y, f in zip(own.column("lang").to_pylist(), langs, far) if y != "und" and x in others[k])
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in seen], pa.string()), pa.array([d for _, d in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())], ["lang", "step", "n"])

    found: dict[str, list[tuple[int, int]]] = {}
    if others:
        for r in parts.mapInArrow(measure, "lang string, step int, n long").groupBy("lang", "step").agg(F.sum("n").alias("n")).orderBy("lang", "step").collect():
            found.setdefault(r.lang, []).append((r.step, r.n))
    limits = {}
    for lang, steps in found.items():
        total = sum(n for _, n in steps)
        if total >= LEAST:
            upto = np.cumsum([n for _, n in steps])
            middle, high = (steps[int(np.searchsorted(upto, share * total))][0] for share in (0.5, 0.99))
            limits[lang] = (2 * high - middle) / STEPS
    return profiles, {lang: max(limits.values()) for lang in limits}


class Profiles:
    """Distances of many texts to all languages."""

    def __init__(self, profiles: dict[str, list[int]], profile: int = PROFILE):
        self.names, self.size = sorted(profiles), profile
        self.codes = np.unique(np.array([c for x in profiles.values() for c in x], np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, np.int64)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, np.array(profiles[name], np.int64)), k] = np.arange(len(profiles[name]))

    def predict_column(self, column: pa.Array) -> tuple[list[str], list[float], list[float]]:
        """``predict`` for a column of any size, some texts at a time."""
        out: tuple[list[str], list[float], list[float]] = ([], [], [])
        for start, n in _ranges(column):
            for whole, part in zip(out, self.predict(column.slice(start, n).to_pylist())):
                whole += part
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Names, scores, and distances to the nearest as a share of the largest possible."""
        owner, code, counts = _document_counts(texts)
        langs, scores, far = ["und"] * len(texts), [0.0] * len(texts), [1.0] * len(texts)
        if not len(owner) or not self.names:
            return langs, scores, far
        # by falling count in each text; a stable sort keeps the order of codes in ties
        most, bits = int(counts.max()), int(owner[-1]).bit_length()
        order = np.argsort(owner << (63 - bits) | most - counts, kind="stable") if most.bit_length() + bits < 63 else np.lexsort((-counts, owner))
        owner, code = owner[order], code[order]
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        top = rank < self.size
        owner, code, rank = owner[top], code[top], rank[top]
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        row = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        row = np.where(self.codes[row] == code, row, len(self.codes))
        there = self.ranks[row]
        apart = np.where(there < 0, self.size, np.minimum(np.abs(there - rank[:, None]), self.size))
        distance = np.add.reduceat(apart, first, axis=0)
        n = np.diff(np.append(first, len(owner)))
        best = distance.argmin(axis=1)
        d1 = distance[np.arange(len(best)), best]
        share = d1 / (self.size * n)
        if len(self.names) > 1:
            d2 = np.partition(distance, 1, axis=1)[:, 1]
            score = np.where(d2 > 0, (d2 - d1) / np.maximum(d2, 1), 0.0)
        else:
            score = 1 - share
        for i, b, s, f in zip(owner[first].tolist(), best.tolist(), score.tolist(), share.tolist()):
            langs[i], scores[i], far[i] = self.names[b], s, f
        return langs, scores, far


def _third():
    """0 to 2; 1 for the documents of ``held_out``. By the text where there is no id."""
    return F.coalesce(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.col("text")).cast("binary")) % 3, F.lit(0)).cast("int")


def held_out(doc_id: str = "doc_id"):
    """True for the third of documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, profiles: dict[str, list[int]], keep: list[str] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, distance and the columns ``keep`` of every row, null doc_id included."""
    kept = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles)
        for batch in batches:
            langs, scores, far = model.predict_column(batch.column("_text"))
            others = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.float64())], [*others, "lang_pred", "score", "distance"])

    start = docs.select(*(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(kept)), F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in start.schema if f.name != "_text") + ", lang_pred string, score double, distance double"
    out = start.mapInArrow(run, schema)
    return out.select(*(F.col(f"_keep_{i}").alias(f"keep_{c}") for i, c in enumerate(kept)), "doc_id", "held_out", "lang_pred", "score", "distance")


def accepted(docs: DataFrame, profiles: dict[str, list[int]], limits: dict[str, float] | None = None, farthest: float = FARTHEST) -> DataFrame:
    """The rows, all columns unchanged, whose text has letters and is no farther from the nearest language than that
    language's limit (a share of the largest distance); ``farthest`` for languages without one. Without any profile, the
    rows that have letters.
    """
    limits = limits or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = Profiles(profiles), letters()
        for batch in batches:
            if model.names:
                langs, _, far = model.predict_column(batch.column("text"))
                good = [x != "und" and f <= limits.get(x, farthest) for x, f in zip(langs, far)]
            else:
                good = [any(table[ord(c)] for c in t or "") for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learn_and_identify(docs: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Profiles from the labelled rows that are not held out, then predictions for all rows."""
    return identify(docs, learn_profiles(docs.where(~held_out())), keep)
