"""Lines and passages against plain models over made-up documents with nulls, ties, repeated rows and extra columns."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from turnloom.llm import _blocks, line_dedup, substring_dedup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, key string, block int, part int, rest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def make(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "k", 1, 2, "r") for i, t in enumerate(texts)], SCHEMA).repartition(5)


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    shared = [[word() for _ in range(n)] for n in (20, 25, 60, 19)]
    texts = []
    for i in range(120):
        words = [word() for _ in range(rng.randint(0, 80))]
        for s in rng.sample(shared, rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = s
        texts.append("".join(w + rng.choice([" ", "\n", "\t", "  ", "\x0b"]) for w in words))
    return texts + [None, "", " \n ", "a " * 200, "a " * 40, texts[0], texts[0], "w" * 50_000, "\x1c\x85  x"]


def removed_by_model(texts, window):
    seen, out = set(), []
    for text in texts:
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            run = tuple(words[k : k + window])
            if run in seen:
                gone[k : k + window] = [True] * window
            seen.add(run)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((len(words), sum(gone), sha(kept), kept))
    return out


@pytest.mark.parametrize("window", [20, 7, 2, 45])
def test_passages(spark, window):
    texts = corpus()
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.dedup_substrings(make(spark, texts), window, True).collect()}
    assert got == dict(enumerate(removed_by_model(texts, window)))


def test_passages_with_null_and_repeated_ids(spark):
    run = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(None, run), (1, run), (1, run), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id is None, r.n_words, r.n_removed) for r in substring_dedup.dedup_substrings(df).collect()))
    assert got == [(False, 30, 0), (False, 30, 30), (True, 0, 0), (True, 30, 30)]
    assert substring_dedup.dedup_substrings(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.levels(1)


def line_model(texts, least, docs):
    def key(line):
        k = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\r\x0b\x0c"))
        return k if len(k) >= least else None

    holders = defaultdict(set)
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            if key(line) is not None:
                holders[key(line)].add(i)
    out = []
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        stays = [key(x) is None or len(holders[key(x)]) < docs or max(holders[key(x)]) == i for x in lines]
        kept = "\n".join(x for x, s in zip(lines, stays) if s)
        out.append((len(lines), stays.count(False), sha(kept), kept, stays))
    return out


def line_corpus():
    rng = random.Random(5)
    pool = ["Common Line é " * 4, "x" * 40, "x" * 39, "ÄÖÜ" * 14, " spaced " * 6, "once"]
    texts = []
    for i in range(80):
        lines = [rng.choice([p, p.upper() if p[0] == "x" else p, "\t" + p + " \r"]) for p in rng.choices(pool, k=rng.randint(0, 5))] + [f"own line of document {i}, long enough to count as one"]
        rng.shuffle(lines)
        texts.append("\n".join(lines))
    return texts + [None, "", "\n\n", "x" * 40 + " "]


def test_lines_and_bitmaps(spark):
    texts = line_corpus()
    want = line_model(texts, 40, 5)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(make(spark, texts), with_text=True).collect()}
    for i, (n, dropped, digest, kept, stays) in enumerate(want):
        r = got[i]
        assert (r.n_lines, r.n_dropped, r.kept_sha256, r.kept_text) == (n, dropped, digest, kept)
        assert line_dedup.kept_lines(r.keep_bitmap, n) == stays


def test_lines_of_whole_documents_keep_columns(spark):
    texts = line_corpus()
    out = line_dedup.without_shared_lines(make(spark, texts))
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    got = {r.doc_id: r.text for r in out.collect()}
    want = line_model(texts, 40, 5)
    assert got == {i: None if t is None else want[i][3] for i, t in enumerate(texts)}
    assert line_dedup.without_shared_lines(make(spark, texts).limit(0)).count() == 0


def test_lines_with_null_and_repeated_ids(spark):
    line = "a line that is shared by several documents here"
    df = spark.createDataFrame([(i, line) for i in (1, 2, 3, 9, 9)] + [(None, line)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_dropped) for r in line_dedup.dedup_lines(df).collect())
    assert got == [(False, 1, 1), (False, 2, 1), (False, 3, 1), (False, 9, 1), (False, 9, 1), (True, 0, 0)]
    assert line_dedup.dedup_lines(df.where("doc_id > 1")).agg(F.sum("n_dropped")).first()[0] == 0


def test_levels_double():
    assert substring_dedup.levels(20) == [5, 10, 20] and substring_dedup.levels(100) == [7, 13, 25, 50, 100] and substring_dedup.levels(2) == [1, 2]
    for n in range(2, 300):
        lengths = substring_dedup.levels(n)
        assert lengths[-1] == n and all(a < b <= 2 * a for a, b in zip(lengths, lengths[1:]))


@pytest.fixture()
def in_two_steps(monkeypatch):
    monkeypatch.setattr(_blocks.Exchange, "planned", staticmethod(lambda *_: _blocks.Exchange(11, 13, 3, 4)))


def test_two_steps_give_the_same_rows(spark, in_two_steps):
    texts = corpus()
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.dedup_substrings(make(spark, texts), 20, True).collect()}
    assert got == dict(enumerate(removed_by_model(texts, 20)))
    texts = line_corpus()
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.dedup_lines(make(spark, texts)).collect()}
    assert got == {i: w[:3] for i, w in enumerate(line_model(texts, 40, 5))}
    assert line_dedup.dedup_lines(make(spark, texts).limit(0)).count() == 0 and substring_dedup.dedup_substrings(make(spark, texts).limit(0)).count() == 0


def test_rows_between_steps_hold_many_items():
    """100 TB: no row for each pair of a block and a range."""
    x = _blocks.Exchange.planned(100 << 40, 1.0, 10_000)
    items = (100 << 40) / 16
    assert x.blocks * x.groups < items / 200 and x.districts * x.ranges < items / 200
    assert x.by_group * x.groups >= x.ranges and x.by_district * x.districts >= x.blocks
    small = _blocks.Exchange.planned(1 << 30, 1.0, 32)
    assert small.groups == 0


def test_lines_of_tables_with_columns_that_are_never_null(spark):
    rows = [(i, "one line that five documents share, of over forty", i * 2, ["a"]) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rest int, block array<string>").withColumns({"part": F.lit(3), "key": F.struct(F.lit(1).alias("text"))})
    out = line_dedup.without_shared_lines(df)
    assert out.columns == df.columns and sorted((r.doc_id, r.text != "", r.rest, r.part, r.key.text) for r in out.collect()) == [(i, i == 5, 2 * i, 3, 1) for i in range(6)]
