"""Near duplicates, BagMinHash and exact search against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.llm import bagminhash, near_dup, topk
from turnloom.llm.components import connected_components


def bag(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)]) if words else Counter()


def classes(texts, least=0.8):
    bags = {k: bag(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bags[a] and bags[b]:
                low = sum((bags[a] & bags[b]).values())
                if low / (bags[a].total() + bags[b].total() - low) >= least:
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = str(rng.random())
    return out


def corpus():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for size in (1, 1, 2, 5, 60):  # a group of 60 near copies has buckets that are not compared in full
        base = rng.choices(vocabulary, k=200)
        texts += [" ".join(edited(rng, base, rng.randint(0, 5))) for _ in range(size)]
    passage = rng.choices(vocabulary, k=60)
    texts += [" ".join(passage + rng.choices(vocabulary, k=30)) for _ in range(40)]
    chain = rng.choices(vocabulary, k=100)
    for _ in range(12):  # neighbours are alike, the ends are not
        chain = edited(rng, chain, 2)
        texts.append(" ".join(chain))
    texts += [texts[0], texts[0].upper(), "", " \n", "one two", "One  two", "one two three", "a b a b a b a b a b a b", "a b a b a b a b a b"]
    return dict(enumerate(texts)) | {900: None}


def test_classes_match_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], "doc_id long, text string, band string, key int").repartition(6)
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()}
    assert got == classes(texts)


def test_mixed_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL", 2)
    monkeypatch.setattr(near_dup, "CHUNK", 7)
    texts = corpus()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()} == classes(texts)


def test_null_and_repeated_ids(spark):
    text = " ".join(map(str, range(50)))
    df = spark.createDataFrame([(3, text), (3, text), (None, text), (None, None)], "doc_id long, text string")
    got = near_dup.near_duplicates(df).collect()
    assert len(got) == 4 and [r.class_id for r in got].count(3) == 3 and sum(r.is_first for r in got) == 3
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    items = rng.integers(1, 2**63, 300, dtype=np.uint64)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
    b[:200] = a[:200]
    times = bagminhash.signatures(np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()]), np.concatenate((items[a > 0], items[b > 0])), np.concatenate((a[a > 0], b[b > 0])), 2, 4096)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert np.isfinite(times).all() and abs((times[0] == times[1]).mean() - want) < 4 * (want * (1 - want) / 4096) ** 0.5


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, rng.randint(101, 150)) for _ in range(30)] + [(7, 7), (200, 201), (200, 201)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[201] == 200 and all(c == 100 for n, c in got.items() if 100 <= n < 200)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(700, 40)).astype(np.float32)
    data[300:420] = data[0]
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(1000, None), (1100, [float("nan")] * 40), (1200, [1.0, None]), (1300, []), (None, data[0].tolist()), (1400, [0.5] * 3), (1401, [0.25] * 3), (1500, [float("inf")] * 40)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int, dim int").repartition(7)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    whole = np.floor(data.astype(float) * 1024).astype(np.int64)
    for q in range(0, 700, 100):
        scores = whole @ whole[q]
        want = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if i != q))[:10]
        assert got[q] == {k + 1: (i, -s) for k, (s, i) in enumerate(want)}
    assert got[1400] == {1: (1401, 3 * 512 * 256)} and set(got) == {*range(0, 700, 100), 1400}
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_grid_bounds_copies_and_groups():
    for n, asked, dim, tasks in ((10**9, 10**7, 768, 10_000), (500, 5, 64, 8), (10**6, 10**6, 128, 200), (0, 0, 1, 8)):
        groups, strips = topk.grid(n, asked, dim, tasks)
        rows = topk.rows_of_block(dim)
        assert groups * strips >= min(tasks, max(1, -(-n // rows)) * max(1, -(-asked // rows))) and -(-n // groups) * dim * 8 <= 2 * topk.GROUP_BYTES
    assert topk.rows_of_block(4096) * 4096 * 8 <= topk.BLOCK_BYTES


def test_a_query_block_carries_its_best_over_blocks(monkeypatch):
    """k rows a query and group, whatever the number of blocks; ties to the smaller id."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    q, c = rng.integers(-9, 10, (6, 3)), rng.integers(-9, 10, (6, 400))
    rows = [{"dim": 6, "q_ids": np.arange(3).astype("<i8").tobytes(), "q_matrix": np.ascontiguousarray(q, "<i8").tobytes(), "ids": np.arange(i, i + 50).astype("<i8").tobytes(), "matrix": np.ascontiguousarray(c[:, i : i + 50], "<i8").tobytes()} for i in range(0, 400, 50)]
    out = pa.Table.from_batches(topk._search(5)(iter([pa.RecordBatch.from_pylist(rows[:3]), pa.RecordBatch.from_pylist(rows[3:])]))).to_pylist()
    assert len(out) == 15
    for own in range(3):
        full = c.T @ q[:, own]
        want = sorted((-s, i) for i, s in enumerate(full.tolist()) if i != own)[:5]
        assert [(-r["score"], r["vec_id"]) for r in out if r["query_id"] == own] == want


def test_one_large_group_and_very_long_texts(spark):
    """Copies of one text, all in one bucket, and a text of a million characters."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    texts = {i: " ".join([*base[:-1], f"x{i}"]) for i in range(600)}
    texts |= {1000 + i: " ".join(rng.choices(base, k=40)) for i in range(100)} | {2000: None, 2001: "long " * 200_000}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    assert {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()} == classes(texts)


def test_bounds_never_lose_a_candidate():
    rng = np.random.default_rng(5)
    for k in (1, 3, 10):
        q, c = rng.integers(-500, 500, (50, 4)), rng.integers(-500, 500, (50, 300))
        for own, ids, scores in topk.best_of_block(np.arange(4), q, np.arange(300), c, k):
            full = c.T @ q[:, own]
            want = sorted(((-s, i) for i, s in enumerate(full.tolist()) if i != own))[:k]
            assert list(zip((-scores).tolist(), ids.tolist())) == want


def test_huge_components_are_exact():
    q, c = np.full((2, 1), 2**40), np.array([[2**20, 2**20 + 1], [1, 0]])
    (_, ids, scores), = topk.best_of_block(np.array([9]), q, np.array([1, 2]), c)
    assert ids.tolist() == [1, 2] and scores.tolist() == [2**60 + 2**40] * 2


@pytest.mark.parametrize("rows", [[(5, [1.0]), (5, [1.0]), (6, [2.0]), (6, [2.0])]])
def test_repeated_rows(spark, rows):
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 5).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(1, 6), (2, 6)]
