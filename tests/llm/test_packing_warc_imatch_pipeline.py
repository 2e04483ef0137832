"""Packing, fixity audits, fingerprints and the pipeline."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import assert_same, connect
from pyspark.sql import functions as F

from turnloom.llm import imatch, packing, queries, warc


def test_bins_hold_what_they_say():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.sort(rng.integers(1, 65, rng.integers(0, 300)))[::-1].astype(np.int64)
        bins, offsets, sizes = packing.pack(lengths, (16, 32, 64))
        used = np.bincount(bins, lengths, len(sizes)) if len(bins) else np.zeros(0)
        assert all(u <= s and s == min(c for c in (16, 32, 64) if c >= u) for u, s in zip(used, sizes))
        places = defaultdict(list)
        for b, o, n in zip(bins.tolist(), offsets.tolist(), lengths.tolist()):
            places[b].append((o, n))
        for some in places.values():
            end = 0
            for o, n in sorted(some):
                assert o == end
                end = o + n
    lengths = np.sort(rng.integers(1, 65, 2000))[::-1].astype(np.int64)
    _, _, sizes = packing.pack(lengths, (16, 32, 64))
    assert sizes.sum() <= 1.02 * lengths.sum()


def naive(lengths, capacities, attention=packing.ATTENTION):
    """The same rules with plain loops: for each item its bin, and the size of each bin."""
    bins, out, pushes = [], [], 0
    for i, length in enumerate(lengths):
        fits = [b for b in bins if b["room"] >= length]
        if fits:
            room = min(b["room"] for b in fits)
            b = max((b for b in fits if b["room"] == room), key=lambda b: b["pushed"])
        else:
            free, best = sum(b["room"] for b in bins), None
            for size in sorted(capacities):
                if size >= length:
                    spare = size - length
                    fill = min(spare, max(0, sum(x for x in lengths[i + 1 :] if x <= spare) - free))
                    cost = size * (1 + attention * size) / (length + fill)
                    if best is None or cost < best[0]:
                        best = (cost, size)
            b = {"number": len(bins), "room": best[1], "used": 0, "pushed": 0}
            bins.append(b)
        pushes += 1
        b["room"] -= length
        b["used"] += length
        b["pushed"] = pushes
        out.append(b["number"])
    return out, [min(c for c in capacities if c >= b["used"]) for b in bins]


def test_bins_match_a_plain_best_fit():
    rng = np.random.default_rng(8)
    for n in (0, 1, 7, 60, 250):
        for top in (3, 20, 65):
            lengths = np.sort(rng.integers(1, top, n))[::-1].astype(np.int64)
            bins, _, sizes = packing.pack(lengths, (16, 32, 64))
            assert (bins.tolist(), sizes.tolist()) == naive(lengths.tolist(), (16, 32, 64))


def test_documents_match_a_plain_best_fit_shard_by_shard(spark, monkeypatch):
    rng = random.Random(2)
    texts = ["w " * rng.choice([0, 1, 5, 5, 40, 300]) for _ in range(150)] + ["v " * 5000, "v " * 4095] * 3
    df = spark.createDataFrame([(i % 100, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, shard int").repartition(3)
    monkeypatch.setattr(packing, "SHARD", 60)
    got, shards = packing.pack_documents(df, (64, 256, 1024)).collect(), defaultdict(list)
    for r in got:
        shards[r.bin_id.rsplit("-", 1)[0]].append(r)
    assert len(shards) > 1 and sorted(r.length for r in got if r.length == 1024) == [1024] * (3 * 4 + 3 * 4)
    for rows in shards.values():
        lengths = sorted((r.length for r in rows), reverse=True)
        bins, sizes = naive(lengths, (64, 256, 1024))
        content = defaultdict(list)
        for n, b in zip(lengths, bins):
            content[b].append(n)
        mine = defaultdict(list)
        for r in rows:
            mine[r.bin_id, r.capacity].append(r.length)
        assert sorted((c, sorted(x)) for (_, c), x in mine.items()) == sorted((sizes[b], sorted(x)) for b, x in content.items())


def test_rows_of_one_id_are_dealt_to_several_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 50)
    df = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b").alias("text"))
    sizes = packing.pack_documents(df).groupBy(F.substring_index("bin_id", "-", 2)).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 100


def test_several_sizes_cost_less_than_one():
    lengths = np.array([33] * 40, np.int64)
    assert packing.pack(lengths, (40, 64))[2].tolist() == [40] * 40 and packing.pack(lengths, (64,))[2].sum() == 64 * 40


def test_every_word_is_packed_once(spark):
    texts = {1: "a b c", 2: None, 3: "", 4: "x " * 20_000, 5: " \n ", 6: "w\x0bw", 7: "y " * 8191}
    df = spark.createDataFrame([(i, t, 7) for i, t in texts.items()] + [(1, "a b c", 7), (None, "q", 7)], "doc_id long, text string, capacity int")
    got = packing.pack_documents(df).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append((r.start, r.length))
        assert r.offset + r.length <= r.capacity
    assert sorted(by_doc[4]) == [(0, 8192), (8192, 8192), (16384, 3617)] and by_doc[7] == [(0, 8192)] and by_doc[1] == [(0, 4), (0, 4)] and by_doc[2] == [(0, 1)] and by_doc[6] == [(0, 3)] and by_doc[None] == [(0, 2)]
    used = defaultdict(int)
    for r in got:
        used[(r.bin_id, r.capacity)] += r.length
    assert all(u <= c and c == min(s for s in packing.CAPACITIES if s >= u) for (_, c), u in used.items())
    assert packing.pack_documents(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(6)
    rows = [(i, f"http://h{i % 3}/p{i}", "<html>" + "é" * rng.randint(0, 900) + "</html>", "x") for i in range(1200)] + [(1300, None, None, "x"), (None, "u", "h", "x"), (None, None, None, "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest2 string")


def test_records_and_files_agree(spark, pages, tmp_path):
    rows = warc.records_of_pages(pages.where("page_id < 300")).orderBy("archive", "offset").collect()
    files = defaultdict(list)
    for r in rows:
        files[r.archive].append(r.record.encode())
        assert hashlib.sha256(r.record.encode()).hexdigest() == r.digest and len(r.record.encode()) == r.length
    for name, records in files.items():
        (tmp_path / name).write_bytes(b"".join(records))
        assert [(o, n, x) for o, n, x in warc.parse_warc(b"".join(records))][-1][2] == records[-1]
    got = {(r.archive, r.offset): (r.length, r.digest) for r in warc.scan_warc(spark, str(tmp_path)).collect()}
    assert got == {(r.archive, r.offset): (r.length, r.digest) for r in rows}
    packed = warc.compressed([b"one", b"two"])
    assert [x for _, _, x in warc.parse_warc(packed)] == [b"one", b"two"]


def record(n, body):
    return b"WARC/1.1\r\nContent-Length: %s\r\n\r\n" % n + body + b"\r\n\r\n"


def test_damaged_archives_are_read_to_the_end():
    good = [record(b"%d" % len(b), b) for b in (b"a" * 50, b"b\r\n\r\nb" * 9, b"", b"c" * 500)]
    whole = b"".join(good)
    for bad in (record(b"abc", b"x" * 29), record(b"-37", b"x" * 29), record(b"9" * 30, b"x"), record(b"28", b"x" * 29), record(b"99999", b"x"), record(b"", b"x"), b"junk without a head\r\n\r\n"):
        for k in range(len(good) + 1):
            parts = good[:k] + [bad] + good[k:]
            got = list(warc.parse_warc(b"".join(parts)))
            if k or bad.startswith(b"WARC"):
                assert [r for _, _, r in got] == parts
            assert [o + n for o, n, _ in got][:-1] == [o for o, _, _ in got][1:] and b"".join(r for _, _, r in got) == b"".join(parts)
    packed = [warc.compressed([r]) for r in good]
    for k in range(len(packed)):
        hurt = bytearray(packed[k])
        hurt[len(hurt) // 2] ^= 255
        got = list(warc.parse_warc(b"".join(packed[:k]) + bytes(hurt) + b"".join(packed[k + 1 :])))
        assert [r for _, _, r in got] == good[:k] + [bytes(hurt)] + good[k + 1 :]
    got = list(warc.parse_warc(b"".join(packed)[:-3]))
    assert [r for _, _, r in got] == good[:-1] + [packed[-1][:-3]] and list(warc.parse_warc(b"")) == [] and len(whole)


def test_archives_are_read_in_linear_time():
    import time

    rng = random.Random(1)
    packed = warc.compressed([record(b"900", rng.randbytes(900)) for _ in range(20_000)])
    begun = time.process_time()
    assert sum(1 for _ in warc.parse_warc(packed)) == 20_000
    assert time.process_time() - begun < 10


def test_audit_of_clashing_columns_and_repeated_pages(spark):
    rows = [(1, "u", "h", "a", 5), (1, "u", "h", "a", 5), (1, "v", "h2", "b", 6), (None, "u", "h", "c", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, archive string, offset int").withColumn("digest", F.lit("d")).withColumn("record", F.lit("r"))
    records = warc.records_of_pages(pages)
    assert records.count() == 4 and records.select("archive", "offset").distinct().count() == 4
    bad = records.withColumn("digest", F.when(F.col("offset") == 0, "x").otherwise(F.col("digest")))
    assert {r.status for r in warc.audit(records, bad).collect()} == {"corrupt"} and warc.audit(records, records).count() == 0
    assert warc.audit(warc.records_of_pages(pages.limit(0)), records).where("status = 'extra'").count() == 4


def test_audit_names_exactly_the_faults(spark, pages):
    records = warc.records_of_pages(pages).drop("record")
    assert warc.audit(records, records).count() == 0
    bad, lost, more = {17, 555, 1300}, {3, 1199}, [("pages-1", 10**9, 5, "d"), ("new", 0, 5, "d")]
    copy = records.withColumn("digest", F.when(F.col("page_id").isin(*bad), "rot").otherwise(F.col("digest"))).where(~F.coalesce(F.col("page_id").isin(*lost), F.lit(False)))
    copy = copy.select("archive", "offset", "length", "digest").unionByName(spark.createDataFrame(more, "archive string, offset long, length long, digest string"))
    got = {(r.archive, r.offset): r.status for r in warc.audit(records, copy).collect()}
    where = {r.page_id: (r.archive, r.offset) for r in records.collect() if r.page_id is not None}
    assert got == {where[i]: "corrupt" for i in bad} | {where[i]: "missing" for i in lost} | {(a, o): "extra" for a, o, _, _ in more}
    empty = records.limit(0)
    assert warc.audit(empty, empty).count() == 0 and warc.audit(empty, records).count() == records.select("archive", "offset").distinct().count()


def test_changes_reach_the_root(spark, pages):
    records = warc.records_of_pages(pages)
    roots = [warc.merkle_levels(x, 3, 1)[-1].first().hash for x in (records, records, records.withColumn("digest", F.when(F.col("page_id") == 700, "x").otherwise(F.col("digest"))))]
    assert roots[0] == roots[1] != roots[2]


def test_fingerprints(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(3)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(40, 160))) for _ in range(150)] + [None, "", "é", "x y"]
    rows = [(i * 3 - 50, t, "f") for i, t in enumerate(texts)] + [(10_000, texts[5], "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(5)
    got = {r.doc_id: r for r in imatch.fingerprint_documents(df).collect()}
    order = sorted((i, t or "") for i, t, _ in rows)
    for k, (i, t) in enumerate(order):
        after_id, after = order[(k + 1) % len(order)]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b = got[i].fingerprint.split(","), got[after_id].fingerprint.split(",")
        same = sum(x == y != "-" for x, y in zip(a, b))
        want = 1.0 if a == b else same / max(1, sum(x != "-" or y != "-" for x, y in zip(a, b)))
        assert got[i].near_next == pytest.approx(want) and 0 <= got[i].near_edited <= 1
    assert got[10_000].fingerprint == got[5 * 3 - 50].fingerprint
    mean = lambda c: sum(getattr(r, c) for r in got.values()) / len(got)
    assert mean("near_edited") > mean("near_next")


def model_terms(text):
    return [t for t in re.split(r"[^\w]+|_+", text.lower()) if t]


def test_fingerprints_match_a_plain_model(spark, monkeypatch):
    """Lexicon, subsets and their hashes, looked up or joined; terms here are ASCII."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(200)]
    texts = ["".join(w + rng.choice([" ", ", ", "!\n"]) for w in rng.choices(words, k=rng.randint(1, 90))) for _ in range(120)] + ["!leads and trails.", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = [set(model_terms(t or "")) for t in texts]
    low, high = math.ceil(len(texts) * math.exp(-5)), math.floor(len(texts) * math.exp(-1))
    df_of = Counter(t for s in sets for t in s)
    lexicon = {t for t, n in df_of.items() if max(2, low) <= n <= high}
    hash_of = {r.t: r.h for r in spark.createDataFrame([(t,) for t in df_of], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    lists, places = [], []
    for i, s in enumerate(sets):
        known = sorted(hash_of[t] for t in s & lexicon)
        for k, (bit, bits, subsets) in enumerate(imatch.DENSITIES):
            for j in range(subsets):
                some = [h for h in known if h % 2**64 >> bit & 2**bits - 1 == j]
                lists.append((i, len(places), some, j, k))
                places.append((k, j))
    rows = spark.createDataFrame(lists, "i int, n int, c array<bigint>, j bigint, k int").select("i", "n", F.size("c").alias("size"), F.xxhash64("c", "j", "k").alias("h")).orderBy("n").collect()
    want = defaultdict(list)
    for r in rows:
        want[r.i].append(f"{r.h % 2**32:08x}" if r["size"] else "-")
    want = {i: ",".join(x) if set(x) != {"-"} else hashlib.sha256((texts[i] or "").encode()).hexdigest() for i, x in want.items()}
    got = {r.doc_id: tuple(r) for r in imatch.fingerprint_documents(df).collect()}
    assert {i: r[3] for i, r in got.items()} == want and any(len(x) > 64 for x in want.values())
    monkeypatch.setattr(imatch, "LOOKUP", 3)
    assert {r.doc_id: tuple(r) for r in imatch.fingerprint_documents(df).collect()} == got


def test_fingerprints_without_a_lexicon(spark):
    df = spark.createDataFrame([(1, "!alpha one"), (2, "!beta two"), (3, "gamma three!"), (4, "delta")], "doc_id long, text string")
    got = {r.doc_id: r for r in imatch.fingerprint_documents(df).collect()}
    assert all(r.fingerprint == hashlib.sha256(t.encode()).hexdigest() and r.near_next == 0.0 for (_, t), r in zip(df.orderBy("doc_id").collect(), (got[i] for i in (1, 2, 3, 4))))


def test_fingerprints_of_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "w x " * 400_000), (2, "y " * 10), (3, None)], "doc_id long, text string")
    assert sorted(r.n_chars for r in imatch.fingerprint_documents(df).collect()) == [0, 20, 1_600_000]


def test_fingerprint_edge_cases(spark):
    one = spark.createDataFrame([(None, "abcd")], "doc_id long, text string")
    r = imatch.fingerprint_documents(one).first()
    assert (r.doc_id, r.n_chars, r.edited_sha256, r.near_next) == (None, 4, hashlib.sha256(b"abab").hexdigest(), 1.0)
    assert imatch.fingerprint_documents(one.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "doc_id long, text string")
    assert imatch.fingerprint_documents(twice).count() == 3


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, sf_dir, name):
    assert_same(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name])


PIPELINE = "doc_id long, text string, lang string, source string, n_chars int, _class string, key int, row string, block int, place int, rest array<string>, band string"


def pipeline_docs(spark, rows):
    """A table with names that the stages use, and columns that are never null."""
    df = spark.createDataFrame([(i, t, lang, "s", 0, "c", 1, "r", 2, 3, ["x"], "b") for i, t, lang in rows], PIPELINE)
    return df.withColumns({"never": F.lit(1), "part": F.struct(F.lit("p").alias("text"))})


def test_stages_match_plain_models(spark, sf_dir):
    import corpus_pipeline as p
    from test_line_and_substring_dedup import line_corpus, line_model
    from test_near_dup_and_topk import classes, corpus

    stage = dict(p.STAGES)
    lines = line_corpus()
    df = pipeline_docs(spark, [(i, t, "en") for i, t in enumerate(lines)])
    out = stage["lines"](spark, df, sf_dir)
    want = line_model(lines, 40, 5)
    assert out.columns == df.columns and {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {i: (None, None) if t is None else (want[i][3], len(want[i][3])) for i, t in enumerate(lines)}

    texts = corpus()
    rows = [(i, t, "en") for i, t in texts.items()]
    df = pipeline_docs(spark, rows + rows[:3])
    out = stage["near_duplicates"](spark, df, sf_dir)
    assert out.columns == df.columns and {r.doc_id: r.text for r in out.collect()} == {i: texts[i] for i, c in classes(texts).items() if c == i} and out.count() == out.select("doc_id").distinct().count()

    from turnloom.llm import pii

    rows = [(1, "write to a.b@c.org or +49 170 1234567 now", "en"), (2, "clean text", "en"), (3, None, "en"), (3, None, "en"), (None, "ip 10.1.2.3", "en")]
    out = stage["personal_data"](spark, pipeline_docs(spark, rows), sf_dir)
    assert sorted(map(str, (r.text for r in out.collect()))) == sorted(str(t if t is None else pii.redact(t, pii.base_spans(t))) for _, t, _ in rows)

    out = stage["packed"](spark, pipeline_docs(spark, rows), sf_dir)
    assert sorted((str(r.doc_id), r.length) for r in out.collect()) == sorted((str(i), len((t or "").split()) + 1) for i, t, _ in rows)


def test_the_language_stage_matches_a_plain_model(spark, sf_dir):
    """Kept are texts with letters no farther from the nearest profile than its limit, both worked out with plain loops."""
    import zlib

    import corpus_pipeline as p
    from test_language_bpe_pii import model_profile

    from turnloom.llm.language_id import LEAST, PROFILE, STEPS

    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars < 1500").collect()]
    docs += [(90_001, "zzqx vvkw xqzj " * 20, None), (90_002, "123 456", "en"), (90_003, None, None), (90_004, "", "de"), (90_005, "日本語の文章です" * 9, None)]
    third = {i: zlib.crc32(str(i).encode()) % 3 for i, _, _ in docs}

    def profiles(rows):
        return {x: model_profile([t for _, t, y in rows if y == x], PROFILE) for x in {y for _, _, y in rows if y} if any(y == x and any(c.isalpha() for c in t or "") for _, t, y in rows)}

    def nearest(text, known):
        own = model_profile([text], PROFILE)
        if not own:
            return None, 1.0
        ranks = {x: {g: k for k, g in enumerate(q)} for x, q in known.items()}
        far = {x: sum(min(abs(q[g] - k), PROFILE) if g in q else PROFILE for k, g in enumerate(own)) for x, q in ranks.items()}
        best = min(sorted(far), key=far.get)
        return best, far[best] / (PROFILE * len(own))

    others = {k: profiles([d for d in docs if third[d[0]] != k]) for k in range(3)}
    steps = defaultdict(list)
    for i, t, lang in docs:
        if lang in others[third[i]]:
            name, far = nearest(t, others[third[i]])
            if name:
                steps[lang].append(math.ceil(far * STEPS))
    limit = {}
    for lang, x in steps.items():
        if len(x) >= LEAST:
            x.sort()
            middle, high = (x[math.ceil(q * len(x)) - 1] for q in (0.5, 0.99))
            limit[lang] = (2 * high - middle) / STEPS
    known, keep = profiles(docs), set()
    for i, t, _ in docs:
        name, far = nearest(t, known)
        if name and far <= (max(limit.values()) if name in limit else 0.95):
            keep.add(i)
    out = dict(p.STAGES)["language"](spark, pipeline_docs(spark, docs), sf_dir)
    assert {r.doc_id for r in out.collect()} == keep and not {90_001, 90_002, 90_003, 90_004, 90_005} & keep and len(keep) > 0.95 * len(docs) - 6


def test_an_empty_table_passes_through_the_pipeline(spark, sf_dir):
    import corpus_pipeline as p

    df = pipeline_docs(spark, [(1, "a", "en")]).limit(0)
    for name, stage in p.STAGES[:-1]:
        df = stage(spark, df, sf_dir)
        assert df.count() == 0, name
    assert p.STAGES[-1][1](spark, df, sf_dir).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["language", "lines", "near_duplicates", "personal_data", "packed"]
    junk = spark.createDataFrame([(90_000, "123 456", "en", "s", 7), (90_001, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(junk)
    columns, before = docs.columns, docs.count()
    seen = []
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
        assert docs.columns == columns
        seen.append(docs.count())
    assert seen[0] == before - 2 and seen[1] == seen[0] and seen[2] < seen[1] and seen[3] == seen[2]
    texts = {r.doc_id: r for r in docs.collect()}
    assert all(r.n_chars == len(r.text) for r in texts.values())
    from turnloom.llm import near_dup, pii

    assert not any(pii.base_spans(r.text) for r in texts.values())
    assert near_dup.near_duplicates(docs).where("not is_first").count() <= 1  # redaction may make two texts alike
    packed = p.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.agg(F.sum("length")).first()[0] == sum(len(r.text.split()) + 1 for r in texts.values())
    assert p.run(spark, sf_dir).where("doc_id < 90000").count() == packed.count()
