"""Language profiles, byte-level BPE and personal data: brute force, another implementation, held-out accuracy."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from turnloom.llm import byte_bpe, language_id, pii
from turnloom.llm.boosting import BoostedTrees

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
AWKWARD = [None, "", " ", "\n\n  x", "a" * 700, "ab" * 300 + "  ", "it's we'll I'D", "é漢字 \x1c\x85٣½", "<|endoftext|>", "1234567 3.14", "👩‍👩‍👧 ok", "\t\ttabs\r\n", "zzz" * 2000]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Encoder(open(RANKS, "rb").read(), public_tokenizers.PATTERN)


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def test_bpe_matches_another_encoder(spark, sf_dir, reference):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(AWKWARD)], "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: tuple(r)[1:] for r in byte_bpe.encode_digests(docs, RANKS, public_tokenizers.PATTERN).collect()}
    want = {i: (len(ids := reference.encode_ordinary(t)), sha(" ".join(map(str, ids))), sha(t)) for i, t in texts.items()}
    assert got == want
    encoded = byte_bpe.encode_documents(docs.where("doc_id >= 10000"), RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.text).decode() for r in byte_bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).collect()} == {i: t for i, t in texts.items() if i >= 10_000}


def test_bpe_on_random_text_and_every_character(reference, coder):
    rng = random.Random(3)
    for _ in range(150):
        text = "".join(rng.choice(rng.choice(["ab", "aA1 \n", "é½漢字  x\x1c\x85", "'sdtlrevm x"])) for _ in range(rng.choice([3, 50, 600])))
        assert coder.encode_text(text) == reference.encode_ordinary(text)
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    assert coder.encode_text(every) == reference.encode_ordinary(every)


def test_bpe_survives_a_small_cache_and_long_texts(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 50)
    monkeypatch.setattr(byte_bpe, "GROUP_CHARS", 400)
    monkeypatch.setattr(byte_bpe, "RUN", 16)
    coder = byte_bpe.Encoder(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(n)) for n in (5, 300, 0, 40, 500, 7)]
    for text, (n, ids, decoded) in zip(texts, byte_bpe._digests(coder, texts), strict=True):
        want = reference.encode_ordinary(text)
        assert (n, ids, decoded) == (len(want), sha(" ".join(map(str, want))), sha(text))


def test_long_pieces_and_matrices_agree(coder):
    rng = random.Random(1)
    for _ in range(40):
        piece = bytes(rng.choice(b"abcab ") for _ in range(rng.randint(2, 250)))
        assert coder._heap(piece) == coder._matrix([piece])[0]


def model_profile(texts, size):
    counts = {}
    for text in texts:
        letters = "".join(c if c.isalpha() else "\0" for c in (text or "").lower())
        marked = "\0" + "\0".join(x for x in letters.split("\0") if x) + "\0"
        for i in range(len(marked)):
            for n in (1, 2, 3):
                some = marked[i : i + n]
                if len(some) == n and "\0" not in some[1:-1] and some.strip("\0"):
                    code = sum((ord(c) if c else 2**21 - 1) << 21 * (2 - k) for k, c in enumerate([*some, "", ""][:3]))
                    counts[code] = counts.get(code, 0) + 1
    return [k for k, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


def test_profiles_and_distances_match_a_plain_model(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "Der Hund, und die Katze!", "de"), (4, None, "de"), (5, "the end", None), (6, "l'été à la mer 12", "fr"), (7, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.learn_profiles(docs)
    assert got == {lang: model_profile([t for _, t, x in rows if x == lang], language_id.PROFILE) for lang in ("de", "en", "fr")}
    model = language_id.Profiles(got)
    texts = ["the dog and", None, "123 !", "Katze und Hund", "été", "x" * 10]
    langs, scores, _ = model.predict(texts)
    assert langs[1:3] == ["und", "und"] and scores[1:3] == [0.0, 0.0]
    for t, lang, s in zip(texts, langs, scores):
        own = model_profile([t], language_id.PROFILE)
        if not own:
            continue
        far = {x: sum(min(abs(p.index(k) - i), language_id.PROFILE) if k in p else language_id.PROFILE for i, k in enumerate(own)) for x, p in got.items()}
        best = min(sorted(far), key=far.get)
        second = sorted(far.values())[1]
        assert lang == best and s == pytest.approx((second - far[best]) / second if second else 0)


def test_slices_lose_no_ngram(monkeypatch):
    rng = random.Random(12)
    texts = ["".join(rng.choice("abc漢字éü.  \n") for _ in range(rng.randint(0, 40))) for _ in range(12)] + ["x" * 50, "ab, " * 9, None, "", "漢" * 33 + "!" + "字" * 31]
    want = [language_id._document_counts([t]) for t in texts]
    for size in (1, 2, 3, 7, 32, 1000):
        monkeypatch.setattr(language_id, "SLICE", size)
        for t, (_, code, n) in zip(texts, want):
            _, c, m = language_id._document_counts([t])
            assert c.tolist() == code.tolist() and m.tolist() == n.tolist()
        owner, code, n = language_id._document_counts(texts)
        for i, w in enumerate(want):
            assert code[owner == i].tolist() == w[1].tolist() and n[owner == i].tolist() == w[2].tolist()


def test_ngrams_of_many_alphabets_and_counts_are_exact():
    text = "".join(chr(i) for i in range(0x110000) if chr(i).isalpha() and not 0xD800 <= i < 0xE000)
    owner, code, n = language_id._document_counts(["aa", text.lower(), "b"])
    assert len(code[owner == 1]) > 250_000 and sorted(n[owner == 0].tolist()) == [1, 1, 1, 1, 1, 2]
    _, code, n = language_id._document_counts(["z " * (2**20 + 5)])
    assert n.max() == 2**20 + 5


def test_language_of_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "the cat and the dog", "en", 5), (1, "the cat and the dog", "en", 5), (2, "der Hund und die Katze", "de", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").withColumns({"lang_pred": F.lit("x"), "_text": F.lit(3), "held_out": F.lit("h")})
    got = language_id.learn_and_identify(docs, ["lang_pred", "_text", "score"]).collect()
    assert len(got) == 3 and all((r.keep_lang_pred, r.keep__text) == ("x", 3) and r.keep_score in (5, 6) for r in got)


def test_language_is_predicted_for_documents_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.learn_and_identify(docs, ["lang"]).collect()
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    out = [r.lang_pred == r.keep_lang for r in got if r.held_out]
    assert sum(out) / len(out) > 0.99


def test_language_edge_cases(spark):
    docs = spark.createDataFrame([(None, "hello", "en"), (1, "x", None)], "doc_id long, text string, lang string")
    got = language_id.learn_and_identify(docs.where("lang is null")).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert language_id.learn_and_identify(docs.limit(0)).count() == 0 and language_id.learn_and_identify(docs).count() == 2
    assert language_id.learn_profiles(docs.limit(0)) == {}
    cut = "ab " * (language_id.SLICE // 2)
    assert language_id.Profiles({"q": [1]}).predict([cut, "z"])[0] == ["q", "q"]
    kept = language_id.accepted(spark.createDataFrame([(1, "ab", "x"), (2, "12", "x"), (3, None, "x")], "doc_id long, text string, lang_pred string"), {})
    assert kept.columns == ["doc_id", "text", "lang_pred"] and [r.doc_id for r in kept.collect()] == [1]


EMAIL, IP, CARD, PHONE = (re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))


def base_model(x):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(x)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(x) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(x) if 13 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and pii.luhn(d)]
    return out + [("phone", m.start(), m.end()) for m in PHONE.finditer(x) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        alphabet = rng.choice(["a@.b-", "0123. -+", "+1(2)3.-  ", "12.3.4+@a-b.", "0 -4", "+123 4(5)6789-0"])
        x = "".join(rng.choice(alphabet) for _ in range(rng.choice([5, 12, 30, 60])))
        assert pii.base_spans(x) == base_model(x)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_pii_query_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.lit("x").alias("spans"))
    docs = docs.unionByName(spark.createDataFrame([(10_000, None, ""), (10_001, "", ""), (10_002, "é a.b@c.de and 1.2.3.4", ""), (10_002, 'token = "' + "0a1b2c3d" * 5 + '"', "")], "doc_id long, text string, spans string"))
    texts = sorted((r.doc_id, r.text or "") for r in docs.collect())
    rows = sorted(pii.find_pii(docs, True).collect(), key=lambda r: (r.doc_id, r.n_email == 0 and r.doc_id == 10_002))
    by_text = {}
    for r in rows:
        by_text.setdefault(r.doc_id, []).append(r)
    for i, t in texts:
        base = base_model(t)
        r = next(x for x in by_text[i] if x.base_sha256 == sha(pii.listed(base)))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in pii.BASE)
        assert r.spans.startswith(pii.listed(base))
    got = {r.spans: r.redacted for r in by_text[10_002]}
    assert got == {"email:2:10,ip:15:22": "é [EMAIL] and [IP]", "secret:9:49": 'token = "[SECRET]"'}
    assert by_text[10_000][0].redacted is None and pii.find_pii(docs.limit(0)).count() == 0


def test_added_spans_are_precise_on_fresh_rows():
    rows, labels = pii.training_rows(400, seed=99)
    chosen = [any(s < e2 and s2 < e for _, s2, e2 in pii.model().choose(t, [])) for t, _, s, e in rows]
    right = sum(c and y for c, y in zip(chosen, labels))
    assert right / sum(chosen) > 0.97 and right / sum(labels) > 0.85
    assert pii.model().choose("Licensed under CC BY-NC 4.0. Version 3.0 of 2024-01-02, see page 12.", []) == []


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    p = BoostedTrees().fit(x[:1500], y[:1500]).calibrate(x[1500:2200], y[1500:2200]).probability(x[2200:])
    assert ((p > 0.5) == y[2200:]).mean() > 0.95 and abs(p.mean() - y[2200:].mean()) < 0.03


def test_long_texts_take_linear_time():
    text = "1" * 100_000 + ".2" * 50_000 + "@" * 1000 + "a" * 100_000 + "=" * 10_000
    assert pii.base_spans(text) is not None and pii.candidates(text) is not None


FOREIGN = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "base64": base64.b64encode(random.Random(1).randbytes(4000)).decode(), "hex": random.Random(2).randbytes(3000).hex(),
    "letters": " ".join("".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=6)) for i in range(300)),
    "no vowels": " ".join("".join(random.Random(i).choices("bcdfghjklmnpqrstvwxz", k=6)) for i in range(300)),
}


def test_texts_unlike_the_labelled_documents_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    names = list(FOREIGN)
    more = [(-1 - i, FOREIGN[x], None) for i, x in enumerate(names)] + [(-100, "That it.", None), (-101, "Von.", None), (-102, "The cat is here.", None)]
    every = docs.unionByName(spark.createDataFrame(more, docs.schema))
    profiles, limits = language_id.learn_profiles_and_limits(every)
    assert sorted(limits) == sorted(profiles) == ["de", "en", "es", "fr"]
    kept = {r.doc_id for r in language_id.accepted(every, profiles, limits).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.collect()} | {-100, -101, -102}


def test_languages_of_few_documents_have_no_limit(spark):
    few = [(i, f"the cat and the dog {'and so on ' * i}", "en") for i in range(30)] + [(100 + i, "ξένο κείμενο", "el") for i in range(3)]
    profiles, limits = language_id.learn_profiles_and_limits(spark.createDataFrame(few, "doc_id long, text string, lang string"))
    assert set(limits) == {"en"} and 0 < limits["en"] < language_id.FARTHEST
    assert language_id.learn_profiles_and_limits(spark.createDataFrame([], "doc_id long, text string, lang string")) == ({}, {})


def test_long_secrets_are_found_whole():
    rng, wide = random.Random(5), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for alphabet in (wide, "0123456789abcdef", wide + "+/", wide + "!$%.,&"):
        for n in (201, 205, 300, 1000, 5000):
            for form in ('token = "%s"', "secret=%s", "the password: %s\n and more"):
                value = "x7" + "".join(rng.choices(alphabet, k=n - 3)) + "Z"
                text = form % value
                base = pii.base_spans(text)
                assert set(pii.redact(text, base + pii.model().choose(text, base)).replace("[SECRET]", "").replace("[CARD]", "")) <= set(form), (alphabet, n, form)
                if not base:
                    assert pii.model().choose(text, base) == [("secret", text.index(value), text.index(value) + n)]
    jwt = ".".join("".join(rng.choices(wide, k=k)) for k in (40, 500, 43))
    for lead in ("token=", "key: ", "Auth token: "):
        assert pii.model().choose(lead + jwt, []) == [("secret", len(lead), len(lead) + len(jwt))]
    slug = "see http://a/" + "/".join(rng.choices(["the", "other", "page", "and", "more"], k=100)) + "/page12"
    assert pii.model().choose(slug, []) == []


def test_a_secret_around_a_card_number_is_left_nowhere():
    value = "a1b2c3d4e5f6" * 10 + "x4111111111111111x" + "f6e5d4c3b2a1" * 10
    text = f"token = {value}"
    base = pii.base_spans(text)
    assert [k for k, _, _ in base] == ["card"] and pii.redact(text, base + pii.model().choose(text, base)) == "token = [SECRET][CARD][SECRET]"


def test_the_pipeline_knows_languages_of_held_out_documents(spark):
    rare = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 3 == 1][:2]
    rows = [(i, f"the cat and the dog {'and so on ' * i}", "en") for i in range(30)] + [(i, "ένα κείμενο σε άλλη γραφή", "el") for i in rare]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles, limits = language_id.learn_profiles_and_limits(docs)
    assert profiles == language_id.learn_profiles(docs) and sorted(profiles) == ["el", "en"]
    assert language_id.accepted(docs, profiles, limits).count() == len(rows)


def test_counts_over_a_million_keep_their_order():
    text = "b " * 1_300_000 + "a " * 1_100_000
    _, codes, counts = language_id._document_counts([text])
    assert counts.max() > 2**20
    own = codes[np.lexsort((codes, -counts))].tolist()
    assert language_id.Profiles({"q": own}).predict([text, "a"])[2][0] == 0


def test_bpe_of_repeated_rows_clashing_columns_and_an_empty_table(spark, reference):
    df = spark.createDataFrame([(1, "to be", 5, "x"), (1, "to be", 5, "x"), (None, None, 5, "x")], "doc_id long, text string, n_tokens int, ids_sha256 string")
    got = byte_bpe.encode_digests(df, RANKS, public_tokenizers.PATTERN).collect()
    want = reference.encode_ordinary("to be")
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256) for r in got) == [(0, 0, sha(""))] + [(1, len(want), sha(" ".join(map(str, want))))] * 2
    empty = df.limit(0)
    assert byte_bpe.encode_digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(empty, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0


def test_the_cache_of_pieces_is_bounded_in_bytes(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 4000)
    coder = byte_bpe.Encoder(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    for i in range(60):
        text = f"{'word' * 30}{i} other"
        assert coder.encode_text(text) == reference.encode_ordinary(text)
        assert 8 * sum(map(len, coder.cache)) <= 4000


def test_added_spans_on_the_tables_are_planted_secrets_only(spark):
    """Every assigned token is found whole, and nothing else is added to what the patterns find."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    planted = re.compile(r'token = "([0-9a-f]{40})"')
    found = wanted = 0
    for r in docs:
        base = pii.base_spans(r.text)
        got = {(s, e) for _, s, e in pii.model().choose(r.text, base)}
        want = {m.span(1) for m in planted.finditer(r.text)}
        assert got == want
        found, wanted = found + len(got), wanted + len(want)
    assert found == wanted > 5
