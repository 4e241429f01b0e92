"""Secrets, telephony, token counts, toxicity, language ID: against brute force, round trips and held-out rows; nulls, empty tables and clashing columns."""

from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import re
import zlib
from collections import Counter
from urllib.parse import quote

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakframe.llm import langid, secrets, telephony, token_counts, toxicity, words
from peakframe.llm.common import documents, scratch
from peakframe.llm.registry import QUERIES

ODD = ["", " ", None, "a", "ünïcode  text　here", "\U0001f600" * 3, "x" * 50_000, "password=hunter22 token: abcdef1 AKIA" + "B" * 16 + " " + "0f" * 20, "same", "same", "a\x1cb", "<|endoftext|> done"]


def odd_docs(spark):
    """Documents with nulls in every column, repeated rows and columns named like the operators' own."""
    rows = [(i if i != 3 else None, t, ["en", "de", None][i % 3], "s" if i % 2 else None, len(t or ""), "was here") for i, t in enumerate(ODD)]
    clash = "fingerprint string, n_bytes string, score string, lang_pred string, secret_spans string, media string, size string, sequence_id string"
    df = spark.createDataFrame([*rows, rows[-1]], "doc_id long, text string, lang string, source string, n_chars long, extra string")
    return df.withColumns({c.split()[0]: F.lit("clash") for c in clash.split(", ")})


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


# --- secrets ---------------------------------------------------------------------------------------------------------
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(out)]


def test_base_spans_of_all_documents(spark, data):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, data).collect()}
    for r in secrets.op1_secret_scan(spark, data).collect():
        want = base_spans(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for x, _, _ in want) for k in secrets.KINDS)
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) <= set(r["spans"].split(","))


SECRET = "password=hunter2secret"


@pytest.mark.parametrize(
    ("hidden", "exact"),
    [
        (quote("password=hunter2secret", safe=""), True), ("".join(f"%{b:02x}" for b in SECRET.encode()), True), ("".join(f"\\u{ord(c):04x}" for c in SECRET), True), ("".join(f"&#{ord(c)};" for c in SECRET), True),
        (base64.b64encode(SECRET.encode()).decode(), True), (base64.urlsafe_b64encode(gzip.compress(SECRET.encode())).decode(), True), (base64.b64encode(bz2.compress(zlib.compress(SECRET.encode()))).decode(), True),
        (quote(base64.b64encode(base64.b64encode(SECRET.encode())).decode(), safe=""), True), ("".join(f"%{b:02x}" for b in zlib.compress(SECRET.encode())), True),
    ],
)
def test_hidden_secrets_map_back(hidden, exact):
    text = f"é lead {hidden} tail"
    spans, layers, _ = secrets.scan(text)
    a = 7
    found = [(s, e) for s, k, e, depth in spans if k == 0 and depth > 0]
    assert layers > 1 and any(a <= s and e <= a + len(hidden) and e - s >= len(hidden) - 3 for s, e in found)


def test_value_encoded_after_plain_name():
    spans, _, _ = secrets.scan("say password = %61%62%63%64%65%66 now")
    assert (4, 0, 33, 1) in spans


def test_cycles_and_bombs_end():
    loop = base64.b64encode(b"A" * 64).decode()
    assert secrets.scan(loop * 3)[1] >= 1
    big = base64.b64encode(gzip.compress(b"a " * 4_000_000)).decode()
    spans, layers, cut = secrets.scan(big, 1 << 20)
    assert cut and layers == 2
    assert secrets.scan("%2525252541")[1] == 6


def test_redaction_and_odd_rows(spark):
    df = secrets.scan_secrets(odd_docs(spark), redacted="clean")
    rows = df.collect()
    assert len(rows) == len(ODD) + 1 and {r["media"] for r in rows} == {"clash"}
    for r in rows:
        if r["text"] is None:
            assert r["secret_spans"] == [] and r["clean"] is None
        elif "hunter22" in r["text"]:
            assert "hunter22" not in r["clean"] and r["clean"].count("[REDACTED]") == 4
        else:
            assert r["clean"] == r["text"]
    assert secrets.scan_secrets(empty(spark)).count() == 0


# --- telephony -------------------------------------------------------------------------------------------------------
def test_telephony_round_trip(spark, data):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in documents(spark, data).collect()}
    for r in telephony.op2_telephony(spark, data).collect():
        raw = texts[r["doc_id"]]
        n = max(1, -(-len(raw) // 576)) * 576
        payload = raw + b"\xff" * (n - len(raw))
        media = telephony.wav(payload)
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"]) == (len(raw), n, len(media))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-32:])
        assert r["media_sha256"] == hashlib.sha256(media).hexdigest() and telephony.opened(media)[2] == payload
        code, rate, sound = telephony.opened(bytes(r["pcm"]))
        assert (code, rate, len(sound)) == (telephony.PCM, 16000, 4 * n) and r["feature"].endswith(f";pcm16000={zlib.crc32(sound):08x}")
        assert np.array_equal(np.frombuffer(sound, dtype="<i2")[::2], [mulaw(x) for x in payload] if n < 5000 else telephony.MU[np.frombuffer(payload, dtype=np.uint8)])


def mulaw(byte):
    """One byte by the definition: sign, exponent and mantissa of the complement, with a bias of 132."""
    u = 255 - byte
    size = ((u % 16) * 8 + 132) * 2 ** (u // 16 % 8) - 132
    return -size if u >= 128 else size


def alaw(byte):
    a = byte ^ 0x55
    exponent, size = a // 16 % 8, a % 16 * 16
    size = size + 8 if exponent == 0 else (size + 264) * 2 ** (exponent - 1)
    return size if a >= 128 else -size


def adpcm_block(block):
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for nibble in (x for byte in block[4:] for x in (byte & 15, byte >> 4)):
        step = int(telephony.STEPS[index])
        size = (step >> 3) + (step if nibble & 4 else 0) + (step >> 1 if nibble & 2 else 0) + (step >> 2 if nibble & 1 else 0)
        value = max(-32768, min(32767, value - size if nibble & 8 else value + size))
        index = max(0, min(88, index + (-1, -1, -1, -1, 2, 4, 6, 8)[nibble & 7]))
        out.append(value)
    return out


def said(samples):
    if not samples:
        return "0.000/0/0"
    return f"{(sum(x * x for x in samples) / len(samples)) ** 0.5:.3f}/{max(map(abs, samples))}/{sum((a < 0) != (b < 0) for a, b in zip(samples, samples[1:], strict=False))}"


def test_features_by_plain_reading(spark):
    rng = np.random.default_rng(9)
    payloads = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 20, 35, 36, 37, 100, 576, 1152)] + [b"\xff" * 576]
    df = spark.createDataFrame([(i, bytearray(telephony.wav(p))) for i, p in enumerate(payloads)], "i int, media binary")
    rows = {r["i"]: r for r in telephony.decode_media(df).collect()}
    for i, p in enumerate(payloads):
        blocks = [p[k : k + 36] for k in range(0, len(p) - 35, 36)]
        want = f"mulaw={said([mulaw(x) for x in p])};alaw={said([alaw(x) for x in p])};adpcm={said([v for b in blocks for v in adpcm_block(b)])};pcm16000="
        assert rows[i]["feature"].startswith(want) and rows[i]["payload_bytes"] == len(p) and len(telephony.opened(bytes(rows[i]["pcm"]))[2]) == 4 * len(p)


def test_expansion_tables():
    mu, a = telephony.MU, telephony.A
    assert (mu[0xFF], mu[0x7F], mu[0x00], mu[0x80]) == (0, 0, -32124, 32124)
    assert (a[0xD5], a[0x55], a[0x2A], a[0xAA]) == (8, -8, -32256, 32256)


def test_adpcm_like_one_sample_at_a_time():
    raw = np.random.default_rng(3).integers(0, 256, (40, 36), dtype=np.uint8)
    for block, got in zip(raw, telephony.adpcm(raw), strict=True):
        value = int(np.int16(int(block[0]) | int(block[1]) << 8 if block[1] < 128 else (int(block[0]) | int(block[1]) << 8) - 65536))
        index, want = min(int(block[2]), 88), [value]
        for byte in block[4:].tolist():
            for nibble in (byte & 15, byte >> 4):
                step = int(telephony.STEPS[index])
                diff = (step >> 3) + (step if nibble & 4 else 0) + (step >> 1 if nibble & 2 else 0) + (step >> 2 if nibble & 1 else 0)
                value = max(-32768, min(32767, value - diff if nibble & 8 else value + diff))
                index = max(0, min(88, index + int(telephony.CHANGES[nibble & 7])))
                want.append(value)
        assert got.tolist() == want


def test_resampling_and_codes(spark):
    x = (8000 * np.sin(np.arange(400) * 0.1)).astype(np.int16)
    y = telephony.doubled(x)
    assert len(y) == 800 and (y[::2] == x).all()
    assert np.abs(y[101:700:2] - 8000 * np.sin((np.arange(50, 350) + 0.5) * 0.1)).max() < 40
    for code in (telephony.MULAW, telephony.ALAW, telephony.IMA):
        df = telephony.decode_media(telephony.encode_media(odd_docs(spark), code=code))
        rows = df.collect()
        assert len(rows) == len(ODD) + 1 and all(telephony.opened(bytes(r["pcm"]))[:2] == (telephony.PCM, 16000) for r in rows)
    bad = spark.createDataFrame([(1, None), (2, bytearray(b"no wav")), (3, bytearray(b"RIFF"))], "doc_id long, media binary")
    assert [r["feature"] for r in telephony.decode_media(bad).collect()] == [None] * 3
    assert telephony.decode_media(telephony.encode_media(empty(spark))).count() == 0


# --- token counts ----------------------------------------------------------------------------------------------------
def test_counts_are_the_librarys(spark, data):
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark, data).collect()}
    library = words.tokenizer(token_counts.TOKENIZER).library
    rows = token_counts.op4_token_counts(spark, data).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 2048, len(texts[r["doc_id"]].encode()))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_cache_is_used_and_filled_once(spark, name):
    cache = scratch(spark, "cache")
    first = token_counts.count_tokens(odd_docs(spark), cache, name=name).collect()
    n = spark.read.parquet(cache).count()
    again = token_counts.count_tokens(odd_docs(spark), cache, name=name).collect()
    assert sorted(map(str, first)) == sorted(map(str, again)) and spark.read.parquet(cache).count() == n == spark.read.parquet(cache).select("content").distinct().count()
    assert len(first) == len(ODD) + 1
    spark.createDataFrame([(spark.read.parquet(cache).first()["content"], "other", 999)], token_counts.CACHE).write.mode("append").parquet(cache)
    assert sorted(map(str, token_counts.count_tokens(odd_docs(spark), cache, name=name).collect())) == sorted(map(str, first))
    assert token_counts.count_tokens(empty(spark), cache, name=name).count() == 0


def test_lasting_cache(spark, data, tmp_path):
    """A second run of the query finds what the first stored, and encodes nothing."""
    path = str(tmp_path / "counts")
    spark.conf.set(token_counts.CACHE_SETTING, path)
    try:
        first = sorted(map(str, token_counts.op4_token_counts(spark, data).collect()))
        n = spark.read.parquet(path).count()
        assert sorted(map(str, token_counts.op4_token_counts(spark, data).collect())) == first and spark.read.parquet(path).count() == n
    finally:
        spark.conf.unset(token_counts.CACHE_SETTING)


def test_copies_are_encoded_once(spark, monkeypatch):
    """Whatever their ids, with the misses broadcast or shuffled."""
    rows = [(i if i % 3 else None, f"text {i % 5}") for i in range(200)] + [(7, None), (7, "text 1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for few in (10_000, 0):
        monkeypatch.setattr(token_counts, "FEW", few)
        cache = scratch(spark, "cache")
        got = token_counts.count_tokens(docs, cache).collect()
        assert len(got) == len(rows) and spark.read.parquet(cache).count() == 6


@pytest.mark.parametrize("change", ["normalizer", "pre_tokenizer", "other marks"])
def test_other_files_are_left_to_the_library(tmp_path, change):
    import json

    said = json.loads(open(__import__("public_tokenizers").path("word_bpe_49k.json")).read())
    if change == "normalizer":
        said["normalizer"]["normalizers"] = said["normalizer"]["normalizers"][:2]
    elif change == "pre_tokenizer":
        said["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "[\\p{L}]+|[\\p{N}]+|[^\\s\\p{L}\\p{N}]+"
    else:
        said["normalizer"]["normalizers"].append({"type": "Strip", "strip_left": True, "strip_right": True})
    path = tmp_path / "changed.json"
    path.write_text(json.dumps(said))
    t = words.JsonTokenizer(str(path))
    assert not t.by_word and t.encode(["One TWO 123 !?", "Ärger"]) == t.raw(["One TWO 123 !?", "Ärger"])


def test_words_one_by_one_are_the_text():
    t = words.tokenizer("word_bpe_49k.json")
    rng, alphabet = np.random.default_rng(0), list("ab'sté.,!́ \n\t\x0b\x1c\x1f\x85\xa0　﻿ªµßŉĸǄΣς<|>endoftext123²Ⅷ_")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 40))) for _ in range(3000)]
    assert t.by_word and t.encode(texts) == t.raw(texts)


def test_small_memo(monkeypatch):
    t = words.JsonTokenizer(__import__("public_tokenizers").path("word_bpe_49k.json"))
    monkeypatch.setattr(words, "MEMO", 5)
    monkeypatch.setattr(words, "GROUP", 2)
    texts = ["a b c", "d e f g", "h i j k l m n o", "a", "b p q"]
    assert t.encode(texts) == t.raw(texts)


# --- toxicity --------------------------------------------------------------------------------------------------------
def auc(x, y):
    order = np.argsort(x)
    rank = np.empty(len(x))
    rank[order] = np.arange(len(x))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def test_held_out_toxicity(spark):
    big = "/root/testdata/sf0.1"
    got = toxicity.op6_toxicity(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert auc(got["score"].to_numpy(), got["toxic"].to_numpy()) > 0.96
    assert ((got["score"] >= 0.5) == got["predicted"]).all() and got["score"].between(0, 1).all()
    clean = got[got["toxic"] == 0]
    assert (clean["predicted"] == 1).mean() < 0.05


def test_toxicity_of_odd_rows(spark):
    labelled = spark.createDataFrame([(f"you {w} thing number {i}", int(w == "vile"), i % 4 == 0) for i in range(80) for w in ("nice", "vile")] + [(None, 1, False), ("x", None, False)], "text string, label int, held boolean")
    model = toxicity.fit(labelled)
    docs = odd_docs(spark).unionByName(spark.createDataFrame([(99, "you vile thing"), (98, "you nice thing"), (97, "you vileness")], "doc_id long, text string"), allowMissingColumns=True).withColumn("said", F.col("text"))
    rows = {r["said"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert "text" not in rows[None].asDict() and rows[None]["media"] == "clash"
    assert rows["you vile thing"]["predicted"] == 1 and rows["you nice thing"]["predicted"] == 0 and rows["you vileness"]["score"] > rows["you nice thing"]["score"]
    assert rows[None]["score"] == rows[""]["score"] and 0 <= rows[""]["score"] <= 1
    assert toxicity.score_toxicity(empty(spark), model).count() == 0


# --- language ID -----------------------------------------------------------------------------------------------------
def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    got = langid.op10_language_id(spark, sf).join(documents(spark, sf).select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97 and got["score"].between(0, 1).all()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"])


@pytest.fixture(scope="module")
def model(spark):
    texts = {"en": "the quick brown fox jumps over the lazy dog and runs away with this", "de": "der schnelle braune fuchs springt über den faulen hund und läuft davon", "ru": "быстрая коричневая лиса прыгает через ленивую собаку", "zh": "敏捷的棕色狐狸 跳过了懒狗"}
    return langid.fit(spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(texts.items())] + [(9, "x", None), (10, None, "en")], "doc_id long, text string, lang string"))


def test_spans_of_mixed_texts(spark, model):
    text = "the lazy dog runs over this and the quick fox  быстрая лиса прыгает через собаку 123 der faule hund läuft davon und springt über den fuchs"
    df = spark.createDataFrame([(1, text), (2, "狐狸 跳过了"), (3, "12 !!"), (4, None), (5, ""), (6, "² Ⅷ_ ½")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in langid.identify(df, model, spans="spans").collect()}
    got = [(s["lang"], text[s["start"] : s["end"]]) for s in rows[1]["spans"]]
    assert [k for k, _ in got] == ["en", "ru", "de"] and got[1][1].startswith("быстрая") and got[2][1].endswith("fuchs")
    assert rows[2]["lang_pred"] == "zh"
    assert [(rows[i]["lang_pred"], rows[i]["score"], rows[i]["spans"]) for i in (3, 4, 5, 6)] == [("und", 0.0, [])] * 4


@pytest.mark.parametrize(("n", "length", "spread"), [(2, 9, 12), (3, 7, 4), (3, 7, 8), (4, 6, 12), (4, 6, 30), (5, 5, 8)])
def test_viterbi_like_all_paths(n, length, spread):
    from itertools import product

    labeller = langid.Labeller(langid.Model([f"l{i}" for i in range(n)], np.ones((langid.BUCKETS + len(langid.SCRIPTS), n))))
    paths = np.array(list(product(range(n), repeat=length)))
    changes = (paths[:, 1:] != paths[:, :-1]).sum(axis=1)
    several = 0
    for seed in range(150):
        s = np.random.default_rng(seed).normal(0, spread, (length, n))
        if seed % 3 == 0:  # runs of words of one language, each run worth less than a change or little more
            s = np.repeat(np.random.default_rng(seed).normal(0, 12, (-(-length // 3), n)), 3, axis=0)[:length] / 2
        values = s[np.arange(length), paths].sum(axis=1) - langid.SWITCH * changes
        got = labeller.path(s)
        mine = s[np.arange(length), got].sum() - langid.SWITCH * (got[1:] != got[:-1]).sum()
        assert mine == pytest.approx(values.max(), abs=1e-4)
        several += len(set(got.tolist())) > 1
    assert several or spread < 12


def test_viterbi_when_the_best_path_leaves_the_best_sum():
    """Two languages that share a text win over a third that is better than either over all of it."""
    labeller = langid.Labeller(langid.Model(["a", "b", "c"], np.ones((langid.BUCKETS + len(langid.SCRIPTS), 3))))
    s = np.zeros((10, 3))
    s[:5, 0], s[5:, 0], s[:5, 1], s[5:, 1] = 3, -4, -4, 3
    assert labeller.path(s).tolist() == [0] * 5 + [1] * 5


def plain_label(model, text):
    """Language and score of a text with features, scores and paths written out word by word."""
    scored, sizes = [], []
    for w in (text or "").split():
        c = langid.core(w)
        sizes.append(len(w) if c else 0)
        if not c:
            scored.append(np.zeros(len(model.languages)))
            continue
        padded, total = f" {c} ", np.zeros(len(model.languages))
        grams = [padded[i : i + k] for k in (1, 2, 3, 4) for i in range(len(padded) - k + 1) if padded[i : i + k] != " "]
        for g in grams:
            total += model.logs[int(langid.mixed_hash([np.array([ord(x)], dtype=np.uint32) for x in g])[0] % np.uint64(langid.BUCKETS))]
        total += model.logs[zlib.crc32(c.encode()) % langid.BUCKETS]
        allowed = model.allowed[langid.scripts([c])[0]]
        scored.append(np.where(allowed, total, total.min() - 30) if allowed.any() else np.zeros(len(total)))
    if not sum(sizes):
        return "und", 0.0
    n, s = len(model.languages), np.array(scored)
    score, back = s[0].copy(), []
    for row in s[1:]:
        step = score[:, None] - langid.SWITCH * (1 - np.eye(n))
        back.append(step.argmax(axis=0))
        score = step.max(axis=0) + row
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path = np.array(path[::-1])
    by = np.bincount(path, weights=sizes, minlength=n)
    best = int(by.argmax())
    total = s[path == best].sum(axis=0)
    return model.languages[best], by[best] / by.sum() * min(1.0, 1 / np.exp(np.minimum(total - total[best], 50)).sum())


def test_labels_word_by_word(spark, data):
    docs = documents(spark, data)
    model = langid.fit(docs.filter(langid.fold("doc_id", 4) != 2))
    rows = langid.identify(docs.select("doc_id", "text", F.col("text").alias("t")), model).limit(60).collect()
    mixed = langid.identify(docs.select(F.concat_ws(" ", *[F.coalesce(F.substring("text", 1, 60), F.lit("")), F.lit("the of and"), F.coalesce(F.substring("text", 200, 90), F.lit(""))]).alias("t")).withColumn("text", F.col("t")), model).limit(60).collect()
    for r in [*rows, *mixed]:
        lang, score = plain_label(model, r["t"])
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-3)


def test_languages_of_odd_rows(spark, model):
    rows = langid.identify(odd_docs(spark), model).collect()
    assert len(rows) == len(ODD) + 1 and all(r["lang_pred"] in ("und", *model.languages) for r in rows)
    assert langid.identify(empty(spark), model).count() == 0
    none = langid.fit(empty(spark))
    assert {r["lang_pred"] for r in langid.identify(odd_docs(spark), none).collect()} == {"und"}


def test_all_operators_are_registered():
    assert Counter(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == Counter(range(1, 14))


@pytest.mark.parametrize(("memo", "words"), [(50, 51), (50, 400), (None, None)])
def test_texts_of_more_words_than_the_memo(monkeypatch, memo, words):
    """Known and new words mixed in one text that the memo cannot hold beside what it has."""
    if memo:
        monkeypatch.setattr(langid, "MEMO", memo)
    words = words or langid.MEMO + 10_000
    rng = np.random.default_rng(1)
    labeller = langid.Labeller(langid.Model(["a", "b"], rng.integers(1, 50, (langid.BUCKETS + len(langid.SCRIPTS), 2)).astype(float)))
    text = " ".join(f"v{i}" for i in range(words))
    labeller.know([f"v{i}" for i in range(min(30_000, words // 2))] + ["only here"])
    first = labeller.label(text)
    assert len(first[2]) == words
    labeller.know(["and", "others"])
    again = labeller.label(text)
    assert again[:2] == first[:2] and (again[2] == first[2]).all()


def test_hundreds_of_languages(spark, monkeypatch):
    """More languages than the table has room for at full width: fewer rows, no error."""
    monkeypatch.setattr(langid, "CELLS", 1 << 17)
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}ba " * 20, f"l{i}") for i in range(60)]
    df = spark.createDataFrame(rows * 3, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.languages) == 60 and model.rows * 60 <= 1 << 17 and langid.rows_for(3) < langid.BUCKETS
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df, model).collect()}
    assert sum(got[i] == k for i, _, k in rows) >= 55


@pytest.mark.parametrize("code", [telephony.MULAW, telephony.ALAW, telephony.IMA, telephony.PCM])
@pytest.mark.parametrize("size", [1, 2, 35, 36, 37, 72 * 10, 72 * 10 + 5, 72 * 10 + 16, 3000])
def test_windows_give_the_values_of_the_whole(spark, monkeypatch, code, size):
    """Payloads decoded a few blocks at a time: features, CRC and PCM as of the payload in one piece."""
    rng = np.random.default_rng(size)
    media = telephony.wav(rng.integers(0, 256, size, dtype=np.uint8).tobytes(), code)
    whole = telephony.doubled(telephony.expanded(telephony.opened(media)[2], code)).tobytes()
    payload = memoryview(media)[slice(*(lambda at: (at, at + size))(media.index(b"data") + 8))]
    kinds = (telephony.MULAW, telephony.ALAW, telephony.IMA)
    want = [telephony.measured(x, np.array([0, len(x)]))[0] for x in (telephony.expanded(bytes(payload), k) for k in kinds)]
    monkeypatch.setattr(telephony, "WINDOW", telephony.BLOCK * 2)
    said, crc, pcm = telephony.long_sound(payload, code, 8000, True)
    assert (said, crc, bytes(pcm)) == (want, zlib.crc32(whole), telephony.wav(whole, telephony.PCM, 16000))
    assert telephony.long_sound(payload, code, 8000, False) == (want, crc, None)


def test_payload_of_many_megabytes(tmp_path):
    """A worker's memory stays near the payload's size; with its PCM, near that of the PCM."""
    import subprocess
    import sys

    program = """
import resource, sys
from peakframe.llm import telephony as t
import numpy as np
media = memoryview(t.wav(np.random.default_rng(1).integers(0, 256, 60_000_000, dtype=np.uint8).tobytes()))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
t.long_sound(t.opened(media)[2], t.MULAW, 8000, len(sys.argv) > 1)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    grown = [int(subprocess.run([sys.executable, "-c", program, *more], capture_output=True, text=True, check=True, cwd=telephony.__file__.split("/peakframe/")[0]).stdout) for more in ([], ["pcm"])]
    assert grown[0] < 60 and grown[1] < 330
