"""Layers of compressed data with several members, layers that are cut, base64 in lines, bytes that are not all UTF-8."""

from __future__ import annotations

import base64
import bz2
import gzip
import lzma
import time
import zlib
from urllib.parse import quote

import numpy as np
import pytest

import corpus_pipeline
from peakframe.llm import secrets

SECRET = b"password=hunter2secret"


def zstd(data):
    import zstandard

    return zstandard.ZstdCompressor().compress(data)


def shown(text):
    return [(a, e) for a, k, e, depth in secrets.scan(text)[0] if k == 0 and depth > 0]


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstd])
@pytest.mark.parametrize("tail", [b"", b"no member"])
def test_all_members_are_opened(pack, tail):
    hidden = base64.b64encode(pack(b"nothing here ") + pack(b"nor here ") + pack(SECRET) + tail).decode()
    assert shown(f"lead {hidden} tail")
    assert secrets.inflate(pack(b"ab") + pack(b"cd"), 3) == (b"abc", True) and secrets.inflate(pack(b"ab") + pack(b"cd"), 2) == (b"ab", True)
    assert secrets.inflate(pack(b"ab") + pack(b"cd"), 4) == (b"abcd", False)


def test_stretch_of_a_cut_layer_is_redacted(spark, monkeypatch):
    hidden = base64.b64encode(gzip.compress(b"a " * 10_000 + SECRET)).decode()
    whole = base64.b64encode(gzip.compress(b"a " * 400)).decode()
    df = spark.createDataFrame([(1, f"x {hidden} y {whole} z")], "doc_id long, text string")
    (row,) = secrets.scan_secrets(df, max_layer_bytes=1000, redacted="clean").collect()
    assert row["truncated"] and row["clean"].startswith("x [REDACTED]") and hidden.rstrip("=") not in row["clean"] and whole in row["clean"]
    big = base64.b64encode(gzip.compress(bytes(secrets.MAX_LAYER_BYTES) + SECRET)).decode()
    docs = spark.createDataFrame([(1, f"x {big} y", 9)], "doc_id long, text string, n_chars long")
    (row,) = corpus_pipeline.secret_scan(spark, docs, "").collect()
    assert row["text"] == "x [REDACTED] y" and row["n_chars"] == len(row["text"])


def lines(data, width, end="\n"):
    x = base64.b64encode(data).decode()
    return end.join(x[i : i + width] for i in range(0, len(x), width))


@pytest.mark.parametrize("width", [64, 76, 21])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("data", [b"some words " * 3 + b"that stand before password=" + b"hunter2secret" * 12 + b" and others, behind", gzip.compress(bytes(range(256)) * 2 + SECRET + bytes(range(255, 0, -1)))])
def test_base64_goes_over_lines(width, end, data):
    hidden = lines(data, width, end)
    for text in (f"lead\n{hidden}\n\ntail", f"-----BEGIN X-----\n{hidden}\n-----END X-----", f"a_long_word_before_all_of_it\n{hidden} tail"):
        a = text.index(hidden)
        assert any(s <= a and e >= a + len(hidden.rstrip("=\r\n ")) for s, e in shown(text)), text


@pytest.mark.parametrize("data", [b"\xff\xfe\x80 " + SECRET + b"\xf0 end", b"\x01\x02" + SECRET, SECRET.decode().encode("utf-16"), SECRET.decode().encode("utf-16-be"), "ключ ".encode("utf-16-le") + SECRET.decode().encode("utf-16-le")])
def test_layers_that_are_not_all_text(data):
    hidden = base64.b64encode(data).decode()
    assert shown(f"lead {hidden} tail")


def test_valid_parts_of_percent_runs():
    hidden = "%ff%C3" + "".join(f"%{b:02x}" for b in SECRET) + "%80"
    assert shown(f"lead {hidden} é") == [(5 + 6, 5 + 6 + 3 * len(SECRET))]
    assert secrets.scan("%ff%fe %80")[1] == 1


def test_digests_are_no_layers():
    assert secrets.scan("0f" * 20 + " Donaudampfschifffahrtsgesellschaft a/path/of/some/words/here")[1] == 1


TAIL = "assword=hunter22"


@pytest.mark.parametrize("chain", ["%" + "25" * 400_000 + "70", "\\u005c" + "u005c" * 100_000 + "u0070", "&#38;" + "#38;" * 100_000 + "#112;", "%EF%BC%85" + "25EF%BC%85" * 40_000 + "70", "\\x5c" + "x25" * 3 + "x5c" * 50_000 + "x70"])
def test_chains_take_linear_time(chain):
    began = time.time()
    text = f"é {chain}{TAIL} x"
    spans, layers, cut = secrets.scan(text)
    assert layers < 20 and not cut and time.time() - began < 60
    if "x25" not in chain:
        assert (2, 0, len(text) - 2) in [(a, k, e) for a, k, e, _ in spans]


def test_one_pass_shows_what_single_steps_show(monkeypatch):
    """What any number of single steps finds is inside of what is found when all steps but one are made at once."""
    rng = np.random.default_rng(11)
    bits = ["%", "25", "%25", "\\", "u005c", "x5c", "\\u0025", "&#37;", "&", "#38;", "%5Cx", "70", "p", "4", "1", "\uff05", "\uff12", "%C3%A9", "%ff", "\\u{70}", "token=abcdef12", "AKIA" + "Q" * 16, " ", "0f" * 12]
    checked = 0
    for _ in range(4000):
        text = "".join(rng.choice(bits, rng.integers(2, 24)))
        monkeypatch.setattr(secrets, "STEPS", 1000)
        one = secrets.scan(text)[0]
        monkeypatch.setattr(secrets, "STEPS", 1)
        all_ = secrets.scan(text)[0]
        checked += sum(d > 1 for *_, d in one)
        assert all(any(k == q and s <= a and e <= f for s, q, f, _ in all_) for a, k, e, _ in one), text
    assert checked > 50


def test_nested_base64_in_lines_stays_small():
    data = SECRET
    for _ in range(12):
        x = base64.b64encode(b"some words before " + data).decode()
        data = "\n".join(x[i : i + 76] for i in range(0, len(x), 76)).encode()
    spans, layers, _ = secrets.scan(data.decode())
    assert layers < 100 and any(k == 0 for _, k, _, _ in spans)


def test_very_long_text():
    text = ("some ordinary words, and a path/like/this " * 50_000) + quote("password=hunter22", safe="")
    spans, _, cut = secrets.scan(text)
    assert not cut and [k for _, k, _, _ in spans] == [0]


def test_layer_that_needs_too_much_memory_is_flagged(monkeypatch):
    packed = lzma.compress(SECRET * 50)
    real = lzma.LZMADecompressor
    monkeypatch.setattr(secrets.lzma, "LZMADecompressor", lambda memlimit: real(memlimit=1 << 10))
    assert secrets.scan("x " + base64.b64encode(packed).decode())[2]


@pytest.mark.parametrize("text", ["x\n" + "Ab3d" * 2_500_000 + "\n y", "-----BEGIN\n" + "Zm9v" * 400_000 + "\n" + "Zm9v" * 400_000 + "\n-----END", "Q" * 3_000_000 + "\n  ." * 50_000])
def test_one_long_run_takes_linear_time(text):
    began = time.time()
    _, layers, cut = secrets.scan(text)
    assert time.time() - began < 60 and layers < 10 and not cut


def test_many_compressed_layers_share_one_budget():
    """Layers are opened one at a time, and together no farther than the limit: what lies behind is flagged."""
    import tracemalloc

    bomb = base64.b64encode(gzip.compress(bytes(8 << 20) + SECRET)).decode()
    text = " , ".join(f"{i:03d}.{bomb}" for i in range(50))
    tracemalloc.start()
    spans, layers, cut = secrets.scan_layers(text, 40 << 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20 and len(cut) == 46 and sum(k == 0 for _, k, _, _ in spans) == 4
    assert all(text[a:b] == bomb.rstrip("=") or text[a:b] == bomb for a, b in cut)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_damaged_layers_are_read_as_far_as_they_go(pack):
    rng = np.random.default_rng(3)
    noise = lambda n: "".join(rng.choice(list("qwrtzpsdg"), n)).encode()
    whole = pack(noise(300) + b" " + SECRET + b" " + noise(300))
    end = bytearray(whole)
    end[-3 if pack in (gzip.compress, zlib.compress) else -1] ^= 0xFF
    for data in (bytes(end), pack(SECRET + b" and some words more") + whole[:-40]):
        spans, _, cut = secrets.scan_layers("lead " + base64.b64encode(data).decode() + " tail")
        assert [k for _, k, _, d in spans if d] and (cut or pack is lzma.compress or data != bytes(end))
    assert secrets.scan(base64.b64encode(b"x\x9c" + bytes(rng.integers(0, 256, 60, dtype=np.uint8))).decode())[2] is False


def nested(rng, text):
    """text under some layers, and how many."""
    packs = [lambda t: base64.b64encode(t.encode()).decode(), lambda t: quote(t, safe=""), lambda t: base64.b64encode(gzip.compress(t.encode())).decode(), lambda t: base64.urlsafe_b64encode(lzma.compress(t.encode())).decode(), lambda t: "".join(f"\\u{ord(c):04x}" for c in t), lambda t: "".join(f"&#{ord(c)};" for c in t), lambda t: base64.b64encode(bz2.compress(base64.b64encode(zlib.compress(t.encode())))).decode()]
    depth = rng.integers(1, 5)
    for _ in range(depth):
        text = "see " + packs[rng.integers(len(packs))](f"pre {text} post") + " end"
        if len(text) > 20_000:
            break
    return text


def plain_decoder(text, depth=0, seen=None):
    """Every secret's text that a plain recursive decoder meets: each layer written out, each of its stretches opened by itself."""
    import html
    import re
    import urllib.parse

    seen = set() if seen is None else seen
    if text in seen or depth > 40:
        return set()
    seen.add(text)
    found = {text[a:b] for _, a, b in secrets.findings(text)}
    below = [urllib.parse.unquote(text), html.unescape(text), re.sub(r"\\u([0-9a-f]{4})", lambda m: chr(int(m[1], 16)), text)]
    for m in re.finditer("[A-Za-z0-9+/_-]{16,}={0,2}", text):
        try:
            data = base64.b64decode(m[0].replace("-", "+").replace("_", "/"))
        except ValueError:
            continue
        for unpack in (gzip.decompress, zlib.decompress, bz2.decompress, lzma.decompress, bytes):
            try:
                below.append(unpack(data).decode())
            except Exception:
                continue
    for x in below:
        found |= plain_decoder(x, depth + 1, seen)
    return found


def test_against_a_plain_recursive_decoder(monkeypatch):
    """Random nestings: the values found are those of a decoder that writes every layer out, and each lies in the stretch that hides it."""
    rng = np.random.default_rng(8)
    for n in range(150):
        planted = [f"password=hunter{n:04d}x", "AKIA" + f"{n:04d}QWERTYUIOPAS", "api_key: zx" + f"{n:06d}"]
        parts = [nested(rng, planted[k]) for k in rng.integers(0, 3, rng.integers(1, 4))]
        text = "Some words. ".join(["", *parts, ""])
        shown, real = set(), secrets.findings
        monkeypatch.setattr(secrets, "findings", lambda t, real=real: [(k, a, b) for k, a, b in real(t) if shown.add(t[a:b]) is None])
        spans = secrets.scan(text)[0]
        monkeypatch.setattr(secrets, "findings", real)
        want = plain_decoder(text)
        assert want <= shown, text
        assert len([d for *_, d in spans if d]) >= 1
        for a, _, b, _ in spans:
            assert plain_decoder(text[a:b]) or plain_decoder(text[max(0, a - 2) : b + 2]), text[a:b]
