"""Fingerprints, SimHash, revisits, mixing, packing and the pipeline: against brute force and SQL; ties, nulls, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import same
from pyspark.sql import functions as F
from test_near_copies import brute_kept
from test_row_operators import ODD, empty, odd_docs
from xxhash import xxh64_intdigest

import corpus_pipeline
from peakframe.llm import components, fingerprint, langid, mixing, packing, registry, revisit, secrets, simhash, words
from peakframe.llm.common import documents


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_as_sql(spark, data, name):
    same(spark, data, registry.QUERIES[name], registry.ORACLE_SQL[name])


# --- fingerprints ----------------------------------------------------------------------------------------------------
def folded(text):
    text = text or ""
    if text.isascii():
        form = text.lower()
    else:
        form = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return re.sub(r"[\s\x1c-\x1f]+", " ", form).strip(" ")


def wide(text):
    form = folded(text).encode()
    return f"{xxh64_intdigest(form, 42):016x}{xxh64_intdigest(form, xxh64_intdigest(b'second', 42)):016x}"


def test_fingerprints_of_all_documents(spark, data):
    docs = sorted(((r["doc_id"], r["text"] or "") for r in documents(spark, data).collect()), reverse=True)
    got = {r["doc_id"]: r for r in fingerprint.op3_fingerprint(spark, data).collect()}
    assert len(got) == len(docs)
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (wide(text), wide(edited))
        assert (r["near_edited"], r["near_next"]) == (float(wide(text) == wide(edited)), float(wide(text) == wide(after)))


@pytest.mark.parametrize(("nulls", "hot"), [(1, 2), (300, 0), (0, 300), (200, 400)])
def test_ranges_of_neighbours(spark, nulls, hot):
    """Null ids, and an id that many rows share, go to as many ranges as their rows need."""
    rng = np.random.default_rng(5)
    ids = [*rng.permutation(400).tolist(), *[None] * nulls, *[7] * hot]
    rows_ = [(i, int(rng.integers(-(2**63), 2**63 - 1)), f"t{n}") for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows_, "doc_id long, tie long, text string").repartition(5)
    rows = fingerprint.with_next(df, "doc_id", "tie", ["doc_id", "text"], range_rows=37).collect()
    order = sorted(((i is not None, i or 0, tie, t) for i, tie, t in rows_), reverse=True)
    assert {(r["text"], r["next"]["text"]) for r in rows} == {(a[3], b[3]) for a, b in zip(order, order[1:] + order[:1], strict=True)} and len(rows) == len(ids)
    one = fingerprint.with_next(df.filter("text = 't3'"), "doc_id", "tie", ["text"]).first()
    assert one["next"]["text"] == one["text"]


def test_folding_and_odd_rows(spark):
    pairs = [("Straße", "STRASSE"), ("ﬁne", "FINE"), ("é", "é"), ("a\t\n b ", "A B"), ("", None), ("Ａ１", "a1")]
    df = spark.createDataFrame([(x,) for p in pairs for x in p], "text string")
    got = [r["fingerprint"] for r in fingerprint.fingerprint_documents(df).collect()]
    assert got[::2] == got[1::2] and len(set(got)) == len(pairs)
    rows = fingerprint.fingerprint_documents(odd_docs(spark)).collect()
    assert len(rows) == len(ODD) + 1 and all(r["fingerprint"] == wide(r["text"]) and r["media"] == "clash" for r in rows)
    assert fingerprint.fingerprint_documents(empty(spark)).count() == 0


def test_texts_that_share_a_bucket_are_told_apart(spark, data, monkeypatch):
    short = lambda form: [F.pmod(F.xxhash64(form), F.lit(5)), F.lit(0).cast("long")]
    monkeypatch.setattr(fingerprint, "wide_hash", short)
    rows = fingerprint.fingerprint_documents(documents(spark, data).select("doc_id", "text")).collect()
    by = defaultdict(set)
    for r in rows:
        by[r["fingerprint"]].add(folded(r["text"]))
    assert all(len(x) == 1 for x in by.values()) and len(by) == len({folded(r["text"]) for r in rows})
    both = fingerprint.op3_fingerprint(spark, data).collect()
    texts = {r["doc_id"]: folded(r["text"]) for r in rows}
    assert len({r["fingerprint"] for r in both}) == len(set(texts.values())) and len(both) == len(texts)


# --- SimHash ---------------------------------------------------------------------------------------------------------
def brute_simhash(text, n=4):
    parts = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + n]) for i in range(max(1, len(parts) - n + 1))]
    hs = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def linked(prints, radius):
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = label[i], label[j]
                label = [min(x, y) if k in (x, y) else k for k in label]
    return label


def test_simhash_of_all_documents(spark, data):
    docs = sorted((r["doc_id"], r["text"]) for r in documents(spark, data).collect())
    prints = [brute_simhash(t) for _, t in docs]
    label = linked(prints, 4)
    first = {}
    for (i, _), k in zip(docs, label, strict=True):
        first[k] = min(first.get(k, i), i)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op5_simhash(spark, data).collect()}
    assert got == {i: (f"{p:016x}", first[k]) for (i, _), p, k in zip(docs, prints, label, strict=True)}


def near_copies(n, seed=0):
    """Chains of fingerprints that differ in a few bits, among others that don't."""
    rng = np.random.default_rng(seed)
    out = [0, 1, 3]
    while len(out) < n:
        x = int(rng.integers(0, 2**63)) if rng.random() < 0.3 else out[int(rng.integers(len(out)))]
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            x ^= 1 << int(b)
        out.append(x)
    return sorted({x - (1 << 64) if x >> 63 else x for x in out})


@pytest.mark.parametrize(("tile", "radius"), [(4, 4), (256, 4), (7, 1)])
def test_tiles_lose_no_link(tile, radius):
    x = np.array(near_copies(150), dtype=np.int64).view(np.uint64)
    want = linked([int(v) for v in x], radius)
    label = list(range(len(x)))
    for i, j in simhash.tiled_links(x, radius, tile):
        assert (int(x[i]) ^ int(x[j])).bit_count() <= radius
        a, b = label[i], label[j]
        label = [min(a, b) if k in (a, b) else k for k in label]
    assert label == want


@pytest.mark.parametrize(("unit", "blocks"), [(4096, None), (6, None), (4096, 7)])
def test_units_lose_no_link(spark, unit, blocks):
    prints = near_copies(200, 3)
    df = spark.createDataFrame([(p, p // 2) for p in prints], "fingerprint long, id long")
    assert all((r["a_id"], r["b_id"]) == (r["a"] // 2, r["b"] // 2) for r in simhash.near_links(df, 4, unit, blocks).collect())
    got = {r["node"]: r["root"] for r in components.components(simhash.near_links(df, 4, unit, blocks), "a", "b").collect()}
    label = linked([p & (2**64 - 1) for p in prints], 4)
    groups = defaultdict(set)
    for p, k in zip(prints, label, strict=True):
        groups[k].add(p)
    want = {p: min(g) for g in groups.values() if len(g) > 1 for p in g}
    assert got == want


def test_component_ids_of_odd_ids(spark):
    """Null and repeated ids: a component has its smallest id, null only where there is no other; fingerprints that share an id are not linked by that."""
    rows = [(5, 0b1), (3, 0b11), (None, 0b111), (3, 0xFFFF << 20), (None, 0xFFFFF << 40), (9, 0xFFFF << 20), (9, 0b1)]
    got = {r["fingerprint"]: r["component_id"] for r in simhash.near_components(spark.createDataFrame(rows, "doc_id long, fingerprint long")).collect()}
    assert got == {0b1: 3, 0b11: 3, 0b111: 3, 0xFFFF << 20: 3, 0xFFFFF << 40: None}
    roots = {r["fingerprint"]: r["root"] for r in simhash.near_components(spark.createDataFrame(rows, "doc_id long, fingerprint long")).collect()}
    assert roots[0b1] == roots[0b11] == roots[0b111] != roots[0xFFFF << 20]


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5), (None, 3), (200, 100)] + [(1000, 1000 + i) for i in range(1, 40)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: 100} | {1000 + i: 1000 for i in range(40)}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# --- revisits --------------------------------------------------------------------------------------------------------
def test_canonical_urls(spark):
    urls = ["HTTP://WWW.Example.com:80/a/?b=2&utm_source=x&a=1#top", "https://m.example.com/a?a=1&b=2", "//example.com/a/?a=1&&b=2"]
    got = {r["u"] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(revisit.canonical_url(F.col("url")).alias("u")).collect()}
    assert got == {"example.com/a?a=1&b=2"}


def test_urls_without_host_or_with_other_ports(spark):
    said = {"example.com/a": "example.com/a", "other.org/b#x": "other.org/b", "mailto:x@y": "mailto:x@y", "": None, "  ": None, "#top": None, "http://a.b:443/": "a.b:443", "https://a.b:443/": "a.b", "https://a.b:80/": "a.b:80", "http://A.b:80": "a.b"}
    got = {r["url"]: r["u"] for r in spark.createDataFrame([(u,) for u in said], "url string").select("url", revisit.canonical_url(F.col("url")).alias("u")).collect()}
    assert got == said


def test_revisits_like_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        ts = None if rng.random() < 0.02 else int(rng.integers(0, 300))
        tags = {k: str(rng.integers(0, 2)) for k in ("etag", "last-modified", "date", "content-length", "vary") if rng.random() < 0.6}
        rows.append((i, [None, "http://hot.example.com/", "http://b.example.com/x", "", "mailto:a@b"][int(rng.choice(5, p=[0.02, 0.7, 0.18, 0.05, 0.05]))], ts, ["response", "revisit"][int(rng.random() < 0.5)], tags))
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, headers map<string,string>").withColumn("key", F.lit("clash")).withColumn("status", F.lit(1))
    got = {r["record_id"]: r for r in revisit.resolve_revisits(df, slice_seconds=20).collect()}
    assert sorted(got) == [r[0] for r in rows if r[3] == "revisit"]
    for i, url, ts, kind, head in rows:
        if kind != "revisit":
            continue
        full = [r for r in rows if r[3] == "response" and r[1] == url and (url or "").strip() and None not in (r[2], ts) and r[2] < ts]
        best = max(full, key=lambda r: (r[2], r[0]), default=None)
        r = got[i]
        assert r["original_id"] == (best and best[0])
        if best is None:
            assert (r["status"], r["headers"]) == ("no_original", head)
            continue
        common = [k for k in ("etag", "last-modified") if k in head and k in best[4]]
        status = "mismatch" if any(head[k] != best[4][k] for k in common) else "resolved" if common else "unverified"
        want = best[4] | {k: v for k, v in head.items() if k in revisit.PERMITTED} if status == "resolved" else head
        assert (r["status"], r["headers"]) == (status, want)
    assert revisit.resolve_revisits(df.limit(0)).count() == 0


# --- mixing ----------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1000, "c": 10, None: 500}, {"a": 5}, {"a": 0, "b": 7}, {"é": 10, "z": 10, "Z": 10, "": 3}])
def test_targets_like_pouring(spark, sizes):
    order = sorted((k for k in sizes if k is not None)) + ([None] if None in sizes else [])
    w = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    left, open_, want = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = {k: left * w[k] / sum(w[x] for x in open_) for k in open_}
        over = [k for k in open_ if share[k] >= 2 * sizes[k]]
        if not over:
            want |= share
            break
        for k in over:
            want[k] = 2.0 * sizes[k]
            left -= want[k]
            open_.discard(k)
    df = spark.createDataFrame([(k, n) for k, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(want)


def pareto(docs, target, seed="mix-1"):
    """Copies of each of a source's (id, size) by the definition: whole copies, inclusion odds in proportion to size, the ranking, and the last document that brings the words nearest."""
    total = sum(n for _, n in docs)
    whole = min(int(target // total), 2) if total else 0
    lack = int(np.floor(target + 0.5)) - whole * total if total else 0
    ordered = sorted((n for _, n in docs if n), reverse=True)
    rate, above = None, 0
    for k, n in enumerate(ordered):
        if k and ordered[k - 1] == n:
            continue
        if (lack - above) / sum(x * x for x in ordered if x <= n) * n < 1:
            rate = max(lack - above, 0) / sum(x * x for x in ordered if x <= n)
            break
        above = sum(x for x in ordered if x >= n)
    p = {d: min(1.0, rate * d[1]) if rate is not None else 1.0 for d in docs}
    u = {(i, n): (int(hashlib.md5(f"{seed}:{'' if i is None else i}:{n}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for i, n in docs}
    sure = sum(n for i, n in docs if p[i, n] >= 1)
    key = {d: u[d] / (1 - u[d]) * ((1 - p[d]) / p[d]) for d in set(docs) if 0 < p[d] < 1 and d[1]}
    out, reached = {d: whole + (p[d] >= 1) if d[1] else 0 for d in docs}, 0
    for k in sorted(set(key.values())):
        group = [d for d in docs if key.get(d) == k]
        words = sum(n for _, n in group)
        if lack - sure > 0 and 2 * (reached + words) - words <= 2 * (lack - sure):
            out |= {d: whole + 1 for d in group}
        reached += words
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_mix_by_definition(spark, sf):
    rows = mixing.op8_mixing(spark, f"/root/testdata/{sf}").collect()
    src = {r["doc_id"]: r["source"] for r in documents(spark, f"/root/testdata/{sf}").collect()}
    by, target = defaultdict(list), {}
    for r in rows:
        by[src[r["doc_id"]]].append((r["doc_id"], r["size"]))
        target[src[r["doc_id"]]] = r["target"]
    want = {d: n for k, docs in by.items() for d, n in pareto(docs, target[k]).items()}
    assert all(r["taken"] == want[r["doc_id"], r["size"]] * r["size"] <= 2 * r["size"] for r in rows)
    assert sum(n for n in want.values() if n not in (0, 1, 2)) == 0 and len(set(want.values())) == 3
    for k, docs in by.items():
        assert abs(sum(want[d] * d[1] for d in docs) - target[k]) <= max(n for _, n in docs) / 2 + 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.op8_mixing(spark, f"/root/testdata/{sf}").collect()))


def test_inclusion_frequencies(spark):
    """Over 600 sources alike, a document of each size is taken as often as its inclusion probability says."""
    sizes = [3, 5, 8, 10, 10, 15, 20, 25, 30, 34, 40, 50, 60, 70, 90, 130, 200, 300, 20, 20] * 3
    df = spark.createDataFrame([(f"s{k}", k * 1000 + i, n) for k in range(600) for i, n in enumerate(sizes)], "source string, doc_id long, size long")
    rows = mixing.mix(df, "size", weights=(1,), share=0.45).groupBy("size").agg(F.avg((F.col("taken") > 0).cast("int")).alias("f"), F.first("target").alias("target"), F.max(F.col("taken") / F.col("size")).alias("most")).collect()
    lack, small = rows[0]["target"], sorted(set(sizes))
    rate = next(r for n in reversed(small) if (r := (lack - sum(x for x in sizes if x > n)) / sum(x * x for x in sizes if x <= n)) * n < 1)
    assert len({round(min(1, rate * n), 3) for n in small}) > 10
    for r in rows:
        assert r["f"] == pytest.approx(min(1, rate * r["size"]), abs=0.05) and r["most"] <= 1


def test_mix_of_ties_and_steps(spark, monkeypatch):
    """Repeated rows are taken together; the width of a step of the key does not matter."""
    docs = spark.createDataFrame([("s" if i % 5 else None, i // 2 if i % 7 else None, 1 + i * i % 50) for i in range(400)], "source string, doc_id long, size long")
    one = sorted(map(str, mixing.mix(docs, "size", share=0.6).collect()))
    monkeypatch.setattr(mixing, "STEPS", 1)
    assert sorted(map(str, mixing.mix(docs, "size", share=0.6).collect())) == one
    monkeypatch.setattr(mixing, "STEPS", 1 << 20)
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    got = mixing.mix(docs, "size", share=0.6).collect()
    assert sorted(map(str, got)) == one
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    for rows in by.values():
        want = pareto([(r["doc_id"], r["size"]) for r in rows], rows[0]["target"])
        assert all(r["taken"] == want[r["doc_id"], r["size"]] * r["size"] for r in rows)


def test_mix_of_odd_rows(spark):
    sized = odd_docs(spark).withColumn("size", mixing.n_words(F.col("text"))).withColumn("taken", F.lit("clash"))
    rows = mixing.mix(sized, "size").collect()
    assert len(rows) == len(ODD) + 1 and all(r["size"] == len(re.findall("[^\x20\x09-\x0d]+", r["text"] or "")) and r["media"] == "clash" for r in rows)
    assert mixing.mix(empty(spark).withColumn("size", F.lit(1)), "size").count() == 0
    docs = odd_docs(spark)
    words_of = lambda df: df.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert words_of(mixing.mixed_documents(docs)) == sum(r["taken"] for r in rows) and mixing.mixed_documents(docs).columns == docs.columns


# --- packing ---------------------------------------------------------------------------------------------------------
def plain_best_fit(lengths, capacity):
    rooms, out = [], []
    for n in lengths:
        fit = [(r, b) for b, r in enumerate(rooms) if r >= n]
        if fit:
            least = min(r for r, _ in fit)
            out.append(least)
            rooms[next(b for r, b in fit if r == least)] -= n
        else:
            out.append(capacity)
            rooms.append(capacity - n)
    return out, len(rooms)


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_the_tightest_bin(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.integers(1, 64, 300))[::-1]
    bins, offsets = packing.best_fit(lengths, 64)
    rooms, n = plain_best_fit(lengths.tolist(), 64)
    assert n == bins.max() + 1 and [64 - o for o in offsets] == rooms


def check_packed(rows, texts, capacity=4096):
    t = words.tokenizer(packing.TOKENIZER)
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    for i, text in texts.items():
        ids = t.raw([text or ""])[0] + (1).to_bytes(4, "little")
        want = [(k, k * capacity, len(p) // 4, zlib.crc32(p)) for k, p in enumerate(ids[a : a + 4 * capacity] for a in range(0, len(ids), 4 * capacity))]
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in sorted(pieces[i], key=lambda r: r["piece"])] == want
    return len(bins), sum(r["length"] for r in rows)


def test_packing_of_all_documents(spark, data):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, data).collect()}
    n, total = check_packed(packing.op9_best_fit(spark, data).collect(), texts)
    assert n <= -(-total // 4096) + 1


def test_packing_in_shards_and_odd_rows(spark):
    docs = odd_docs(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_packed(packing.pack_documents(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})
    df = spark.createDataFrame([(i % 50, int(n)) for i, n in enumerate(np.random.default_rng(1).integers(1, 100, 500))] + [(1, 100), (1, 100), (2, None)], "doc_id long, length long")
    rows = packing.pack(df, 100, shard_pieces=60).collect()
    assert len(rows) == 503
    held = defaultdict(int)
    for r in rows:
        held[r["sequence_id"]] += r["length"] or 0
    assert max(held.values()) <= 100 and len(held) <= sum(held.values()) / 100 * 1.1 + 9
    with pytest.raises(ValueError, match="above"):
        packing.pack(df, 50)
    assert packing.pack_documents(empty(spark)).count() == 0


# --- pipeline --------------------------------------------------------------------------------------------------------
def test_pipeline_step_by_step(spark, data, tmp_path):
    docs = documents(spark, data).unionByName(spark.createDataFrame([(10**6, None, "en", "src0", 0), (10**6 + 1, "42 !!", "en", "src0", 5), (10**6 + 2, "the password=hunter2secret is of the and", "en", "src1", 40)], "doc_id long, text string, lang string, source string, n_chars long"))
    seen = {0: docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        out = stage(spark, docs, data)
        assert k == 5 or out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[k] = docs.collect()
    model = langid.fit(spark.createDataFrame(seen[0], spark.read.parquet(str(tmp_path / "1")).schema).filter(langid.fold("doc_id", 4) != 2))
    labeller = langid.Labeller(model)
    sure = {r["doc_id"] for r in seen[0] if r["text"] and (x := labeller.label(r["text"])) and x[1] >= corpus_pipeline.LEAST_SCORE}
    assert {r["doc_id"] for r in seen[1]} == sure and not sure & {10**6, 10**6 + 1}
    rows = sorted((r["doc_id"], r["text"]) for r in seen[1])
    assert sorted(r["doc_id"] for r in seen[2]) == brute_kept(rows)
    before = {r["doc_id"]: r["text"] for r in seen[2]}
    for r in seen[3]:
        spans = [(a, e) for a, _, e, _ in secrets.scan(before[r["doc_id"]])[0]]
        assert r["text"] == secrets.redact(before[r["doc_id"]], spans) and r["n_chars"] == len(r["text"])
    assert len(seen[3]) == len(seen[2])
    sized = mixing.mix(spark.read.parquet(str(tmp_path / "3")).withColumn("size", mixing.n_words(F.col("text"))), "size").collect()
    count = Counter()
    for r in seen[4]:
        count[r["doc_id"]] += len(r["text"].split())
    assert {r["doc_id"]: r["taken"] for r in sized if r["taken"]} == dict(count)
    pieces = Counter(r["doc_id"] for r in seen[5] if r["piece"] == 0)
    assert pieces == Counter(r["doc_id"] for r in seen[4])


def test_run_on_odd_rows(spark, data, tmp_path):
    """Nulls, repeated rows and ids, very long texts and clashing columns through all stages; an empty table."""
    base = documents(spark, data).limit(60)
    names = ["target", "taken", "score", "__size", "node", "piece", "truncated", "lang_pred", "secret_spans", "n_layers", "__clean", "__node", "__print", "__keys", "root", "size", "source_size"]
    long = " ".join(f"the word{i} and of" for i in range(40_000))
    more = spark.createDataFrame([(None, "the and of this that with which", None, None, None), (7, None, "en", "s", 0), (7, long, "en", "s", len(long)), (8, "", None, "s", 0), (10**6, "the and of password=hunter2secret to be in that", "en", None, 5)], base.schema)
    docs = base.unionByName(base.limit(5)).unionByName(more).unionByName(more).withColumns({c: F.lit("clash") for c in names})
    docs.write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    for name, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, docs, "")
        assert stage.schema.simpleString() == docs.schema.simpleString() and [tuple(r) for r in stage.select(*names).distinct().collect()] == [("clash",) * len(names)], name
    rows = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and sum(parts[-1]) <= packing.CAPACITY
    assert rows and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
