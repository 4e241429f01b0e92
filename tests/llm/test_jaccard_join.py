"""Jaccard join against all pairs: components of whole tables, small units and regions, similarities at the threshold, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_near_copies import shingles
from test_row_operators import ODD, empty, odd_docs

from peakframe.llm import jaccard_join
from peakframe.llm.common import documents


def brute(rows):
    """{(id, size, component)} with the smallest id of all that 90 * union <= 100 * intersection links."""
    sets, label = [shingles(t or "", 3) for _, t in rows], list(range(len(rows)))
    holding: dict = {}
    for i, s in enumerate(sets):
        for x in s:
            holding.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holding[x] if j < i}:
            both = len(s & sets[j])
            if label[i] != label[j] and 100 * both >= 90 * (len(s) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [min(a, b) if k in (a, b) else k for k in label]
    first: dict = {}
    for (i, _), k in zip(rows, label, strict=True):
        first[k] = i if first.get(k) is None else first[k] if i is None else min(first[k], i)
    return sorted(((i, len(s), first[k]) for (i, _), s, k in zip(rows, sets, label, strict=True)), key=str)


def got(df, **more):
    out = jaccard_join.jaccard_components(df, **more)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def edited(n, seed, words=4000, longest=300):
    """Texts of which most are copies with some words changed, so that similarities lie on both sides of 0.9; long chains of copies of copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(words)}"
    passage, out = [word() for _ in range(60)], []
    while len(out) < n:
        x = list(rng.choice(out[-80:])) if out and rng.random() < 0.8 else [word() for _ in range(rng.randrange(5, longest))] + (passage if rng.random() < 0.3 else [])
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
            k = rng.randrange(len(x))
            x[k : k + rng.choice([0, 1, 1])] = [word()] if rng.random() < 0.8 else []
            x = x or [word()]
        out.append(x + (x[:10] * 3 if rng.random() < 0.1 else []))
    order = list(range(n))
    rng.shuffle(order)
    return [(i, " ".join(x)) for i, x in zip(order, out, strict=True)]


@pytest.mark.parametrize("unit", [jaccard_join.UNIT, 60_000])
def test_against_all_pairs(spark, unit):
    rows = edited(500, 3)
    want = brute(rows)
    assert 30 < len({c for *_, c in want}) < 400
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), unit=unit) == want


def test_all_documents(spark, data):
    docs = documents(spark, data)
    docs = docs.unionByName(docs.filter("doc_id % 7 = 0").withColumns({"doc_id": F.col("doc_id") + 10**6, "text": F.concat("text", F.lit(" and two"))}))
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_near_sets_share_a_key():
    """At the least similarity, for each size: what differs is as much as may be, and lies where it hurts most slices."""
    rng = np.random.default_rng(5)
    for n in [*range(9, 60), 100, 129, 130, 131, 333, 1000, 5000]:
        for _ in range(40 if n < 1000 else 3):
            either = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            gone = rng.permutation(len(either))[: len(either) // 10]
            half = rng.integers(0, len(gone) + 1)
            a, b = np.delete(either, gone[:half]), np.delete(either, gone[half:])
            assert 100 * (len(either) - len(gone)) >= 90 * len(either)
            if not np.array_equal(a, b):
                assert set(jaccard_join.slice_keys(a).tolist()) & set(jaccard_join.slice_keys(b).tolist()), n


def test_sets_with_many_empty_slices_still_meet():
    """All hashes in one corner of the range: nearly all slices are empty, and keys of empty ones must do."""
    a = np.arange(1, 101, dtype=np.uint64)
    b = np.append(a[:-5], np.arange(1000, 1005, dtype=np.uint64))
    assert set(jaccard_join.slice_keys(a).tolist()) & set(jaccard_join.slice_keys(b).tolist())


@pytest.mark.parametrize("seed", range(6))
def test_regions_lose_no_link(seed, monkeypatch):
    """Pivots, windows and recursion in a unit against all pairs."""
    monkeypatch.setattr(jaccard_join, "PIVOTS", 5)
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    rng = np.random.default_rng(seed)
    cores = [rng.integers(0, 2**64, 120, dtype=np.uint64) for _ in range(12)]
    sets = []
    for _ in range(300):
        core = cores[rng.integers(12)]
        k = rng.integers(0, 14)
        sets.append(np.unique(np.concatenate([np.delete(core, rng.permutation(120)[:k]), rng.integers(0, 2**64, rng.integers(0, 3), dtype=np.uint64)])))
    space = jaccard_join.Space(sets, 90)
    space.join(np.arange(len(sets)))
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [min(a, b) if k in (a, b) else k for k in label]
    assert [space.find(i) for i in range(len(sets))] == label and len(set(label)) > 12


def test_odd_rows(spark):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(ODD)]
    assert got(odd_docs(spark)) == brute([*rows, rows[-1]])
    assert got(empty(spark)) == []
    same = [(None, "a b c d"), (None, "a b c d"), (5, "x y z w"), (4, "X Y  z w"), (5, "x y z w"), (7, ""), (6, None)]
    assert got(spark.createDataFrame(same, "doc_id long, text string")) == sorted([(None, 2, None)] * 2 + [(5, 2, 4)] * 2 + [(4, 2, 4), (7, 0, 7), (6, 0, 6)], key=str)


def test_one_very_long_text(spark):
    long = " ".join(f"w{k}" for k in range(200_000))
    rows = [(1, long), (2, long.replace("w77 ", "v ")), (3, long[:1_000_000]), (4, "w1 w2 w3")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), unit=100_000) == [(1, 199_998, 1), (2, 199_998, 1), (3, len(long[:1_000_000].split()) - 2, 3), (4, 1, 4)]
