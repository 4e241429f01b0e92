"""Ranked search against scores summed term by term; blocks and tiles of a few rows, ties, nulls, repeated rows, empty tables, other columns."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_row_operators import ODD, empty, odd_docs

from peakframe.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(items, docs, top=50):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n, words = len(counted), sum(k for *_, k in counted)
    held = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        found = []
        for i, c, k in counted:
            m = 50 + 50 * k * n // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if void else i, -s) for r, (s, void, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def got(items, docs, **more):
    df = ranked_search.ranked(items, docs, **more)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def prose(n, seed):
    rng = random.Random(seed)
    words = ["Wört", "É", "x1", "ÀB", "the", "of", "Cat", "dog's", "ﬁne", "日本", "a\x1cb"] + [f"w{k}" for k in range(60)]
    return [(i, rng.choice([" ", "\n", "--", "."]).join(rng.choice(words) for _ in range(rng.randrange(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    docs, items = prose(400, 1), prose(40, 2)
    docs += [(1000 + i, t) for i, t in docs[:150]]  # ties of equal texts
    if small:  # blocks and pieces are cut on the driver and in workers forked later; tiles in closures by value
        for name, value in (("BLOCK_ITEMS", 7), ("BLOCK_BYTES", 900)):
            monkeypatch.setattr(ranked_search, name, value)
    a, b = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert got(a, b, top=9) == brute(items, docs, 9)
    assert got(a, b.filter("doc_id < 20")) == brute(items, [x for x in docs if x[0] < 20])


def test_tiles_are_exact_and_safe_with_ties(monkeypatch):
    monkeypatch.setattr(ranked_search, "ITEM_TILE", 3)
    monkeypatch.setattr(ranked_search, "TERM_TILE", 4)
    rng = np.random.default_rng(3)
    held = rng.integers(1, 50, 30)
    weights = np.full(30, ranked_search.MOST_WEIGHT - 1, dtype=np.int64)
    items = [sorted(rng.choice(30, rng.integers(1, 20), replace=False).tolist()) for _ in range(11)]
    best, want = ranked_search.Best(len(items), 5), []
    tiles = ranked_search.item_tiles(items, held, weights)
    for tile in range(40):
        lists = [np.sort(rng.choice(30, rng.integers(0, 12), replace=False)) for _ in range(16)]
        owner, flat = np.repeat(np.arange(16), [len(x) for x in lists]), np.concatenate(lists)
        impacts = rng.choice([999_998, 999_999], len(flat)).astype(float)
        ids, void = rng.permutation(1000)[:16], rng.random(16) < 0.1
        for numbers, parts in tiles:
            s = ranked_search.tile_scores(16, owner, flat, impacts, parts)
            for d in range(16):
                for c, item in enumerate(numbers):
                    exact = sum(int(weights[t]) * int(x) for t, x in zip(flat[owner == d], impacts[owner == d], strict=True) if t in items[item])
                    assert s[d, c] == exact
                    if exact:
                        want.append((int(item), -exact, bool(void[d]), int(ids[d])))
            best.add(numbers, s, ids, void)
        if tile % 7 == 0:
            best.settle()
    best.settle()
    kept = sorted(zip(best.item.tolist(), (-best.score).tolist(), best.void.tolist(), best.id.tolist(), strict=True))
    assert kept == [x for k in range(len(items)) for x in sorted(w for w in want if w[0] == k)[:5]]


def test_pieces_of_long_texts(monkeypatch):
    text = "Übung macht " * 5000 + "x" * 3000 + " end"
    whole = [w.decode() for p in ranked_search.term_pieces(text) for w in p]
    monkeypatch.setattr(ranked_search, "PIECE", 100)
    assert [w.decode() for p in ranked_search.term_pieces(text) for w in p] == whole == terms(text)
    assert list(ranked_search.term_pieces("")) == []


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "a same"), (1, "a same"), (1, "done TEXT"), (None, "same"), (2, None), (3, ""), (4, " .,"), (5, "nowhere")], "item_id long, text string").withColumns({"doc_id": F.lit("clash"), "score": F.lit(1)})
    docs = [(i if i != 3 else None, t) for i, t in enumerate([*ODD, ODD[-1]])]
    docs[-1] = docs[-2]
    want = brute([(1, "a same"), (1, "done TEXT"), (None, "same"), (5, "nowhere")], docs)
    assert want and got(items, odd_docs(spark)) == want
    assert got(items, empty(spark)) == got(items.limit(0), odd_docs(spark)) == []
