"""The class-conditional models against Kneser-Ney written down with plain dictionaries, and the joined weights against the broadcast ones."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakframe.llm import toxicity as X
from peakframe.llm.common import cut

WORDS = ["you", "are", "nice", "vile", "vilest", "thing", "straße", "ünnice", "of", "a", "12", "зло", "\U0001d400x"]


def corpus():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        y = int(i % 3 == 0)
        words = list(rng.choice(WORDS, rng.integers(0, 12))) + (["vile"] * int(rng.integers(1, 4)) if y else [])
        rows.append((i, " ".join(words) if i % 17 else None, y if i % 13 else None, i % 4 == 0))
    return rows


class Plain:
    """Interpolated Kneser-Ney of one class, the lower orders over both classes."""

    def __init__(self, rows):
        self.counts = [Counter(), Counter()]
        for text, y in rows:
            for w in X.WORD.findall((text or "").lower()):
                s = f"{X.PAD}{w}{X.STOP}"
                self.counts[y].update(s[i : i + 5] for i in range(len(s) - 4))
        self.levels = {5: set(self.counts[0]) | set(self.counts[1])}
        self.cont = {}
        for k in (4, 3, 2, 1):
            ends = defaultdict(set)
            for g in self.levels[k + 1]:
                ends[g[1:]].add(g[0])
            self.cont[k] = {g: len(x) for g, x in ends.items()}
            self.levels[k] = set(ends)

    def interpolated(self, counts, g, below):
        after = {x: n for x, n in counts.items() if x[:-1] == g[:-1]}
        total = sum(after.values())
        if not total:
            return below
        return (max(counts.get(g, 0) - 0.75, 0) + sum(min(n, 0.75) for n in after.values()) * below) / total

    def shared(self, g):
        if len(g) == 1:
            c = self.cont[1]
            return (max(c.get(g, 0) - 0.75, 0) + sum(min(n, 0.75) for n in c.values()) / (len(c) + 1)) / sum(c.values())
        return self.interpolated(self.cont[len(g)], g, self.shared(g[1:]))

    def log(self, word, y):
        s = f"{X.PAD}{word}{X.STOP}"
        return sum(math.log(self.interpolated(self.counts[y], s[i : i + 5], self.shared(s[i + 1 : i + 5]))) for i in range(len(s) - 4))

    def mean(self, text):
        words = X.WORD.findall((text or "").lower())
        ratios = [min(self.log(w, 1) - self.log(w, 0), X.MOST_EVIDENCE) for w in words]
        return sum(math.log(1 - X.TOXIC_SHARE + X.TOXIC_SHARE * math.exp(r)) for r in ratios) / len(words) if words else 0.0


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def labelled(spark, rows):
    return spark.createDataFrame([(t, y, h) for _, t, y, h in rows], "text string, label int, held boolean")


TEXTS = ["you vile thing", "nicest of things", "", None, "зло zzz", "vile " * 50, "ünnice straße 12 a of", "!!!", "x" * 3000, "you vile thing"]


@pytest.mark.parametrize(("hot", "bits"), [(1 << 20, 1 << 20), (40, 1 << 12), (0, 64)])
def test_ratios_are_those_of_plain_dictionaries(spark, rows, labelled, hot, bits):
    model = X.fit(labelled, hot_rows=hot, filter_bits=bits)
    assert (model.cold is None) == (hot > 1000) and len(model.hot.value[0]) <= hot
    plain = Plain([(t, y) for _, t, y, held in rows if y is not None and not held])
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "i int, text string, __other string")
    got = {r["i"]: r["x"] for r in X.likelihoods(df, model, "text", "x").collect()}
    assert [got[i] for i in range(len(TEXTS))] == pytest.approx([plain.mean(t) for t in TEXTS], rel=1e-4, abs=1e-6)
    scored = {r["i"]: r for r in X.score_toxicity(df, model).collect()}
    assert all(r["score"] == pytest.approx(1 / (1 + math.exp(-(plain.mean(TEXTS[i]) * model.slope + model.offset))), abs=1e-3) and r["predicted"] == int(r["score"] >= 0.5) for i, r in scored.items())


def test_probabilities_sum_to_one(rows):
    """What the brute force gives is a distribution: over all characters seen and an unseen one."""
    plain = Plain([(t, y) for _, t, y, _ in rows if y is not None])
    characters = [*plain.cont[1], "unseen"]
    for h in ("\x02\x02\x02\x02", "\x02\x02vi", "zzzz"):
        below = lambda c, h=h: plain.shared(h[1:] + c) if c != "unseen" else plain.shared(h[1:] + "\x07")
        assert sum(plain.interpolated(plain.counts[1], h + (c if c != "unseen" else "\x07"), below(c)) for c in characters) == pytest.approx(1)


def test_one_class_or_none(spark, labelled):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    ordinary = X.fit(labelled.filter("label = 0"))
    assert {r["predicted"] for r in X.score_toxicity(texts, ordinary).collect()} == {0}
    assert {r["predicted"] for r in X.score_toxicity(texts, X.fit(labelled.filter("label = 1"))).collect()} == {1}
    nothing = X.fit(labelled.limit(0))
    assert len({r["score"] for r in X.score_toxicity(texts, nothing).collect()}) == 1


def test_counts_over_slices(spark, labelled, monkeypatch):
    once = {r["g"]: (r["toxic"], r["ordinary"]) for r in cut(X.counted_grams(labelled.filter(F.col("label").isNotNull()), "text", "label")).collect()}
    monkeypatch.setattr(X, "SLICE_BYTES", 10)
    again = {r["g"]: (r["toxic"], r["ordinary"]) for r in X.counted_grams(labelled.filter(F.col("label").isNotNull()).repartition(3), "text", "label").collect()}
    assert once == again and once
