"""Near copies of the pipeline against brute force over all pairs of texts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_row_operators import ODD, empty, odd_docs

import corpus_pipeline
from peakframe.llm import near_copies
from peakframe.llm.common import documents


def shingles(text, n=5):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_kept(rows, least=0.8):
    """Smallest ids of the groups linked by a Jaccard similarity of `least` or more."""
    sets, label = [shingles(t or "") for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if label[i] != label[j] and both >= least * (len(a) + len(sets[j]) - both):
                x, y = label[i], label[j]
                label = [min(x, y) if k in (x, y) else k for k in label]
    first = {}
    for (i, _), k in zip(rows, label, strict=True):
        first[k] = min(first.get(k, i), i)
    return sorted(first.values())


def edited(n=240, seed=5):
    """Texts of which some are copies with a few words changed, so that similarities lie on both sides of 0.8; some share a long passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passage, out = [word() for _ in range(40)], []
    while len(out) < n:
        x = list(rng.choice(out)) if out and rng.random() < 0.6 else [word() for _ in range(rng.randrange(30, 250))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
            x[rng.randrange(len(x))] = word()
        out.append(x)
    return [(i, " ".join(x)) for i, x in enumerate(out)]


@pytest.mark.parametrize("unit", [4096, 24])
def test_all_near_copies_go_and_no_others(spark, unit):
    rows = edited()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_kept(rows)
    assert 20 < len(want) < 200
    assert sorted(r["doc_id"] for r in near_copies.one_of_each(docs, unit=unit).collect()) == want


def test_stage_on_all_documents(spark, data):
    docs = documents(spark, data).unionByName(documents(spark, data).filter("doc_id % 7 = 0").withColumns({"doc_id": F.col("doc_id") + 10**6, "text": F.concat("text", F.lit(" and five words more here"))}))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = corpus_pipeline.near_duplicates(spark, docs, data)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == brute_kept(rows)


def test_near_copies_of_odd_rows(spark):
    kept = near_copies.one_of_each(odd_docs(spark)).collect()
    blank = [r for r in kept if not (r["text"] or "").strip()]
    assert len(blank) == 1 and blank[0]["doc_id"] == 0
    assert sum(r["text"] == "same" for r in kept) == 1 and all(r["media"] == "clash" for r in kept)
    assert len(kept) == len({" ".join((t or "").split()) for t in ODD})
    assert near_copies.one_of_each(empty(spark)).count() == 0


@pytest.mark.parametrize("unit", [4096, 24])
def test_repeats_inside_texts_lose_no_link(spark, unit):
    """Lines repeated hundreds of times count once in the similarity, and so they must in what finds candidates."""
    rng, rows = random.Random(3), []
    for i in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(60, 300))]
        k = rng.randrange(len(words) - 12)
        line = words[k : k + 10]
        rows += [(10 * i, " ".join(words)), (10 * i + 1, " ".join(words[: k + 10] + line * 200 + words[k + 10 :])), (10 * i + 2, " ".join(words + [f"x{i}"] * 500))]
    want = brute_kept(rows)
    assert len(want) < 80
    assert sorted(r["doc_id"] for r in near_copies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), unit=unit).collect()) == want
