"""Combinations by bitmaps against the conditions tried for every pair."""

from __future__ import annotations

import itertools
import time

import pytest
from pyspark.sql import functions as F

from peakframe.operators import mass as M
from peakframe.operators.matching import at_least, exactly, matching

TYPES = ["Electrons", "Muons", "Jets", "BJets", "Photons", "Taus"]


def states(spark, most, types=TYPES, step=1):
    rows = list(itertools.product(range(most + 1), repeat=len(types)))[::step]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["state", *[f"c_{t}" for t in types]])


def plan(df) -> str:
    df.collect()  # the plan that ran
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("allowed", "tried"), [(exactly, M.fits), (at_least, M.contains)])
@pytest.mark.parametrize("subleading", [None, 2])
def test_pairs_are_those_of_the_conditions(spark, allowed, tried, subleading):
    combos = M.combinations(spark, TYPES, types_range=(1, 4), subleading=subleading)
    s = states(spark, 5, step=37)
    got = matching(s, combos, allowed)
    assert got.columns == [*s.columns, *combos.columns]
    want = sorted(tuple(r) for r in s.join(combos, tried()).select("state", "seq").collect())
    assert sorted(tuple(r) for r in got.select("state", "seq").collect()) == want and len(want) > 1000
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_combinations_without_numbers_and_some_types(spark):
    four = TYPES[:3]
    combos = M.combinations(spark, four).drop("seq").withColumn("note", F.lit("kept"))
    s = states(spark, 4, four)
    got = sorted((r["state"], r["im"], r["note"]) for r in matching(s, combos, at_least, four).collect())
    assert got == sorted((r["state"], r["im"], "kept") for r in s.join(combos, M.contains(four)).collect())
    assert matching(s, combos.limit(0), at_least, four).count() == 0 and matching(s.limit(0), combos, exactly, four).count() == 0


def test_many_combinations_take_seconds(spark):
    """Without a cap on particles, with sub-leading ranks: tens of thousands of combinations, and a thousand states."""
    combos = M.written(M.combinations(spark, TYPES, types_range=(1, 6), most=24, subleading=1))
    assert combos.count() > 12_000
    s, began = states(spark, 4, step=15), time.time()
    got = matching(s, combos).groupBy("state").agg(F.count("*").alias("n")).collect()
    assert time.time() - began < 60 and len(got) > 900
    few = s.filter("state % 97 = 0")
    assert {r["state"]: r["n"] for r in got if r["state"] % 97 == 0} == {r["state"]: r["count"] for r in few.join(combos, M.fits()).groupBy("state").count().collect()}


def test_spectra_have_no_nested_loops(spark, data):
    from peakframe.plans import event_queries as Q

    for f in (Q.events_x_combos, Q.gen_combos, Q.gen_combos_subleading, Q.fs_contains_combo):
        assert "NestedLoop" not in plan(f(spark, data)), f.__name__
