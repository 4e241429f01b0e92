"""Exact quantiles against sorted values, and metrics observed while rows are written."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakframe.operators import quantiles as Q
from peakframe.operators import statistics as S
from peakframe.sources.shared import scratch

AT = [0.0, 0.01, 0.25, 0.5, 0.75, 1 / 3, 0.99, 1.0]


def numbers(kind):
    rng = random.Random(4)
    if kind == "wide":
        return [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(501)] + [0.0, -0.0, math.inf, -math.inf, 5e-324]
    if kind == "ties":
        return [rng.choice([1.5, 1.5, 2.25, -3.0]) for _ in range(400)]
    if kind == "long":
        return [rng.choice([-(2**63), 2**63 - 1, 0, -1, rng.randrange(-(10**12), 10**12)]) for _ in range(333)]
    if kind == "small":
        return [rng.randrange(1000, 1100) for _ in range(1000)]
    return [7] if kind == "one" else [3.5, 3.5]


@pytest.mark.parametrize("kind", ["wide", "ties", "long", "small", "one", "same"])
def test_ranks_are_those_of_sorted_values(spark, kind):
    values = numbers(kind)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, f"`a b` {'long' if isinstance(values[0], int) else 'double'}").repartition(3)
    want = sorted(values)
    ranks = sorted({0, len(want) // 3, len(want) // 2, len(want) - 1})
    assert Q.at_ranks(df, "a b", lambda n: ranks) == [want[r] for r in ranks]
    if kind not in ("wide", "long"):
        assert Q.exact_quantiles(df, "a b", AT) == pytest.approx([float(np.quantile(want, q)) for q in AT])


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert Q.exact_quantiles(df, "v", [0.5, 0.9]) == [None, None] and Q.exact_quantiles(df.limit(0), "v", [0.5]) == [None]


def test_statistics_have_no_percentile_in_their_plan(spark):
    entries = spark.createDataFrame([(f"ROI_mass_m0_cat_1ex_width_{i}", i * i) for i in range(9)], "hist_name string, entries long")
    df = S.hist_stats(entries)
    assert df.first()["median_entries"] == 16.0 and "percentile" not in df._jdf.queryExecution().toString()


def test_observed_metrics_come_with_the_write(spark):
    """No job beside the write's own, and only the chosen rows in the table."""
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    path = scratch(spark, "observed")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed-write", "")
    row = S.written_observed(df, path, [F.count("*").alias("n"), F.sum("id").alias("total"), F.count_if(F.col("id") > 89).alias("late"), F.max("g").cast("string").alias("g")], keep=F.col("id") > 89, partition_by=("g",)).collect()
    jobs = len(tracker.getJobIdsForGroup("observed-write"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [tuple(r) for r in row] == [(100, 4950, 10, "2")] and jobs <= 2
    assert spark.read.parquet(path).count() == 10
