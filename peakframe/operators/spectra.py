"""Cleaning of mass spectra: histogram of each key, cut left of the right-most highest bin, tail split at the first empty bin.

`values` tables have key columns and m. Every step is a partial aggregation by (key, bin) and a join back on the key, so one very common key spreads over tasks. Tables of a row for each key
are written, so that values are read in one scan a step, and broadcast while they are small: values are neither shuffled nor sorted then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakframe.functions.labels import bin_index, edge, n_bins
from peakframe.sources.shared import looked_up

WIDTH = 10.0
KEYS = ["fs", "im"]


def ranges(values: DataFrame, keys: list[str] = KEYS, width: float = WIDTH) -> DataFrame:
    """keys, lo, hi, nb."""
    return values.groupBy(*keys).agg(F.min("m").alias("lo"), F.max("m").alias("hi")).withColumn("nb", n_bins(F.col("lo"), F.col("hi"), width))


def binned(values: DataFrame, keys: list[str] = KEYS, width: float = WIDTH) -> DataFrame:
    """values with lo, hi, nb of the key and bin (null where the key has one value only)."""
    return values.join(looked_up(ranges(values, keys, width)), keys).withColumn("bin", bin_index(F.col("m"), F.col("lo"), F.col("hi"), F.col("nb")))


def bin_counts(values: DataFrame, keys: list[str] = KEYS, width: float = WIDTH) -> DataFrame:
    """keys, lo, hi, nb, bin, cnt of occupied bins."""
    return binned(values, keys, width).filter("bin is not null").groupBy(*keys, "lo", "hi", "nb", "bin").agg(F.count("*").alias("cnt"))


def peaks(counts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """keys, peak_bin, peak: the right-most of the highest bins and its lower edge."""
    top = counts.groupBy(*keys, "lo", "hi", "nb").agg(F.max(F.struct("cnt", "bin")).alias("t"))
    return top.select(*keys, F.col("t.bin").alias("peak_bin"), F.col("t.cnt").alias("peak_cnt"), edge(F.col("lo"), F.col("hi"), F.col("nb"), F.col("t.bin")).alias("peak"))


def peak_cut(values: DataFrame, keys: list[str] = KEYS, width: float = WIDTH) -> DataFrame:
    """Values at or right of their key's peak; keys without bins keep all."""
    found = looked_up(peaks(bin_counts(values, keys, width), keys).select(*keys, "peak"))
    return values.join(found, keys, "left").filter(F.col("peak").isNull() | (F.col("m") >= F.col("peak"))).drop("peak")


def first_gaps(counts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """keys, gap_bin, gap: the first empty bin and its lower edge. The first and last bins are never empty, so a gap is a step in the occupied ones."""
    after = F.lead("bin").over(Window.partitionBy(*keys).orderBy("bin"))
    steps = counts.withColumn("after", after).filter(F.col("after") - F.col("bin") > 1)
    gap = steps.groupBy(*keys, "lo", "hi", "nb").agg((F.min("bin") + 1).alias("gap_bin"))
    return gap.select(*keys, "gap_bin", edge(F.col("lo"), F.col("hi"), F.col("nb"), F.col("gap_bin")).alias("gap"))


def tail_split(values: DataFrame, keys: list[str] = KEYS, width: float = WIDTH) -> DataFrame:
    """values with part: `outliers` from the first empty bin on (if it isn't bin 0 or 1), else `main`."""
    gaps = looked_up(first_gaps(bin_counts(values, keys, width), keys).filter("gap_bin > 1").select(*keys, "gap"))
    return values.join(gaps, keys, "left").withColumn("part", F.when(F.col("m") >= F.col("gap"), "outliers").otherwise("main")).drop("gap")


def post_process(values: DataFrame, keys: list[str] = KEYS, width: float = WIDTH) -> DataFrame:
    """Peak cut, then tail split on what is left, over all source files together."""
    return tail_split(peak_cut(values, keys, width), keys, width)
