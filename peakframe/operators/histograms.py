"""Fixed-width histograms: global ranges, filling, merging, peak removal, re-binning. A histogram is rows hist_name, lo, hi, nbins, bin, content; bin 0 and nbins + 1 hold what is outside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakframe.functions.labels import fill_index, fs_of, hist_name, im_of, part_of
from peakframe.operators.ordering import placed
from peakframe.operators.selection import pinned
from peakframe.sources.shared import written

#: Signatures with names (a row of about 150 bytes each) that are broadcast; beyond it the join shuffles.
BROADCAST_NAMES = 100_000
#: Signatures of a row of a name's group.
GROUP = 10_000
HIST = ["hist_name", "lo", "hi", "nbins"]


def named(values: DataFrame, sig: str = "signature") -> DataFrame:
    """values with the histogram name of their signature; others are dropped. Each distinct signature is parsed once, in a written table that is joined to the values."""
    s, found = F.col(sig), values.select(sig).distinct()
    parsed = pinned(found, {"__fs": fs_of(s), "__im": im_of(s)}).filter(F.col("__fs") != "").select(sig, hist_name(F.col("__fs"), F.col("__im")).alias("name"))
    names = written(parsed)
    small = names.limit(BROADCAST_NAMES + 1).count() <= BROADCAST_NAMES
    return values.drop("name").join(F.broadcast(names) if small else names, sig)


def grouped_by_name(values: DataFrame, most: int = GROUP, sig: str = "signature") -> DataFrame:
    """name, part (from 0), n, signatures, next: the signatures of each name in order, at most `most` to a row; next is the first of the following part, null in the last.

    Places come from ranges of (name, signature), not from a window over a name, and a row does not grow with the number of files.
    """
    ranked = written(placed(named(values.select(sig).distinct(), sig).select("name", sig), ["name", sig], "__place"))
    first = ranked.groupBy("name").agg(F.min("__place").alias("__first"))
    parts = ranked.join(first, "name").withColumn("part", F.floor((F.col("__place") - F.col("__first")) / most).cast("long"))
    held = written(parts.groupBy("name", "part").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(sig)).alias("signatures")))
    following = held.select("name", (F.col("part") - 1).alias("part"), F.col("signatures")[0].alias("next"))
    return held.join(following, ["name", "part"], "left").select("name", "part", "n", "signatures", "next")


def without_outliers(values: DataFrame, sig: str = "signature") -> DataFrame:
    return values.filter(part_of(F.col(sig)) != "outliers")


def global_ranges(values: DataFrame, key: str = "name", by: tuple[str, ...] = ()) -> DataFrame:
    return values.groupBy(key, *by).agg(F.min("m").alias("gmin"), F.max("m").alias("gmax"))


def filled(values: DataFrame, ranges: DataFrame, widths: list[float], key: str = "name", by: tuple[str, ...] = (), range_by: tuple[str, ...] = ()) -> DataFrame:
    """Histograms of values by key in the key's range, one for each width. Keys without a range are skipped (see unranged).

    Columns `by` of values tell partial histograms apart, which are filled in one pass; ranges may be of the key and `range_by`.
    """
    joined = values.join(ranges, [key, *range_by])
    kinds = F.explode(F.array(*[F.struct(F.lit(float(w)).alias("w"), F.lit(f"_width_{float(w)}").alias("tail")) for w in widths]))
    wide = joined.withColumn("k", kinds)
    nbins = F.greatest(F.ceil((F.col("gmax") - F.col("gmin")) / F.col("k.w")), F.lit(1)).cast("long")
    rows = wide.select(*by, F.concat(F.lit("ROI_"), F.col(key), F.col("k.tail")).alias("hist_name"), F.col("gmin").alias("lo"), F.col("gmax").alias("hi"), nbins.alias("nbins"), "m")
    return rows.withColumn("bin", fill_index(F.col("m"), F.col("lo"), F.col("hi"), F.col("nbins"))).groupBy(*by, *HIST, "bin").agg(F.count("*").alias("content"))


def unranged(values: DataFrame, ranges: DataFrame, key: str = "name") -> DataFrame:
    """Keys that have values but no range."""
    return values.select(key).distinct().join(ranges, key, "left_anti")


def peak_removed(hist: DataFrame) -> DataFrame:
    """Content of bins left of the right-most highest bin set to 0; bins outside stay."""
    inside = F.col("bin").between(1, F.col("nbins"))
    top = hist.filter(inside).groupBy("hist_name").agg(F.max(F.struct("content", "bin")).alias("t")).select("hist_name", F.col("t.bin").alias("peak"))
    return hist.join(top, "hist_name", "left").withColumn("content", F.when(inside & (F.col("bin") < F.col("peak")), F.lit(0).cast("long")).otherwise(F.col("content"))).drop("peak")


def merged(parts: DataFrame) -> DataFrame:
    """Sum of partial histograms bin by bin. Those of a name must share their edges (see edge_conflicts)."""
    return parts.groupBy(*HIST, "bin").agg(F.sum("content").alias("content"))


def edge_conflicts(parts: DataFrame) -> DataFrame:
    """Names whose parts differ in range or number of bins."""
    return parts.groupBy("hist_name").agg(F.count_distinct("lo", "hi", "nbins").alias("forms")).filter("forms > 1")


def created(values: DataFrame, ranges: DataFrame | None = None, widths=(10.0,), by_name: bool = True, exclude_outliers: bool = False, remove_peaks: bool = False) -> DataFrame:
    """The histograms of a table of signature and m: merged by name with given or own ranges, or one for each signature."""
    if exclude_outliers:
        values = without_outliers(values)
    values = named(values) if by_name else values.withColumn("name", F.col("signature"))
    out = filled(values, ranges if ranges is not None else global_ranges(values), list(widths))
    return peak_removed(out) if remove_peaks else out


def target_edge(lo: Column, hi: Column, width: float, i: Column) -> Column:
    """Edge i of bins of the given width from lo on, the last one at hi."""
    return F.least(lo + i * F.lit(float(width)), hi)


def rebinned(hist: DataFrame, width: float) -> DataFrame:
    """Contents redistributed to bins of another width by overlap: hist_name, bin (from 0), left, right, content. Bins outside are left aside.

    Each source bin lists the target bins that it meets, a range of integers, so no range join is needed.
    """
    step = (F.col("hi") - F.col("lo")) / F.col("nbins")
    source = hist.filter(F.col("bin").between(1, F.col("nbins")) & (F.col("content") > 0)).withColumns({"a": F.col("lo") + (F.col("bin") - 1) * step, "b": F.when(F.col("bin") == F.col("nbins"), F.col("hi")).otherwise(F.col("lo") + F.col("bin") * step)})
    w = F.lit(float(width))
    last = F.greatest(F.ceil((F.col("hi") - F.col("lo")) / w) - 1, F.lit(0))
    first = F.greatest(F.floor((F.col("a") - F.col("lo")) / w) - 1, F.lit(0))
    until = F.least(F.ceil((F.col("b") - F.col("lo")) / w) + 1, last)
    met = source.withColumn("t", F.explode(F.sequence(first.cast("long"), until.cast("long"))))
    left, right = target_edge(F.col("lo"), F.col("hi"), width, F.col("t")), F.when(F.col("t") == last, F.col("hi")).otherwise(target_edge(F.col("lo"), F.col("hi"), width, F.col("t") + 1))
    share = F.greatest(F.least("b", right) - F.greatest("a", left), F.lit(0.0)) / (F.col("b") - F.col("a"))
    return met.withColumns({"left": left, "right": right, "share": share}).filter("share > 0").groupBy("hist_name", F.col("t").alias("bin"), "left", "right").agg(F.sum(F.col("content") * F.col("share")).alias("content"))

