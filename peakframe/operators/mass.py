"""Combinations of particles and the invariant masses of those that events have."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peakframe.functions.labels import FS_ORDER, LETTERS, REST_MASS, four_vector, fs_label, im_label, mev_to_gev, particle_mass, signed_mass, total
from peakframe.operators.matching import at_least, exactly, matching
from peakframe.operators.selection import pinned, valid_final_state
from peakframe.sources.shared import looked_up, stored, written

#: Events that a final state has at least, and the most particles of a combination.
MIN_EVENTS, MOST = 10, 4


def combinations(spark: SparkSession, types: list[str], types_range=(1, 4), count_range=(1, 4), most: int = MOST, subleading: int | None = None, limit: int | None = None) -> DataFrame:
    """Combinations as columns n_{T} (0: absent) and s_{T} (first rank), with im and seq.

    All subsets of types of a size in range with counts in range, `most` particles in all and 2 at least. With `subleading`, first ranks from 0 to subleading - count + 1 too.
    seq counts them: fewer types first, then in the order of types, counts and ranks. The table has at most a few thousand rows, from parameters alone.
    """
    df = spark.range(1).select(*[])
    low, high = count_range
    for t in types:
        df = df.withColumn(f"n_{t}", F.explode(F.array(F.lit(0), *[F.lit(i) for i in range(max(low, 1), high + 1)])))
    n = {t: F.col(f"n_{t}") for t in types}
    size, present = sum(n.values(), F.lit(0)), sum((F.when(c > 0, 1).otherwise(0) for c in n.values()), F.lit(0))
    df = df.filter(size.between(2, most) & present.between(*types_range)).dropDuplicates([f"n_{t}" for t in types])
    for t in types:
        top = F.greatest(F.lit(0), F.lit(subleading) - n[t] + 1) if subleading is not None else F.lit(0)
        df = df.withColumn(f"s_{t}", F.explode(F.when(n[t] > 0, F.sequence(F.lit(0), top)).otherwise(F.array(F.lit(0)))))
    s = {t: F.col(f"s_{t}") for t in types}
    lead = sum((F.when(s[t] > 0, 1).otherwise(0) for t in types), F.lit(0)) > 0
    full_n, full_s = n | {t: F.lit(0) for t in LETTERS if t not in n}, s | {t: F.lit(0) for t in LETTERS if t not in s}
    df = df.withColumn("im", im_label(full_n, full_s))
    order = [lead, present, *[F.when(n[t] > 0, 0).otherwise(1) for t in types], *[n[t] for t in types], *[s[t] for t in types]]
    keyed = df.withColumn("key", F.struct(*[x.cast("int").alias(f"k{i}") for i, x in enumerate(order)]))
    from pyspark.sql import Window

    out = keyed.withColumn("seq", F.row_number().over(Window.orderBy("key")) - 1).drop("key")
    return out if limit is None else out.filter(F.col("seq") < limit)


def with_counts(events: DataFrame) -> DataFrame:
    return events.withColumns({f"c_{t}": F.size(t) for t in FS_ORDER})


def counts_of(types=FS_ORDER) -> dict[str, Column]:
    return {t: F.col(f"c_{t}") for t in types}


def labelled(events: DataFrame, cap: int = 4, **ranges) -> DataFrame:
    """Events of a valid final state with their counts c_{T} and label fs (counts capped)."""
    df = with_counts(events).filter(valid_final_state(counts_of(), **ranges))
    return df.withColumn("fs", fs_label(counts_of(), cap))


def populous(df: DataFrame, least: int = MIN_EVENTS, scope: str = "global") -> DataFrame:
    """(source_file,) fs and n of final states with at least `least` events, over all files or in each."""
    keys = ["fs"] if scope == "global" else ["source_file", "fs"]
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def contains(types=FS_ORDER) -> Column:
    """Whether a final state has the particles of a combination at all: counts of at least s + n."""
    return reduce(lambda x, y: x & y, [at_least(F.col(f"n_{t}"), F.col(f"s_{t}"), F.col(f"c_{t}")) for t in types])


def fits(types=FS_ORDER) -> Column:
    """A combination's count condition on c_{T}: exactly n_{T} where s_{T} is 0, else at least s + n; absent types are free."""
    return reduce(lambda x, y: x & y, [exactly(F.col(f"n_{t}"), F.col(f"s_{t}"), F.col(f"c_{t}")) for t in types])


def populous_states(df: DataFrame, least: int = MIN_EVENTS, scope: str = "global") -> DataFrame:
    """(source_file,) fs and counts c_{T} of the final states that populous() keeps. Events are gone through once: its numbers are sums of theirs."""
    keys = ["fs"] if scope == "global" else ["source_file", "fs"]
    states = written(df.groupBy(*keys, *[f"c_{t}" for t in FS_ORDER]).agg(F.count("*").alias("k")))
    enough = states.groupBy(*keys).agg(F.sum("k").alias("n")).filter(F.col("n") >= least)
    return states.join(enough.drop("n"), keys, "left_semi").drop("k")


def channels(df: DataFrame, combos: DataFrame, least: int = MIN_EVENTS, scope: str = "global") -> DataFrame:
    """(final state, combination) pairs that can have masses, for an equi-join with events on the state.

    States are a few thousand rows whatever the events; a bitmap index gives each its combinations, so no condition is tried for each pair.
    """
    counts = [f"c_{t}" for t in FS_ORDER]
    states = populous_states(df, least, scope)
    if scope == "global":
        return matching(states, combos)
    return states.join(matching(states.select("fs", *counts).distinct(), combos), ["fs", *counts])


def vectors(events: DataFrame, use_stored_mass: bool = False) -> DataFrame:
    """Events with v_{T}: four-vectors of each type, by momentum. Rest masses are constants unless stored ones are asked for."""

    def of(t: str):
        return lambda p: four_vector(p, particle_mass(p["mass"], t) if use_stored_mass else F.lit(REST_MASS[t]))

    return events.withColumns({f"v_{t}": F.transform(F.sort_array(t, asc=False), of(t)) for t in FS_ORDER})


def chosen(types=FS_ORDER) -> Column:
    """The four-vectors that n_{T}, s_{T} choose from v_{T}."""
    return F.concat(*[F.slice(f"v_{t}", F.col(f"s_{t}") + 1, F.col(f"n_{t}")) for t in types])


def mass_spectrum(events: DataFrame, combos: DataFrame, least: int = MIN_EVENTS, scope: str = "global", use_stored_mass: bool = False, digits: int | None = 6) -> DataFrame:
    """fs, im, source_file, event_id, m (GeV) for each event and combination that fits its final state exactly; final states with few events are left out.

    A channel whose masses are all 0 is left out too. Masses are rounded to `digits` so that equal events give equal masses on any machine.

    Events are read, cut and labelled once: every valid state has its combinations beforehand, from parameters alone, and broadcast. Which states have few events, and which channels only zeros, is told by the
    stored masses, as an event has one in each channel of its state.
    """
    keys = ["fs"] if scope == "global" else ["source_file", "fs"]
    pairs = looked_up(matching(valid_states(events.sparkSession), combos).select("fs", "im", *[f"{k}_{t}" for t in FS_ORDER for k in "ns"]))
    m = mev_to_gev(signed_mass(F.col("__v")))
    if digits is not None:
        m = F.round(m, digits) + 0.0
    ready = vectors(labelled(events), use_stored_mass).select("event_id", "source_file", "fs", *[f"v_{t}" for t in FS_ORDER])
    # the mass names its four-vector many times, which is computed once
    summed = pinned(ready.join(pairs, "fs").select("fs", "im", "source_file", "event_id", *[c for t in FS_ORDER for c in (f"n_{t}", f"s_{t}", f"v_{t}")]), {"__v": total(chosen())})
    found = stored(summed.select("fs", "im", "source_file", "event_id", m.alias("m")), "masses")
    times = pairs.groupBy("fs", "im").agg(F.count("*").alias("times"))  # more than 1 where a combination is listed again
    sizes = found.groupBy(*keys, "im").agg(F.count("*").alias("k"), F.bool_or(F.col("m") == 0).alias("zero"), F.bool_or(F.col("m") != 0).alias("some"))
    enough = written(sizes.join(times, ["fs", "im"]).filter(F.col("k") >= F.col("times") * least))
    empty = enough.groupBy("fs", "im").agg(F.bool_or("zero").alias("zero"), F.bool_or("some").alias("some")).filter("zero AND NOT some")
    good = looked_up(enough.join(empty, ["fs", "im"], "left_anti").select(*keys, "im"))
    return found.join(good, [*keys, "im"], "left_semi").select("fs", "im", "source_file", "event_id", "m")


def valid_states(spark: SparkSession, cap: int = 4) -> DataFrame:
    """fs and counts c_{T} of every valid final state, some thousands."""
    df = spark.range(1).select()
    for t in FS_ORDER:
        df = df.withColumn(f"c_{t}", F.explode(F.sequence(F.lit(0), F.lit(cap))))
    return df.filter(valid_final_state(counts_of())).withColumn("fs", fs_label(counts_of(), cap))


def drop_empty(masses: DataFrame) -> DataFrame:
    """Without channels (fs, im) of which every mass is 0. Pass a written table."""
    empty = written(masses.groupBy("fs", "im").agg(F.bool_or(F.col("m") == 0).alias("zero"), F.bool_or(F.col("m") != 0).alias("some")).filter("zero AND NOT some").select("fs", "im"))
    return masses if empty.isEmpty() else masses.join(looked_up(empty), ["fs", "im"], "left_anti")
