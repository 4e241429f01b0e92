"""Which combinations a final state fits, by a bitmap index: for each type and count the set of combinations that it allows. A state's combinations are the intersection of six of these sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakframe.functions.labels import FS_ORDER
from peakframe.sources.shared import written

#: Bits of a word of a set.
WORD = 64


def exactly(n: Column, s: Column, c: Column) -> Column:
    """A count that a combination takes as a whole: n where its first rank is 0, else at least s + n; absent types take any."""
    return (n == 0) | F.when(s == 0, c == n).otherwise(c >= s + n)


def at_least(n: Column, s: Column, c: Column) -> Column:
    """A count that has the ranks of a combination."""
    return (n == 0) | (c >= s + n)


def bitmaps(combos: DataFrame, kind: str, allowed, most: int, words: int) -> DataFrame:
    """count, bits: for each count from 0 to `most` of one type the combinations (by seq) that allow it, as an array of words. A row for each count."""
    n, s = F.col(f"n_{kind}"), F.col(f"s_{kind}")
    each = combos.select("seq", n.alias("n"), s.alias("s"), F.explode(F.sequence(F.lit(0), F.lit(most))).alias("count")).filter(allowed(F.col("n"), F.col("s"), F.col("count")))
    word = each.groupBy("count", F.floor(F.col("seq") / WORD).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(seq % {WORD} AS int))")).alias("bits"))
    held = word.groupBy("count").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    return held.select("count", F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long"))).alias("bits"))


def matching(states: DataFrame, combos: DataFrame, allowed=exactly, types: list[str] = FS_ORDER) -> DataFrame:
    """states (with counts c_{T}) joined to the combinations (n_{T}, s_{T}, and more columns) whose counts they have, by equalities alone.

    Sets are words of bits, one for each type and count, broadcast: they come from parameters, a few thousand words at most. Counts above every combination's need are one. The work is a few
    operations a state for each 64 combinations, and one row for each pair that fits. Combinations without a number `seq` get one.
    """
    given = combos.columns
    if "seq" not in given:
        from pyspark.sql import Window

        combos = combos.withColumn("seq", F.row_number().over(Window.orderBy(*[f"{k}_{t}" for t in types for k in "ns"])) - 1)
    combos = written(combos)
    need = F.greatest(F.lit(0), *[F.col(f"n_{t}") + F.col(f"s_{t}") for t in types])
    top, last = combos.agg(F.max(need), F.max("seq")).first()
    if last is None:
        return states.withColumns({c: F.lit(None).cast(combos.schema[c].dataType) for c in given}).filter(F.lit(False))
    most, words = top + 1, last // WORD + 1
    found = states
    for i, t in enumerate(types):
        index = bitmaps(combos, t, allowed, most, words).withColumnsRenamed({"count": f"__count{i}", "bits": f"__bits{i}"})
        found = found.join(F.broadcast(index), F.least(F.col(f"c_{t}"), F.lit(most)) == F.col(f"__count{i}")).drop(f"__count{i}")
    both = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)), [F.col(f"__bits{i}") for i in range(len(types))])
    word = found.select(*states.columns, F.posexplode(both).alias("__word", "__set")).filter("__set != 0")
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.getbit("__set", b) == 1)
    pairs = word.select(*states.columns, "__word", F.explode(bits).alias("__bit")).select(*states.columns, (F.col("__word") * WORD + F.col("__bit")).alias("__seq"))
    return pairs.join(F.broadcast(combos), F.col("__seq") == F.col("seq")).select(*states.columns, *given)
