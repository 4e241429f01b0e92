"""Exact quantiles of any number of rows by radix selection: passes that count the digits of the values' bits, highest first, each leaving the digit that the wanted rank falls in."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a digit: a pass has so many counts, as a power of two, for each value looked for.
DIGIT = 13
SIGN = 1 << 63


def _key(v: Column, floating: bool) -> Column:
    """64 bits in whose unsigned order values are in theirs; NaN is greatest, and -0.0 is 0.0."""
    top = F.lit(-SIGN).cast("long")
    if not floating:
        return v.cast("long").bitwiseXOR(top)
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(v.cast("double"), F.lit(0.0)) + 0.0).cast("long")
    return F.when(v.isNull(), None).when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(top))


def _value(key: int, floating: bool) -> int | float:
    if not floating:
        return key - SIGN
    bits = key ^ SIGN if key & SIGN else key ^ ((1 << 64) - 1)
    return struct.unpack("<d", struct.pack("<Q", bits))[0]


def at_ranks(df: DataFrame, column: str, ranks) -> list:
    """The values at the places (from 0, of `n` values that aren't null) that ranks(n) gives, in order of value. Whole numbers up to 64 bits, or floating ones; pass a written table, for it is read several times.

    One pass finds the bits that all values share, each of the others settles DIGIT bits: five at most. What a task sends on, and the driver gets, are counts of digits, bounded whatever the rows.
    """
    floating = df.schema[column].dataType.typeName() in ("float", "double")
    keys = df.select(_key(F.col(f"`{column}`"), floating).alias("k")).filter("k is not null")
    flip = F.col("k").bitwiseXOR(F.lit(-SIGN).cast("long"))  # Spark compares signed
    n, low, high = keys.agg(F.count("*"), F.min(flip), F.max(flip)).first()
    wanted = ranks(n)
    if not wanted or not n:
        return [None] * len(wanted)
    low, high = (x + SIGN for x in (low, high))
    rest = (low ^ high).bit_length()
    found = [(high >> rest, r) for r in wanted]  # bits known so far, and the rank among the values that begin so
    while rest:
        width = min(DIGIT, rest)
        known = sorted({p for p, _ in found})
        begin = F.shiftrightunsigned("k", rest) if rest < 64 else F.lit(0).cast("long")
        within = keys.filter(begin.isin([p - (1 << 64) if p >= SIGN else p for p in known]))
        digit = F.shiftrightunsigned("k", rest - width) if rest > width else F.col("k")
        counts: dict[int, int] = {r["d"] % (1 << 64): r["c"] for r in within.groupBy(digit.alias("d")).agg(F.count("*").alias("c")).collect()}
        rest -= width
        step = []
        for p, r in found:
            for d in sorted(d for d in counts if d >> width == p):
                if r < counts[d]:
                    step.append((d, r))
                    break
                r -= counts[d]
        found = step
    return [_value(p, floating) for p, _ in found]


def exact_quantiles(df: DataFrame, column: str, at: list[float]) -> list[float | None]:
    """Quantiles between 0 and 1, between two values in proportion, as an exact percentile gives them; None of no values. Nulls don't count. See at_ranks."""

    def ranks(n: int) -> list[int]:
        return [r for q in at for r in (int(q * (n - 1)), min(int(q * (n - 1)) + 1, n - 1))] if n else [0] * (2 * len(at))

    values, n = at_ranks(df, column, ranks), df.filter(F.col(f"`{column}`").isNotNull()).count()
    out: list[float | None] = []
    for i, q in enumerate(at):
        a, b = values[2 * i : 2 * i + 2]
        out.append(None if a is None else float(a) + (q * (n - 1) - int(q * (n - 1))) * (float(b) - float(a)) if a != b else float(a))
    return out
