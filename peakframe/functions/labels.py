"""Labels of final states, combinations, signatures and histograms, and other scalar functions, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of the types; their order in final states and in combinations; rest masses in GeV.
LETTERS = {"Electrons": "e", "Jets": "j", "Photons": "g", "Muons": "m", "Taus": "t", "BJets": "b"}
FS_ORDER = ["Electrons", "Muons", "Jets", "Photons", "Taus", "BJets"]
IM_ORDER = ["Electrons", "Muons", "Jets", "BJets", "Photons", "Taus"]
REST_MASS = {"Muons": 0.105, "Photons": 0.0, "Electrons": 0.000511, "Jets": 0.0, "BJets": 0.0, "Taus": 1.77686}

FS_PATTERN = r"_FS_(\d+e_\d+m_\d+j_\d+g(?:_\d+t)?(?:_\d+b)?)_IM_([emjgtb\d]+)$"


def fs_label(counts: dict[str, Column], cap: int | None = None) -> Column:
    """`2e_0m_1j_0g_0t_0b` from a count for each type, each capped if asked."""
    parts = [F.concat((F.least(counts[t], F.lit(cap)) if cap else counts[t]).cast("string"), F.lit(LETTERS[t])) for t in FS_ORDER]
    return F.concat_ws("_", *parts)


def fs_cap(label: Column, cap: int = 4) -> Column:
    """The label with each count capped."""
    pieces = F.split(label, "_")
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.least(F.regexp_extract(p, r"^(\d+)", 1).cast("int"), F.lit(cap)).cast("string"), F.regexp_extract(p, r"([a-z]+)$", 1))), "_")


def im_label(counts: dict[str, Column], starts: dict[str, Column]) -> Column:
    """`e0e1j0` from a count and a first rank for each type."""
    ranks = lambda t: F.when(counts[t] > 0, F.array_join(F.transform(F.sequence(starts[t], starts[t] + counts[t] - 1), lambda i: F.concat(F.lit(LETTERS[t]), i.cast("string"))), "")).otherwise("")
    return F.concat(*[ranks(t) for t in IM_ORDER])


def signature(file: Column, fs: Column, im: Column) -> Column:
    return F.concat(F.replace(file, F.lit(".root"), F.lit("")), F.lit("_FS_"), fs, F.lit("_IM_"), im)


def without_part(sig: Column) -> Column:
    return F.regexp_replace(sig, "(_main|_outliers)$", "")


def fs_of(sig: Column) -> Column:
    """Final state of a signature; empty if it has none."""
    return F.regexp_extract(without_part(sig), FS_PATTERN, 1)


def im_of(sig: Column) -> Column:
    return F.regexp_extract(without_part(sig), FS_PATTERN, 2)


def part_of(sig: Column) -> Column:
    return F.when(sig.endswith("_outliers"), "outliers").when(sig.endswith("_main"), "main").otherwise("")


def hist_name(fs: Column, im: Column) -> Column:
    """`mass_{im}_cat_{2ex_0mx_...}`."""
    return F.concat(F.lit("mass_"), F.when(im == "", "none").otherwise(im), F.lit("_cat_"), F.regexp_replace(fs, r"(\d+)([emjgtb])", "$1$2x"))


def roi_name(base: Column, width: float) -> Column:
    return F.concat(F.lit("ROI_"), base, F.lit(f"_width_{float(width)}"))


def particle_types(im: Column) -> Column:
    """The letters that a combination's label has, each once."""
    return F.array_distinct(F.regexp_extract_all(im, F.lit(r"([emjgtb])(\d+)"), F.lit(1)))


def mev_to_gev(m: Column) -> Column:
    return m * 1e-3


def four_vector(p: Column, mass: Column | float) -> Column:
    """(px, py, pz, e) of a particle (pt, eta, phi) of the given mass."""
    m = mass if isinstance(mass, Column) else F.lit(float(mass))
    along = p["pt"] * F.cosh(p["eta"])
    return F.struct((p["pt"] * F.cos(p["phi"])).alias("px"), (p["pt"] * F.sin(p["phi"])).alias("py"), (p["pt"] * F.sinh(p["eta"])).alias("pz"), F.sqrt(along * along + m * m).alias("e"))


def signed_mass(v: Column) -> Column:
    """Mass of a four-vector; negative where it is space-like."""
    square = v["e"] * v["e"] - v["px"] * v["px"] - v["py"] * v["py"] - v["pz"] * v["pz"]
    return F.signum(square) * F.sqrt(F.abs(square))


def total(vectors: Column) -> Column:
    """Sum of an array of four-vectors."""
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("px", "py", "pz", "e")])
    return F.aggregate(vectors, zero, lambda a, v: F.struct(*[(a[k] + v[k]).alias(k) for k in ("px", "py", "pz", "e")]))


def particle_mass(stored: Column, ptype: str) -> Column:
    return F.coalesce(stored, F.lit(REST_MASS.get(ptype, 0.0)))


def n_bins(low: Column, high: Column, width: float, least: int = 0) -> Column:
    return F.greatest(F.ceil((high - low) / F.lit(float(width))), F.lit(least)).cast("long")


def edge(low: Column, high: Column, n: Column, i: Column) -> Column:
    """Lower edge of bin i of n even ones; edge n is `high` itself."""
    return F.when(i >= n, high).otherwise(low + i * ((high - low) / n))


def bin_index(m: Column, low: Column, high: Column, n: Column) -> Column:
    """Bin (from 0) of m among n even ones, the last closed; null without bins. The guess by division is put right by the edges."""
    guess = F.least(F.floor((m - low) / ((high - low) / n)), n - 1)
    put = F.when(m < edge(low, high, n, guess), guess - 1).when((guess < n - 1) & (m >= edge(low, high, n, guess + 1)), guess + 1).otherwise(guess)
    return F.when((n > 0) & (high > low), put).cast("long")


def fill_index(m: Column, low: Column, high: Column, n: Column) -> Column:
    """Bin (from 1) that a histogram of range [low, high) puts m in; 0 below, n + 1 at `high` and above."""
    inside = F.least(F.floor(n * (m - low) / (high - low)).cast("long"), n - 1) + 1
    return F.when(m < low, F.lit(0).cast("long")).when(m >= high, n + 1).otherwise(inside)


def safe_float(text: Column) -> Column:
    """Number of `12.5` or `100.0%`, else 0."""
    return F.coalesce(F.regexp_replace(text, "%$", "").try_cast("double"), F.lit(0.0))


def format_rate(v: Column) -> Column:
    return F.when(v >= 100, F.format_number(v, 0)).when(v >= 1, F.format_number(v, 2)).when(v > 0, F.format_number(v, 4)).otherwise("0")


def rate(n: Column, t: Column) -> Column:
    return F.when(t > 0, n / t).otherwise(0.0)


def seconds_of(line: Column, head: str) -> Column:
    """Seconds that a log line of a stage ends with, or null."""
    return F.regexp_extract(line, head + r" in ([0-9.]+)s", 1).try_cast("double")


# What the lines of the stages look like.
STAGE_LINES = {"mass_calc_time_sec": "Mass calculation complete: .*", "post_processing_time_sec": "Post-processing complete: .*", "histogram_time_sec": "Histogram creation complete"}
PI = math.pi
