"""Cuts on the particles of events and on their numbers. Events stay rows; no operator here shuffles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default cuts (MeV) and numbers.
DEFAULT_CUTS = {
    "Electrons": {"pt_min": 25000, "eta_max": 2.47},
    "Muons": {"pt_min": 25000, "eta_max": 2.5},
    "Jets": {"pt_min": 30000, "eta_max": 4.5},
    "BJets": {"pt_min": 30000, "eta_max": 4.5},
    "Photons": {"pt_min": 25000, "eta_max": 2.37},
    "Taus": {"pt_min": 20000, "eta_max": 2.5},
}
DEFAULT_COUNTS = {t: (0, 4) for t in DEFAULT_CUTS}
BTAG = 0.5


def canonical_name(name: str) -> str:
    """`bjets` or `BJETS` to `BJets`; unknown names stay."""
    return {t.lower(): t for t in DEFAULT_CUTS}.get(name.lower(), name)


def normalized(cuts: dict[str, dict]) -> dict[str, dict]:
    """Cuts as ranges under canonical names: eta_max alone is symmetric, phi runs from -pi to pi unless said."""
    return {
        canonical_name(t): {
            "pt_min": float(c.get("pt_min", 0.0)), "eta_min": float(c.get("eta_min", -c.get("eta_max", math.inf))), "eta_max": float(c.get("eta_max", math.inf)),
            "phi_min": float(c.get("phi_min", -math.pi)), "phi_max": float(c.get("phi_max", math.pi)), "rel_isolation_max": c.get("rel_isolation_max"),
        }
        for t, c in cuts.items()
    }


def cuts_normalized(cuts: DataFrame) -> DataFrame:
    """The same for a table ptype, pt_min, eta_max, phi_min, phi_max with nulls for what isn't said."""
    names = F.create_map(*[F.lit(x) for t in DEFAULT_CUTS for x in (t.lower(), t)])
    return cuts.select(
        F.coalesce(F.element_at(names, F.lower("ptype")), "ptype").alias("ptype"), F.coalesce("pt_min", F.lit(0.0)).alias("pt_min"), (-F.col("eta_max")).alias("eta_min"), "eta_max",
        F.coalesce("phi_min", F.lit(-math.pi)).alias("phi_min"), F.coalesce("phi_max", F.lit(math.pi)).alias("phi_max"),
    )


def pinned(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """df with new columns that are computed once: a generator of one row keeps the optimizer from copying their expressions into every predicate and sum above."""
    if not new:
        return df
    order = [*df.columns, *[c for c in new if c not in df.columns]]
    return df.select(*[c for c in df.columns if c not in new], F.inline(F.array(F.struct(*[x.alias(c) for c, x in new.items()])))).select(*order)


def btag_split(df: DataFrame, threshold: float = BTAG, field: str = "btag") -> DataFrame:
    """Jets with a score of at least the threshold become BJets; without the field nothing changes. Null scores stay jets."""
    inner = df.schema["Jets"].dataType.elementType
    if field not in inner.names:
        return df
    tagged = lambda j: F.coalesce(j[field] >= threshold, F.lit(False))
    return pinned(df, {"BJets": F.filter("Jets", tagged), "Jets": F.filter("Jets", lambda j: ~tagged(j))})


def relative_isolation(p: Column, field: str = "iso") -> Column:
    """Isolation over momentum; 0 where the momentum is none."""
    return F.when(p["pt"] > 0, p[field] / p["pt"]).otherwise(0.0)


def inside(cut: dict, isolated: bool, fields: list[str]):
    """A predicate on particles for a normalised cut."""

    def keep(p):
        ok = (p["pt"] >= cut["pt_min"]) & p["eta"].between(cut["eta_min"], cut["eta_max"]) & p["phi"].between(cut["phi_min"], cut["phi_max"])
        if isolated and cut["rel_isolation_max"] is not None and "iso" in fields:
            ok = ok & (relative_isolation(p) < cut["rel_isolation_max"])
        return ok

    return keep


def kinematic_cuts(df: DataFrame, cuts: dict[str, dict]) -> DataFrame:
    """Keeps the particles inside their type's cuts; types without cuts, and the number of events, stay. Isolation is cut for electrons that have the field."""
    new = {t: F.filter(t, inside(c, t == "Electrons", df.schema[t].dataType.elementType.names)) for t, c in normalized(cuts).items() if t in df.columns}
    return pinned(df, new)


def uniform_cuts(df: DataFrame, cut: dict, types: list[str]) -> DataFrame:
    return kinematic_cuts(df, dict.fromkeys(types, cut))


def counts_between(df: DataFrame, counts: dict[str, tuple[int, int]]) -> DataFrame:
    """Events whose numbers of particles are all in range; types that aren't there don't count."""
    for t, (low, high) in counts.items():
        if t in df.columns:
            df = df.filter(F.size(t).between(low, high) | F.col(t).isNull())
    return df


def counts_exact(df: DataFrame, combo: dict[str, tuple[int, int]], keep: list[str]) -> DataFrame:
    """Events that a combination {type: (count, start)} fits: exactly `count` where start is 0, else at least start + count. Only the types listed stay, beside `keep`."""
    for t, (n, start) in combo.items():
        df = df.filter(F.size(t) == n if start == 0 else F.size(t) >= start + n)
    return df.select(*keep, *combo)


def counts_at_least(df: DataFrame, combo: dict[str, tuple[int, int]]) -> DataFrame:
    for t, (n, start) in combo.items():
        df = df.filter(F.size(t) >= start + n)
    return df


def rank_slice(df: DataFrame, combo: dict[str, tuple[int, int]], field: str = "pt") -> DataFrame:
    """Of each listed type the particles of ranks start to start + count - 1 by the field, greatest first."""
    order = lambda a, b: F.when(a[field] > b[field], -1).when(a[field] < b[field], 1).otherwise(0)
    return df.withColumns({t: F.slice(F.array_sort(t, order), start + 1, n) for t, (n, start) in combo.items()})


def event_selection(df: DataFrame, cuts: dict = DEFAULT_CUTS, counts: dict = DEFAULT_COUNTS) -> DataFrame:
    """Cuts, then numbers."""
    return counts_between(kinematic_cuts(df, cuts), counts)


def valid_final_state(counts: dict[str, Column], types: tuple[int, int] = (2, 4), each: tuple[int, int] = (1, 4)) -> Column:
    """Whether the number of types present, and the count of each that is, are in range."""
    present = sum((F.when(c > 0, 1).otherwise(0) for c in counts.values()), F.lit(0))
    ok = present.between(*types)
    for c in counts.values():
        ok = ok & ((c == 0) | c.between(*each))
    return ok
