"""The mass histogram as a stream: because partial histograms over fixed edges add up, it is kept by counting as files of events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakframe.functions import labels as L
from peakframe.operators import mass as M
from peakframe.operators import selection as S


def mass_histogram(events: DataFrame, combo: dict[str, tuple[int, int]], width: float, low: float, high: float, nbins: int | None = None) -> DataFrame:
    """bin (0: below, n + 1: at `high` and above) and content for the events that fit one combination exactly. Works on streams (update or complete mode) and on tables."""
    n = nbins or max(1, -int(-(high - low) // width))
    chosen = S.event_selection(S.btag_split(events))
    for t, (count, start) in combo.items():
        chosen = chosen.filter(F.size(t) == count if start == 0 else F.size(t) >= start + count)
    v = M.vectors(chosen)
    m = L.mev_to_gev(L.signed_mass(L.total(F.concat(*[F.slice(f"v_{t}", start + 1, count) for t, (count, start) in combo.items()]))))
    bins = L.fill_index(F.round(m, 6) + 0.0, F.lit(float(low)), F.lit(float(high)), F.lit(n).cast("long"))
    return v.select(bins.alias("bin")).groupBy("bin").agg(F.count("*").alias("content"))
