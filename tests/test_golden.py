"""Worked examples."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakframe.functions import labels as L
from peakframe.operators import histograms as H
from peakframe.operators import mass as M
from peakframe.operators import selection as S
from peakframe.operators import spectra as P
from peakframe.sources import catalog as C
from peakframe.sources import layouts as Y

TYPES = L.FS_ORDER


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("combo", "label"), [({"Electrons": (1, 0), "Jets": (1, 0)}, "e0j0"), ({"Electrons": (2, 0), "Jets": (1, 0)}, "e0e1j0"), ({"Electrons": (1, 1), "Jets": (1, 0)}, "e1j0"), ({"Electrons": (2, 1), "Jets": (1, 0)}, "e1e2j0")])
def test_im_label(spark, combo, label):
    n = {t: F.lit(combo.get(t, (0, 0))[0]) for t in TYPES}
    s = {t: F.lit(combo.get(t, (0, 0))[1]) for t in TYPES}
    assert one(spark, L.im_label(n, s)) == label


def test_hist_name(spark):
    name = L.hist_name(F.lit("2e_0m_3j_0g"), F.lit("e0e1j0"))
    assert one(spark, name) == "mass_e0e1j0_cat_2ex_0mx_3jx_0gx"
    assert one(spark, L.roi_name(L.hist_name(F.lit("1e_0m_1j_0g"), F.lit("e0j0")), 10)) == "ROI_mass_e0j0_cat_1ex_0mx_1jx_0gx_width_10.0"


def test_combinations(spark):
    four = ["Electrons", "Muons", "Jets", "Photons"]
    assert M.combinations(spark, four).count() == 65
    assert M.combinations(spark, four, subleading=1).count() == 186
    assert M.combinations(spark, four, limit=7).count() == 7


@pytest.mark.parametrize(("url", "kind"), [("root://s/mc20_13TeV/x", "mc"), ("root://s/data16_13TeV/x", "data"), ("root://s/DATA15_a/x", "data"), ("root://opendata/x", None), ("root://s/mc20_a/data16_b/x", None)])
def test_url_kind(spark, url, kind):
    assert one(spark, C.kind(F.lit(url))) == kind


def test_unclassified_urls_stop(spark):
    with pytest.raises(ValueError, match="neither"):
        C.checked(spark.createDataFrame([("2016", 1, "root://opendata/x")], "release string, pos long, url string"))


def test_batches(spark):
    place = spark.range(10)
    got = place.groupBy(C.batch_of(F.col("id"), F.lit(10), 4).alias("b")).count().orderBy("b").collect()
    assert [r["count"] for r in got] == [2, 2, 2, 4]
    assert {r["b"] for r in spark.range(3).select(C.batch_of(F.col("id"), F.lit(3), 4).alias("b")).collect()} == {3}


def test_release_names(spark):
    assert one(spark, Y.schema_name(F.lit("2024r-pp_mc"))) == "2024r-pp"
    assert one(spark, Y.schema_name(F.lit("record_30529"))) == "cms-nanoaod"
    assert one(spark, Y.schema_name(F.lit("record_1"))) is None


def events(spark, **types):
    row = {"event_id": 1, "source_file": "f"} | {t: [dict(zip(("pt", "eta", "phi", "mass", "btag", "iso"), (*map(float, p), 0.0, 0.0, 0.0), strict=False)) for p in types.get(t, [])] for t in TYPES}
    body = "array<struct<pt double, eta double, phi double, mass double, btag double, iso double>>"
    return spark.createDataFrame([row], "event_id long, source_file string, " + ", ".join(f"{t} {body}" for t in TYPES))


def test_back_to_back_pair(spark):
    v = M.vectors(events(spark, Photons=[(50.0, 0.0, 0.0), (50.0, 0.0, math.pi)]))
    assert v.select(L.signed_mass(L.total(F.col("v_Photons"))).alias("m")).first()["m"] == pytest.approx(100)


def test_rank_slice(spark):
    df = S.rank_slice(events(spark, Electrons=[(10.0, 0, 0), (30.0, 0, 0), (20.0, 0, 0)], Jets=[(1.0, 0, 0), (5.0, 0, 0)]), {"Electrons": (1, 1), "Jets": (1, 0)}).first()
    assert [p["pt"] for p in df["Electrons"]] == [20] and [p["pt"] for p in df["Jets"]] == [5]


def test_missing_types_and_fields(spark):
    df = events(spark, Jets=[(50000.0, 0, 0)]).drop("Taus")
    assert S.kinematic_cuts(df, S.DEFAULT_CUTS).count() == 1
    assert S.btag_split(df.withColumn("Jets", F.transform("Jets", lambda p: F.struct(p["pt"].alias("pt"))))).columns == df.columns


def numpy_cleaned(x, w):
    """Peak cut and tail split as histograms of numpy give them."""
    def edges(a):
        n = math.ceil((a.max() - a.min()) / w)
        return np.linspace(a.min(), a.max(), n + 1) if n else None

    if (e := edges(x)) is not None:
        c = np.histogram(x, e)[0]
        x = x[x >= e[np.flatnonzero(c == c.max())[-1]]]
    if (e := edges(x)) is None:
        return x, x[:0]
    empty = np.flatnonzero(np.histogram(x, e)[0] == 0)
    if not len(empty) or empty[0] <= 1:
        return x, x[:0]
    return x[x < e[empty[0]]], x[x >= e[empty[0]]]


@pytest.mark.parametrize("seed", range(4))
def test_cleaning_like_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {f"k{i}": np.round(rng.gamma(2, 30, rng.integers(1, 60)), 3) for i in range(20)} | {"one": np.array([5.0]), "same": np.array([7.0, 7.0])}
    df = spark.createDataFrame([(k, "i", float(m)) for k, x in groups.items() for m in x], "fs string, im string, m double")
    got = {}
    for r in P.post_process(df).collect():
        got.setdefault((r["fs"], r["part"]), []).append(r["m"])
    for k, x in groups.items():
        main, out = numpy_cleaned(x, 10.0)
        assert sorted(got.get((k, "main"), [])) == sorted(main) and sorted(got.get((k, "outliers"), [])) == sorted(out)


def test_greatest_value_overflows(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 5.0), ("a", 20.0)], "name string, m double")
    got = {r["bin"]: r["content"] for r in H.filled(df, H.global_ranges(df), [10.0]).collect()}
    assert got == {1: 2, 3: 1}


def test_rebinning_keeps_contents(spark):
    h = spark.createDataFrame([("h", 0.0, 30.0, 3, b, c) for b, c in ((0, 9), (1, 6), (2, 3), (3, 12), (4, 5))], "hist_name string, lo double, hi double, nbins long, bin long, content long")
    got = {r["bin"]: r["content"] for r in H.rebinned(h, 20.0).collect()}
    assert got == {0: 9.0, 1: 12.0}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "fs string, im string, m double")
    assert P.post_process(df).count() == 0
    assert H.created(spark.createDataFrame([], "signature string, m double")).count() == 0
