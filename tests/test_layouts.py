"""Layouts are resolved file by file: no table of files is broadcast, and the fields of odd inventories are those of the joins before."""

from __future__ import annotations

import pytest

from peakframe.plans import layout_queries as Q
from peakframe.sources import fixtures as X
from peakframe.sources import layouts as Y


def plan(df) -> str:
    df.collect()  # the plan that ran
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["src_schema_project", "required_fields_subset", "src_infer_schema", "src_cms_paths", "object_types"])
def test_files_are_neither_broadcast_nor_shuffled_twice(spark, data, name):
    """What is broadcast are the parameters alone; files are shuffled as rows of customers, before their columns are listed."""
    ran = plan(getattr(Q, name)(spark, data)).split("Initial Plan")[0]
    assert "SortMergeJoin" not in ran and "ShuffledHashJoin" not in ran
    exchanges = [x for x in ran.splitlines() if "hashpartitioning(file" in x]
    assert exchanges and all("REPARTITION_BY_NUM" in x for x in exchanges)
    assert ran.count("BroadcastExchange") <= (1 if name in ("src_schema_project", "required_fields_subset", "src_cms_paths") else 0)


def test_inventory_is_dealt_by_files(spark, data, monkeypatch):
    monkeypatch.setattr(X, "INVENTORY_FILES", 10)
    df = X.columns(spark, data)
    assert df.rdd.getNumPartitions() == 15 and df.select("file").distinct().count() == 150


def test_odd_inventories(spark):
    """A file of two releases, one that is unknown, nulls, a fallback, a collection that lacks a field, and columns listed twice."""
    dot = lambda o, *fs: [f"Analysis{o}AuxDyn.{f}" for f in fs]
    rows = [("a", "2024r-pp_mc", c) for c in [*dot("Muons", "pt", "eta", "phi", "m"), *dot("Jets", "pt", "eta")] * 2]
    rows += [("a", "2024r-hi", c) for c in ("Muons" + "AuxDyn." + f for f in ("pt", "eta"))] + [("a", "2024r-hi", "MuonsAuxDyn.phi"), ("a", None, None)]
    rows += [("b", "unknown", "Muon_pt"), (None, "record_30529", "Muon_pt"), (None, "record_30529", "Muon_eta"), (None, "record_30529", "Muon_phi"), ("c", "record_30529", None)]
    df = spark.createDataFrame(rows, "file string, release string, column_name string")
    got = sorted(tuple(r) for r in Y.projected(df).collect())
    assert got == sorted([("a", "Muons", f, f"AnalysisMuonsAuxDyn.{c}") for f, c in zip(["pt", "eta", "phi", "mass"], ["pt", "eta", "phi", "m"], strict=True)] + [("a", "Muons", f, f"MuonsAuxDyn.{f}") for f in ("pt", "eta", "phi")])
    rows = [("n", c) for c in ("patMuons_a__PAT.obj.fPt", "patMuons_a__PAT.obj.fEta", "patMuonsPuppi__PAT.obj.fPhi", "patJets_0__PAT.none", "patJets_1__PAT.fPt", "Jet_pt")] + [("e", None), (None, "Jet_pt"), ("f", "Jet_pt"), ("f", "Jet_pt"), ("f", "lep_eta_x")]
    got = sorted(tuple(r) for r in Y.inferred(spark.createDataFrame(rows, "file string, column_name string")).collect())
    assert got == [("f", "flat", "", "", "Electrons", "lep", "eta"), ("f", "flat", "", "", "Jets", "Jet", "pt"), ("f", "flat", "", "", "Muons", "lep", "eta"), ("n", "dotted", "pat", "__PAT.", "Muons", "Muons_a", "pt,eta")]
