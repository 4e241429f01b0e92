"""Stored chunks: what a lookup reads of them, by the scan's own metrics and the files' footers."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from peakframe.operators import chunks as C
from peakframe.sources.shared import scratch


def rows_scanned(df) -> int:
    """Rows that the scan of df's plan gave out when it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo = [plan]
    while todo:
        node = todo.pop()
        if "Scan parquet" in node.nodeName():
            return node.metrics().get("numOutputRows").get().value()
        inner = [node.executedPlan()] if node.nodeName().startswith("AdaptiveSparkPlan") else []
        children = node.children()
        todo += inner + [children.apply(i) for i in range(children.size())]
    raise AssertionError("no scan")


@pytest.fixture(scope="module")
def stored(spark):
    """3,000 signatures, every second number left out, values without order so that bounds of files overlap nothing but neighbours."""
    values = spark.range(60_000).select(F.format_string("sig_%05d", (F.col("id") % 3000) * 2).alias("signature"), (F.col("id") % 4).alias("shard"), (F.rand(3) * 100).alias("m"))
    path = scratch(spark, "stored")
    C.store(C.pack(values, ["shard", "signature"]), path, group_bytes=1 << 14, files=4)
    return path


def test_row_groups_are_small_and_have_filters(spark, stored):
    found = [pq.ParquetFile(f).metadata for f in glob.glob(f"{stored.removeprefix('file:')}/*.parquet")]
    assert len(found) == 4 and sum(m.num_row_groups for m in found) >= 30
    bounds = sorted((m.row_group(0).column(1).statistics.min, m.row_group(m.num_row_groups - 1).column(1).statistics.max) for m in found)
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:], strict=False))


def test_lookups_read_a_small_share(spark, stored):
    total = spark.read.parquet(stored).count()
    one = C.lookup(spark, stored, keys=["sig_00420"])
    assert {r["signature"] for r in one.collect()} == {"sig_00420"} and rows_scanned(one) < total / 10
    few = C.lookup(spark, stored, keys=["sig_00420", "sig_04000", "sig_05998"])
    assert len({r["signature"] for r in few.collect()}) == 3 and rows_scanned(few) < total / 5
    year = C.lookup(spark, stored, prefix="sig_01")
    assert year.select("signature").distinct().count() == 500 and rows_scanned(year) < total / 3
    assert C.lookup(spark, stored, keys=[]).count() == 0


def test_bloom_filters_rule_out_what_bounds_cannot(spark, stored):
    """Odd numbers lie between the bounds of a row group, but are nowhere."""
    absent = C.lookup(spark, stored, keys=["sig_00421", "sig_03001"])
    assert absent.collect() == [] and rows_scanned(absent) == 0
    spark.conf.set("spark.sql.parquet.filterPushdown", "false")
    try:
        again = C.lookup(spark, stored, keys=["sig_00421"])
        assert rows_scanned(again) == spark.read.parquet(stored).count()
    finally:
        spark.conf.unset("spark.sql.parquet.filterPushdown")
