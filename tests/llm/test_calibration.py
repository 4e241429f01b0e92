"""Which labelled rows of op6 are counted and which fit the curve."""

from __future__ import annotations

import zlib

from peakframe.llm import toxicity


def test_only_calibration_rows_are_kept_out(spark):
    labels = spark.range(100_000).withColumnRenamed("id", "doc_id")
    held = {r["doc_id"] for r in labels.filter(toxicity.calibrating(labels, rows=2000)).collect()}
    assert 1700 < len(held) < 2300
    assert {zlib.crc32(str(i).encode()) % 5 for i in held} == set(range(5))
    few = labels.limit(400)
    assert 60 < few.filter(toxicity.calibrating(few, rows=2000)).count() < 140


def test_rows_of_all_folds_are_counted(spark, data, monkeypatch):
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "CALIBRATION_SHARE", 0.01)
    monkeypatch.setattr(toxicity, "fit", lambda labelled: seen.append(labelled) or fit(labelled))
    toxicity.op6_toxicity(spark, data)
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    labels = [r["doc_id"] for r in spark.read.parquet(f"{data}/labels.parquet").collect() if r["toxic"] is not None and fold(r["doc_id"])]
    counted = seen[0].filter("not held").count()
    assert counted > 0.9 * len(labels) and seen[0].count() == len(labels)
