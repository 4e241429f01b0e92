"""What grows with the input stays spread: events are read once, shards are written by many tasks, files are dealt to a bounded number of tasks."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest

from peakframe.operators import mass as M
from peakframe.plans import event_queries as Q
from peakframe.plans import histogram_queries as HQ
from peakframe.sources import files as Z


@pytest.mark.parametrize("scope", ["global", "file"])
def test_masses_read_events_once(spark, data, scope):
    """A row of events is cut and labelled once; the result is that of channels looked up first, also where combinations are listed twice."""
    events = Q.cut_events(spark, data)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    combos = M.written(M.combinations(spark, Q.TYPES, types_range=(2, 4), subleading=1).drop("seq"))
    got = M.mass_spectrum(events.mapInArrow(counted, events.schema), combos.union(combos.filter("im = 'e0m0'")), scope=scope)
    rows = sorted((r["fs"], r["im"], r["source_file"], r["event_id"]) for r in got.collect())
    assert seen.value == events.count() and all(r["m"] is not None for r in got.collect())
    base = M.labelled(events).select("event_id", "source_file", "fs", *[f"c_{t}" for t in Q.TYPES])
    keys = ["fs"] if scope == "global" else ["source_file", "fs"]
    pairs = M.channels(base, combos, scope=scope)
    want = base.join(pairs.union(pairs.filter("im = 'e0m0'")), [*keys, *[f"c_{t}" for t in Q.TYPES]])
    want = sorted((r["fs"], r["im"], r["source_file"], r["event_id"]) for r in want.collect())
    assert rows == want and len(rows) > 20


def test_shards_are_written_by_many_tasks(spark, data, tmp_path, monkeypatch):
    """A shard's values aren't brought to one task: with lines in several row groups it has several files. Batches are as many as shards."""
    pq.write_table(pq.read_table(f"{data}/lineitem.parquet"), str(tmp_path / "lineitem.parquet"), row_group_size=1000)
    monkeypatch.setattr(HQ, "merge_stream", lambda spark, source, *a, merge=HQ.merge_stream, **b: (found.append((source, merge(spark, source, *a, **b))), found[0][1])[1])
    found, size = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        entries = HQ.hist_merge_stream(spark, str(tmp_path)).selectExpr("sum(content)").first()[0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    source, table = found[0]
    assert len(glob.glob(source.removeprefix("file:") + "/*.parquet")) > 8 and table.last() == 3
    assert entries == spark.read.parquet(f"{data}/lineitem.parquet").count()


def test_many_files_go_to_a_bounded_number_of_tasks(spark):
    assert Z.dealt(spark.range(100_000).selectExpr("concat('f', id) AS file")).rdd.getNumPartitions() == 2000
    assert Z.dealt(spark.range(160).selectExpr("concat('f', id) AS file")).rdd.getNumPartitions() == 10
