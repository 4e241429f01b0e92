"""Streams give what tables give, also where a batch fails and runs again."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from peakframe.operators import histograms as H
from peakframe.operators.capped import capped
from peakframe.sources import fixtures as X
from peakframe.sources.shared import scratch, written
from peakframe.streaming.chunking import capped_stream, write_in_order
from peakframe.streaming.histogram import mass_histogram
from peakframe.streaming.merging import MergedTable, merge_stream

PAIR = {"Electrons": (1, 0), "Muons": (1, 0)}


def test_stream_like_table(spark, data, tmp_path):
    events = X.events(spark, data).selectExpr("*", "CAST(array() AS array<struct<pt: double, eta: double, phi: double, mass: double, btag: double, iso: double>>) AS BJets")
    events.repartition(6).write.parquet(str(tmp_path / "in"))
    want = {r["bin"]: r["content"] for r in mass_histogram(spark.read.parquet(str(tmp_path / "in")), PAIR, 10, 0, 200).collect()}
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    q = mass_histogram(stream, PAIR, 10, 0, 200).writeStream.outputMode("complete").format("memory").queryName("hist").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {r["bin"]: r["content"] for r in spark.sql("SELECT * FROM hist").collect()} == want and len(want) > 5


def parts(spark, n=6):
    """Values in n files, written one by one, and their ranges."""
    values = spark.range(600).selectExpr("concat('parsed_2001_chunk', id % 3, '_FS_1e_1m_0j_0g_0t_0b_IM_', if(id % 2 = 0, 'e0m0', 'm0'), '_main') AS signature", "CAST(pow(id % 97, 1.3) AS double) AS m")
    folder = scratch(spark, "values")
    for k in range(n):
        values.filter(F.col("m") * 7 % n >= k).filter(F.col("m") * 7 % n < k + 1).coalesce(1).write.mode("append").parquet(folder)
    back = spark.read.parquet(folder)
    return folder, back, written(H.global_ranges(H.named(back)))


def held(df):
    return sorted(tuple(r) for r in df.select("hist_name", "lo", "hi", "nbins", "bin", "content").collect())


class Halt(Exception):
    pass


@pytest.mark.parametrize("fails", [0, 2, 5])
def test_batch_that_fails_half_way_counts_once(spark, fails):
    """The batch fails when its version is written and the ledger does not name it yet; a new start runs it again."""
    folder, values, ranges = parts(spark)
    target, seen = scratch(spark, "merged"), []

    def between(batch):
        seen.append(batch)
        if batch == fails and seen.count(batch) == 1:
            raise Halt

    with pytest.raises(Exception, match="Halt"):
        merge_stream(spark, folder, values.schema, ranges, target, between=between)
    half = MergedTable(spark, f"{target}/table")
    assert half.last() == (fails - 1 if fails else None) and sum(r[-1] for r in held(half.table())) < values.count()
    table = merge_stream(spark, folder, values.schema, ranges, target, between=between)
    assert seen == [*range(fails + 1), *range(fails, 6)] and table.last() == 5
    assert table.forget() == [0, 1, 2, 3] and table.forget() == []
    assert held(table.table()) == held(H.filled(H.named(values), ranges, [10.0]))
    assert [r["entries"] for r in table.ledger().orderBy("batch").collect()][-1] == values.count()


def test_batch_that_is_in_is_left_alone(spark):
    folder, values, ranges = parts(spark, 2)
    part = written(H.filled(H.named(values), ranges, [10.0]))
    table = MergedTable(spark, scratch(spark, "merged"))
    assert table.last() is None and held(table.table()) == []
    assert table.add(part, 0) and not table.add(part, 0) and table.add(part.limit(0), 1) and not table.add(part, 0)
    assert held(table.table()) == held(part)
    with pytest.raises(ValueError, match="batch 4"):
        table.add(part, 4)


def test_later_files_are_merged_into_what_is_there(spark):
    folder, values, ranges = parts(spark, 2)
    target = scratch(spark, "merged")
    merge_stream(spark, folder, values.schema, ranges, target, files_a_batch=5)
    values.limit(50).write.mode("append").parquet(folder)
    table = merge_stream(spark, folder, values.schema, ranges, target, files_a_batch=5)
    assert table.forget() == []
    assert table.last() == 1 and held(table.table()) == held(H.filled(H.named(spark.read.parquet(folder)), ranges, [10.0]))


def test_stream_of_chunks_goes_on_where_it_stopped(spark):
    """Open chunks outlive the query: files that come later go on filling them, as one run over all does."""
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([0, 1, 4, 7, 12, None])) for i in range(90)]
    df, folder = spark.createDataFrame(rows, "release string, file long, bytes long"), scratch(spark, "stream")

    def run():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/source/*/*")
        capped_stream(stream, "release", "file", "bytes", 10).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()

    write_in_order(df.filter("file < 50"), ["file"], f"{folder}/source/1")
    run()
    assert spark.read.parquet(f"{folder}/out").count() == 50
    write_in_order(df.filter("file >= 50"), ["file"], f"{folder}/source/2", parts=2)
    run()
    got = {r["file"]: (r["release"], r["chunk"]) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {r["file"]: (r["release"], r["chunk"]) for r in capped(df, ["release"], ["file"], "bytes", 10).collect()}
