"""Files that can't be read: each kind of failure is a row, damaged row groups cost their own rows only, trial reads find the readable columns."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from peakframe.sources import files as Z
from peakframe.sources import fixtures as X

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])


def whole(path, rows=100, group=10):
    pq.write_table(pa.table({"k": pa.array(range(rows), pa.int32()), "s": [f"s{i}" for i in range(rows)], "other": [1.0] * rows}), path, row_group_size=group)
    return path


def damage_group(path, group, column):
    c = pq.ParquetFile(path).metadata.row_group(group).column(column)
    at = min(x for x in (c.dictionary_page_offset, c.data_page_offset) if x)
    with open(path, "r+b") as f:
        f.seek(at)
        f.write(b"\xff" * c.total_compressed_size)


@pytest.fixture
def folder(tmp_path):
    p = lambda name: str(tmp_path / name)
    whole(p("good part=1.parquet"))
    data = open(whole(p("half.parquet")), "rb").read()
    open(p("half.parquet"), "wb").write(data[: len(data) // 2])
    open(p("empty.parquet"), "wb").close()
    open(p("text.parquet"), "w").write("not of this format at all")
    footer = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
    open(p("footer.parquet"), "wb").write(data[:footer] + b"\xff" * 8 + data[footer + 8 :])
    open(p("long.parquet"), "wb").write(data[:-8] + b"\xff\xff\xff\x7fPAR1")
    damage_group(whole(p("group.parquet")), 3, 1)
    pq.write_table(pa.table({"k": [1]}), p("column.parquet"))
    pq.write_table(pa.table({"k": ["x"], "s": ["y"]}), p("cast.parquet"))
    pq.write_table(pa.table({"k": pa.array([], pa.int64()), "s": pa.array([], pa.string())}), p("none.parquet"))
    return tmp_path


WANT = {"good part=1.parquet": (True, None, 100), "half.parquet": (False, "truncated", 0), "empty.parquet": (False, "empty", 0), "text.parquet": (False, "format", 0), "footer.parquet": (False, "footer", 0), "long.parquet": (False, "footer", 0), "group.parquet": (False, "data", 90), "column.parquet": (False, "schema", 0), "cast.parquet": (False, "data", 0), "none.parquet": (True, None, 0), "gone.parquet": (False, "absent", 0)}


@pytest.mark.parametrize("form", ["", "file:", "file://"])
def test_every_failure_is_a_row(spark, folder, form):
    files = spark.createDataFrame([(f"{form}{folder}/{n}",) for n in WANT] + [(None,)], "path string")
    read = Z.read_files(files, SCHEMA)
    got = {os.path.basename(r["file"]): (r["ok"], r["error"], r["rows"]) for r in Z.outcomes_of(read).collect() if r["file"]}
    assert got == WANT
    assert [(r["error"], r["rows"]) for r in Z.outcomes_of(read).filter("file IS NULL").collect()] == [("absent", 0)]
    seen = read.agg(*Z.read_metrics()).first()
    assert (seen["total_files"], seen["successful_files"], seen["failed_files"], seen["total_events"]) == (12, 2, 10, 190) and seen["total_size_mb"] > 0 and seen["average_time_sec"] > 0
    rows = Z.rows_of(read).collect()
    assert {x: sum(os.path.basename(r["file"]) == x for r in rows) for x in WANT} == {x: n for x, (_, _, n) in WANT.items()}
    assert {r["k"] for r in rows if "group" in r["file"]} == set(range(100)) - set(range(30, 40)) and all(r["s"] == f"s{r['k']}" for r in rows)


def test_contents_instead_of_paths(spark, folder):
    files = spark.read.format("binaryFile").load(str(folder)).select("path", "content")
    got = {os.path.basename(r["file"]).replace("%20", " "): (r["ok"], r["error"], r["rows"]) for r in Z.outcomes_of(Z.read_files(files, SCHEMA, content="content")).collect()}
    assert got == {k: v for k, v in WANT.items() if v[1] not in ("absent", "empty")}  # Spark lists no empty files


@pytest.mark.parametrize("bad", [[], [0], [31], [3, 4], [0, 15, 31], list(range(32))])
def test_trial_reads_bisect(tmp_path, bad, spark):
    names = [f"c{i:02d}.x" if i % 2 else f"c{i:02d}" for i in range(32)]
    data = X.spoilt(pa.table({c: [[1.0, 2.0], [3.0]] if i % 3 else [1.0, 2.0] for i, c in enumerate(names)}), [names[i] for i in bad])
    path = str(tmp_path / "f.parquet")
    open(path, "wb").write(data)
    want = spark.createDataFrame([(path, c) for c in [*names, "nowhere"]] + [(str(tmp_path / "gone"), "c00"), (None, "c00")], "path string, column_name string")
    rows = Z.readable_columns(want).collect()
    assert sorted(r["column_name"] for r in rows) == [c for i, c in enumerate(names) if i not in bad]
    if 0 < len(bad) < 32:
        assert {r["trials"] for r in rows} == {rows[0]["trials"]} and rows[0]["trials"] <= 1 + 10 * len(bad)
    assert Z.readable_columns(want.limit(0)).count() == 0
