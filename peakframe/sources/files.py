"""Event files opened by executors, one by one: what cannot be read is a row that says so, not an error of the job.

Files are opened where they lie (file, hdfs, s3, gs and what else Arrow knows), by their footers, and only the columns and row groups asked for are fetched. For stores that only Spark reads,
tables of path and content as Spark's binaryFile source gives them do as well.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from peakframe.sources.shared import ship, written

#: How Parquet files begin and end.
MAGIC = b"PAR1"
#: Kinds of failure, the earliest first: no such file; no access; no bytes; another format; the end is missing; a footer that can't be read; a column that is missing; data that can't be read.
FAILURES = ["absent", "unreadable", "empty", "format", "truncated", "footer", "schema", "data"]
#: Rows that are decoded at once.
ROWS = 8192
#: Files that a task opens, about, and most tasks: the driver holds something of each task of a stage.
FILES_A_TASK, TASKS = 16, 2_000


class Failure(Exception):
    def __init__(self, kind: str, message: object):
        super().__init__(str(message)[:300])
        self.kind = kind


def located(path: str):
    """(file system, path in it) of a URI as Spark writes it, or of a local path."""
    from pyarrow import fs

    if path.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def opened(path: str, content: bytes | None = None):
    """(Parquet file, its bytes), or a Failure that says how far it could be read."""
    import pyarrow.parquet as pq

    try:
        if content is not None:
            source = pa.BufferReader(content)
        else:
            system, inside = located(path)
            source = system.open_input_file(inside)
        size = source.size()
        if not size:
            raise Failure("empty", "no bytes")
        head = source.read_at(4, 0)
        if head != MAGIC[: len(head)]:
            raise Failure("format", f"begins with {head!r}")
        tail = source.read_at(min(size, 8), max(0, size - 8))
        if size < 12 or tail[-4:] != MAGIC:
            raise Failure("truncated", f"{size} bytes without an end")
    except FileNotFoundError as e:
        raise Failure("absent", e) from e
    except (OSError, pa.ArrowException) as e:
        raise Failure("unreadable", e) from e
    try:
        return pq.ParquetFile(source), size
    except (OSError, pa.ArrowException, ValueError) as e:
        raise Failure("footer", e) from e


OUTCOME = T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType()), T.StructField("message", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("groups", T.IntegerType()), T.StructField("failed_groups", T.IntegerType()), T.StructField("bytes", T.LongType()), T.StructField("seconds", T.DoubleType())])


def dealt(files: DataFrame, column: str = "file") -> DataFrame:
    """A table with a row for each file, dealt out by number of files: as bytes its rows are few, and Spark would give them all to one task."""
    n = max(files.sparkSession.sparkContext.defaultParallelism, min(TASKS, -(-files.count() // FILES_A_TASK)))
    return files.repartition(n, column)


def read_files(files: DataFrame, schema: T.StructType, path: str = "path", content: str | None = None) -> DataFrame:
    """file, row, outcome: a row for each row of each Parquet file that `path` names, in the columns of `schema` (cast to its types), and behind them one with the file's outcome.

    outcome: ok; else error, one of FAILURES, and message; how many rows came, row groups there are, and row groups that could not be read; the file's size and the time it took. As each group stands for itself, the rows of the others
    are kept. A null path is absent; a file named twice is read twice. One row group is held at a time, in pieces of ROWS rows.
    """
    ship(files.sparkSession)
    names, kinds = schema.names, to_arrow_schema(schema)
    row_kind = pa.struct(list(kinds))
    outcome_kind = pa.struct(list(to_arrow_schema(OUTCOME)))

    def said(name: str | None, began: float, error: str | None, message: str | None, rows: int = 0, groups: int = 0, failed: int = 0, size: int | None = None) -> pa.RecordBatch:
        outcome = {"ok": error is None, "error": error, "message": message, "rows": rows, "groups": groups, "failed_groups": failed, "bytes": size, "seconds": time.monotonic() - began}
        return pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.nulls(1, row_kind), pa.array([outcome], outcome_kind)], names=["file", "row", "outcome"])

    def one(name: str | None, content: bytes | None) -> Iterator[pa.RecordBatch]:
        began = time.monotonic()
        try:
            if name is None:
                raise Failure("absent", "no path")
            file, size = opened(name, content)
            if missing := [c for c in names if c not in file.schema_arrow.names]:
                raise Failure("schema", f"no column {', '.join(missing)}")
        except Failure as e:
            yield said(name, began, e.kind, str(e))
            return
        rows = failed = 0
        error = message = None
        groups = file.metadata.num_row_groups
        for g in range(groups):
            try:  # a group is read before any of it is passed on, so that it comes whole or not at all
                parts = list(file.iter_batches(ROWS, row_groups=[g], columns=names)) if names else []
                made = []
                for part in parts:
                    columns = [pc.cast(part.column(part.schema.get_field_index(c)), kinds.field(c).type) for c in names]
                    made.append(pa.StructArray.from_arrays(columns, fields=list(kinds)))
            except (OSError, pa.ArrowException, ValueError, UnicodeDecodeError) as e:
                failed, error, message = failed + 1, error or "data", message or str(e)[:300]
                continue
            for x in made:
                rows += len(x)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(x), pa.string()), x, pa.nulls(len(x), outcome_kind)], names=["file", "row", "outcome"])
        yield said(name, began, error, message, rows, groups, failed, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from one(name, data.as_py())

    out = T.StructType([T.StructField("file", T.StringType()), T.StructField("row", schema), T.StructField("outcome", OUTCOME)])
    listed = files.select(F.col(f"`{path}`").alias("file"), (F.col(f"`{content}`") if content else F.lit(None).cast("binary")).alias("content"))
    return (listed if content else dealt(listed)).mapInArrow(run, out)


def rows_of(read: DataFrame) -> DataFrame:
    """The rows of read_files with their file."""
    return read.filter("outcome IS NULL").select("file", "row.*")


def outcomes_of(read: DataFrame) -> DataFrame:
    """What became of each file of read_files."""
    return read.filter("outcome IS NOT NULL").select("file", "outcome.*")


def first_rows(file, columns: list[str]) -> None:
    """Reads one row of some columns, or raises what reading them raises."""
    for _ in file.iter_batches(1, row_groups=[0], columns=columns):
        return


def readable(file, columns: list[str]) -> tuple[list[str], int]:
    """Those of the columns whose first row can be read, and how many trial reads that took: all at once; where that fails, each half by itself."""
    if not columns or not file.metadata.num_row_groups:
        return columns, 0
    try:
        first_rows(file, columns)
        return columns, 1
    except (OSError, pa.ArrowException, ValueError, UnicodeDecodeError):
        if len(columns) == 1:
            return [], 1
    half = len(columns) // 2
    (a, n), (b, m) = readable(file, columns[:half]), readable(file, columns[half:])
    return a + b, 1 + n + m


def readable_columns(wanted: DataFrame, path: str = "path", column: str = "column_name", content: str | None = None) -> DataFrame:
    """path, column for each column of `wanted` that its file has and whose first row can be read, found by trial reads on executors; and `trials`, how many its file took.

    A file that can't be opened has no readable column. Repeated rows count once; a file has a bounded number of columns. With k bad columns of n, about k * log n reads are made, not n.
    """
    ship(wanted.sparkSession)
    held = [F.first(F.col(f"`{content}`")).alias("__content")] if content else []
    asked = wanted.groupBy(F.col(f"`{path}`").alias("file")).agg(F.sort_array(F.collect_set(F.col(f"`{column}`"))).alias("columns"), *held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                name, columns = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                try:
                    if name is None:
                        continue
                    file, _ = opened(name, batch.column(2)[row].as_py() if content else None)
                    there = [f.path for f in map(file.schema.column, range(len(file.schema)))]
                    top = {p.split(".list.")[0] for p in there} | {f.name for f in file.schema_arrow}
                    good, trials = readable(file, [c for c in columns if c in top])
                except Failure:
                    continue
                out += [(name, c, trials) for c in good]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[], [], []], (pa.string(), pa.string(), pa.int32()), strict=True)], names=["file", "column", "trials"])

    return (asked if content else dealt(written(asked))).mapInArrow(run, "file string, column string, trials int").select(F.col("file").alias(path), F.col("column").alias(column), "trials")


def read_metrics() -> list:
    """Aggregates over read_files: files, how many were read and failed, rows, megabytes, seconds; for an observation on the way, or for agg()."""
    n, ok = F.count("outcome"), F.count_if("outcome.ok")
    return [n.alias("total_files"), ok.alias("successful_files"), F.count_if(~F.col("outcome.ok")).alias("failed_files"), F.count("row").alias("total_events"), (F.coalesce(F.sum("outcome.bytes"), F.lit(0)) / (1024 * 1024)).alias("total_size_mb"), F.coalesce(F.avg("outcome.seconds"), F.lit(0.0)).alias("average_time_sec")]
