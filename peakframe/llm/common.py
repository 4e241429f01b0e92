"""Helpers shared by the operators: code shipping, checkpoints, Arrow row maps."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from peakframe.sources import shared

#: Bytes of text that a row map holds in Python objects at once.
SLICE_BYTES = 4_000_000
#: Rows that go to Python in one Arrow batch, unless the application's configuration says: Spark's 10,000 texts are tens of MB in the JVM and in the worker, on the way there and back.
BATCH_ROWS, BATCH_SETTING = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch"


_kept: dict = {}


def give_back() -> None:
    """Returns memory that this process holds and does not use; others of its executor may need it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def kept(key: str, make: Callable[[], object]):
    """What make() gives, remembered by this Python process until another key is asked for: workers keep it from task to task.

    A process that goes on to something else gives the memory back first, for it shares its executor's with others.
    """
    if key not in _kept:
        if _kept:
            _kept.clear()
            give_back()
        _kept[key] = make()
    return _kept[key]


def mixed_hash(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row of unsigned columns."""
    h = np.full(len(columns[0]), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def ship(spark: SparkSession) -> None:
    """Give executors this package, and Arrow batches a size for texts, once per application."""
    shared.ship(spark)
    sc = spark.sparkContext
    if not getattr(sc, "_peakframe_batches", False):
        sc._peakframe_batches = True
        if not sc.getConf().contains(BATCH_SETTING):
            spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that driver and executors share. A local session may leave it unset and gets one of its own; on a cluster that is an error."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and drop its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Keys with at least this share, and this number, of the rows of a table are joined by broadcast: they are at most as many as the share says.
HEAVY_SHARE, HEAVY_ROWS = 1 / 5000, 200


def joined_evenly(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left joined to right (unique by `key`) where many rows of left may share a key: those of common keys meet right by broadcast, where they lie; the others are shuffled. Pass checkpointed tables."""
    least = max(HEAVY_ROWS, int(left.count() * HEAVY_SHARE))
    heavy = F.broadcast(cut(left.groupBy(key).count().filter(F.col("count") >= least).select(key)))
    common = left.join(F.broadcast(right.join(heavy, key)), key)
    return common.unionByName(left.join(heavy, key, "left_anti").join(right, key))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about `most` bytes of a text or binary column, one row at least: only a slice at a time need become Python objects."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def row_map(df: DataFrame, column: str, make: Callable[[], Callable[[list], list[list]]], fields: list[T.StructField], memo: bool = False, most: int = SLICE_BYTES) -> DataFrame:
    """df with `fields` appended, computed in each task from slices of about `most` bytes of `column`.

    `make` runs once in a task and returns a function from a list of values to one list per field.
    A column of df that has a field's name is replaced. Every row stays. Workers whose `make` keeps no memo give back the memory of one that they kept before.
    """
    ship(df.sparkSession)
    names = [f.name for f in fields]
    cols = [c for c in df.columns if c not in names]
    # the input column goes last, under a name of its own, so that it may itself be replaced
    source = df.select(*[F.col(f"`{c}`") for c in cols], F.col(f"`{column}`").alias("__in"))
    schema = T.StructType([df.schema[c] for c in cols] + fields)
    added = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not memo:
            kept("", dict)
        f = make()
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1, most):
                out = f(part.column(part.num_columns - 1).to_pylist())
                arrays = [part.column(i) for i in range(len(cols))] + [pa.array(x, type=added.field(i).type) for i, x in enumerate(out)]
                yield pa.RecordBatch.from_arrays(arrays, names=cols + names)
            batch = part = out = arrays = None
            give_back()

    return source.mapInArrow(run, schema)
