"""What driver and executors share: the package itself, and a folder for tables that are read more than once."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that is broadcast; beyond it a join shuffles.
BROADCAST_ROWS = 100_000


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once per application. What runs Python on them calls it."""
    sc = spark.sparkContext
    if getattr(sc, "_peakframe_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="spark-")), "peakframe_src.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)
    sc._peakframe_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. A local session, where all share one machine, may leave it unset and gets a folder of its own; on a cluster that is an error."""
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


def written(df: DataFrame) -> DataFrame:
    """df materialised in the shared folder, so that what reads it twice doesn't compute it twice."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder as Parquet: for large tables, of which readers need some columns each."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def looked_up(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, a row for each key, written for joins with a large table: broadcast if it has at most `most` rows, so that the large one is neither shuffled nor sorted."""
    table = written(df)
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table
