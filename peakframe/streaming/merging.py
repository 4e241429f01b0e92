"""Partial histograms of a stream of value files, merged into a stored table so that each batch counts once, however often it runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.operators import histograms as H

LEDGER = "batch long, version string, bins long, entries long"
STORED = "hist_name string, lo double, hi double, nbins long, bin long, content long"


class MergedTable:
    """Histograms kept under a folder: a version for each batch, and a ledger that says which batches are in.

    A batch is merged into the version of the batch before it and written as a version of its own, under its id; then a line of the ledger names it. A batch that failed before its line was there
    is run again: it writes its version anew from the same version before, so nothing counts twice. One whose line is there is left alone. Versions are a few thousand bins; `forget` removes those that nothing can need again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, path: str):
        """(file system, path) as Spark has them."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _there(self, path: str) -> bool:
        system, p = self._path(path)
        return system.exists(p)

    def ledger(self) -> DataFrame:
        path = f"{self.folder}/ledger"
        return self.spark.read.schema(LEDGER).json(path) if self._there(path) else self.spark.createDataFrame([], LEDGER)

    def version(self, batch: int | None) -> DataFrame:
        """The table as batch left it; None: empty."""
        return self.spark.createDataFrame([], STORED) if batch is None else self.spark.read.schema(STORED).parquet(f"{self.folder}/version={batch}")

    def forget(self) -> list[int]:
        """Removes the versions before the one that the last batch was merged into, and gives their batches. A batch that runs again needs no earlier one."""
        last, gone = self.last(), []
        for r in self.ledger().filter(F.col("batch") < (last or 0) - 1).orderBy("batch").select("batch").collect():
            system, p = self._path(f"{self.folder}/version={r['batch']}")
            if system.delete(p, True):
                gone.append(r["batch"])
        return gone

    def last(self) -> int | None:
        return self.ledger().agg(F.max("batch")).first()[0]

    def table(self) -> DataFrame:
        """The histograms of all batches whose lines are in the ledger."""
        return self.version(self.last())

    def add(self, part: DataFrame, batch: int, between: Callable[[], None] = lambda: None) -> bool:
        """Merges partial histograms as batch; False if they are in already. `between` runs when the version is written and the ledger isn't."""
        done = {r["batch"] for r in self.ledger().filter(F.col("batch") >= batch - 1).select("batch").collect()}
        if batch in done or any(b > batch for b in done):
            return False
        if batch and batch - 1 not in done:
            raise ValueError(f"batch {batch} came before batch {batch - 1} was in")
        H.merged(self.version(batch - 1 if batch else None).unionByName(part)).write.mode("overwrite").parquet(f"{self.folder}/version={batch}")
        between()
        bins, entries = self.version(batch).agg(F.count("*"), F.coalesce(F.sum("content"), F.lit(0))).first()
        line = self.spark.createDataFrame([(batch, f"version={batch}", bins, entries)], LEDGER)
        line.coalesce(1).write.mode("overwrite").json(f"{self.folder}/ledger/of={batch}")
        return True


def merge_stream(spark: SparkSession, source: str, schema: T.StructType, ranges: DataFrame, folder: str, widths=(10.0,), files_a_batch: int = 1, between: Callable[[int], None] = lambda batch: None) -> MergedTable:
    """Merges the files of values (signature, m) under `source` that are new since the last call into the histograms under `folder`, in the given ranges; ends when all are in.

    The checkpoint under the folder knows which files a batch has, the ledger which batches are merged: together they make it exactly once.
    """
    table = MergedTable(spark, f"{folder}/table")

    def merge(batch: DataFrame, number: int) -> None:
        table.add(H.filled(H.named(batch), ranges, list(widths)), number, lambda: between(number))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    running = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    try:
        running.awaitTermination()
    finally:
        running.stop()
    return table
