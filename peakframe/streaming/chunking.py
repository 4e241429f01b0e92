"""Chunks of limited size over a stream of files: the bytes and the number of each release's open chunk are state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from peakframe.sources.shared import ship, written


def capped_stream(files: DataFrame, key: str, order: str, size: str, most: int) -> DataFrame:
    """key, order and size of each file of a stream with the number (from 0) of its chunk, as `capped` numbers them if files come in order: within a batch they are put in order, over batches as they arrive.

    A chunk takes files as long as their sizes sum to `most` or less; its first file always fits. State is two numbers for each key, whatever has passed; null sizes count as 0. The files of one
    key in one batch are handled in one task, in pieces as they come, so a batch should be bounded (maxFilesPerTrigger).
    """
    ship(files.sparkSession)
    out = T.StructType([files.schema[key], files.schema[order], T.StructField(size, T.LongType()), T.StructField("chunk", T.LongType())])

    def run(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, chunk = state.get if state.exists else (-1, -1)
        batch = pd.concat([p[[order, size]] for p in parts], ignore_index=True).sort_values(order, kind="stable", ignore_index=True)
        sizes, chunks = batch[size].fillna(0).astype("int64"), []
        for n in sizes.tolist():
            if held < 0 or held + n > most:
                held, chunk = 0, chunk + 1
            held += n
            chunks.append(chunk)
        state.update((held, chunk))
        yield pd.DataFrame({key: [k[0]] * len(batch), order: batch[order], size: sizes, "chunk": chunks})

    return files.select(key, order, size).groupBy(key).applyInPandasWithState(run, out, "held long, chunk long", "append", GroupStateTimeout.NoTimeout)


def write_in_order(files: DataFrame, order: list[str], folder: str, parts: int = 4) -> None:
    """Writes files in `parts` ranges of the order, one behind the other, so that a stream that takes one written file at a time, the oldest first, has them in order."""
    ranged = files.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id())
    held = written(ranged)
    for (k,) in held.select("__range").distinct().orderBy("__range").collect():
        held.filter(F.col("__range") == k).drop("__range").coalesce(1).sortWithinPartitions(*order).write.parquet(f"{folder}/range={k:05d}")
