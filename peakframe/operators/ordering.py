"""Positions in a global order without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakframe.sources.shared import written


def placed(df: DataFrame, order: list[str], out: str = "place") -> DataFrame:
    """df with each row's position from 0 in the order of the columns: rows are dealt in ranges, and only the ranges' sizes are summed in one place.

    Rows that agree in the order columns are in no particular order among each other.
    """
    ranged = written(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()))  # the ranges must be the same for both readers
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("__k"))  # a row for each range
    before = sizes.withColumn("__before", F.coalesce(F.sum("__k").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__k")
    inside = F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1
    return ranged.withColumn("__i", inside).join(F.broadcast(before), "__p").withColumn(out, F.col("__before") + F.col("__i")).drop("__p", "__i", "__before")
