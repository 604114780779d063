"""Positions in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.session import materialize


def numbered(df: DataFrame, order: Column, name: str) -> DataFrame:
    """`df` with its 0-based position `name` in `order`, which must be total.

    Rows are sorted by ranges; a range's first position is the number of rows in
    the ranges before it, so that only one row per range meets in one place.
    """
    parts = materialize(
        df.repartitionByRange(order).sortWithinPartitions(order).withColumn(
            "_part", F.spark_partition_id()
        ),
        "ranks",
    )
    within = Window.partitionBy("_part").orderBy(order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    position = F.col("_start") + F.row_number().over(within) - 1
    return parts.join(F.broadcast(starts), "_part").withColumn(name, position).drop(
        "_part", "_start"
    )
