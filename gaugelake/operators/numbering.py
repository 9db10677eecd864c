"""Positions in a global order without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.session import ensure_checkpoint_dir


def with_position(df: DataFrame, keys: list[str], name: str = "position") -> DataFrame:
    """Number the rows from 0 in the order of ``keys``, which must be unique.

    Ranges of keys are numbered side by side, each starting at the number of rows in the ranges
    before it. The ranges are checkpointed, as both the counts and the rows must see the same ones.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranges = (
        df.repartitionByRange(*keys)
        .withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )
    # one row per range; there are as many as shuffle partitions, whatever the data size
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy(*keys)
    return (
        ranges.withColumn("_row", F.row_number().over(within))
        .join(starts, "_range")
        .withColumn(name, F.col("_start") + F.col("_row") - 1)
        .drop("_range", "_start", "_row")
    )
