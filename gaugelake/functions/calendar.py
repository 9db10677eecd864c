"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEASON_ORDER = ["Winter", "Spring", "Summer", "Fall"]


def season(timestamp: Column) -> Column:
    month = F.month(timestamp)
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


def season_rank(name: Column) -> Column:
    """Position of a season within the year, for sorting."""
    return F.array_position(F.array(*[F.lit(s) for s in SEASON_ORDER]), name)


def hour_number(timestamp: Column) -> Column:
    """Whole hours since the epoch, rounded down."""
    return F.floor(F.unix_seconds(timestamp) / F.lit(3600)).cast("bigint")


def hour_start(number: Column) -> Column:
    """Inverse of ``hour_number``."""
    return F.timestamp_seconds(number * F.lit(3600))


def with_partition_columns(df, timestamp: str = "timestamp"):
    """Add year and month of the observation time, the directory columns of the stored tables."""
    return df.withColumn("year", F.year(timestamp)).withColumn("month", F.month(timestamp))


def in_range(timestamp: str, start: str, end: str) -> Column:
    """start <= timestamp < end as plain comparisons, so that Parquet statistics can skip data."""
    column = F.col(timestamp)
    return (column >= F.lit(start).cast("timestamp")) & (column < F.lit(end).cast("timestamp"))
