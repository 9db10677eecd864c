"""Missing hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.functions import calendar, fixed_point

_BLOCK = 8784  # hours, about a year


def _hours(table: DataFrame) -> DataFrame:
    return table.where(F.col("timestamp").isNotNull()).select(
        "station_id", calendar.hour_number(F.col("timestamp")).alias("hour")).distinct()


def _hours_of_range(table: DataFrame, start: str, end: str) -> DataFrame:
    """The observed hours of a range, and for every station of the table the hour before and after."""
    first, after = (calendar.hour_number(F.lit(t).cast("timestamp")) for t in (start, end))
    bounds = table.select("station_id").distinct().select(
        "station_id", F.explode(F.array(first - 1, after)).alias("hour"))
    inside = table.where(calendar.in_range("timestamp", start, end))
    if "year" in table.columns:
        inside = inside.where(F.col("year").between(int(start[:4]), int(end[:4])))
    return _hours(inside).unionByName(bounds)


def detect_gaps(table: DataFrame, min_hours: int = 1, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """Ranges of at least ``min_hours`` missing hours between two observed ones.

    With both ``start`` and ``end`` (not included), the hours missing at either end of that range
    count as well, and nothing outside of it does.

    Repeated hours disappear before any shuffle. The remaining ones are compared with their
    neighbours within blocks of about a year, so a station is spread over many tasks; the two ends
    of each block are then compared from block to block. Both steps share one scan and shuffle.
    """
    observed = _hours(table) if start is None or end is None else _hours_of_range(table, start, end)
    hours = observed.withColumn(
        "block", F.call_function("div", F.col("hour"), F.lit(_BLOCK)))
    inside = Window.partitionBy("station_id", "block").orderBy("hour")
    placed = hours.select(
        "station_id", "hour",
        F.lag("hour").over(inside).alias("last"), F.lead("hour").over(inside).alias("next"))

    ends = placed.where(F.col("last").isNull() | F.col("next").isNull())
    across = Window.partitionBy("station_id").orderBy("hour")
    between = ends.select(
        "station_id", "hour", F.lag("hour").over(across).alias("before"), "last",
    ).where(F.col("last").isNull()).select("station_id", "hour", F.col("before").alias("last"))

    missing = F.col("hour") - F.col("last") - 1
    return placed.select("station_id", "hour", "last").unionByName(between).where(
        missing >= min_hours,
    ).select(
        "station_id",
        calendar.hour_start(F.col("last") + 1).alias("gap_start"),
        calendar.hour_start(F.col("hour") - 1).alias("gap_end"),
        missing.alias("missing_hours"),
    )


def completeness(table: DataFrame) -> DataFrame:
    """Observed hours against the hours from the first to the last observation."""
    expected = "max(hour) - min(hour) + 1"
    return _hours(table).groupBy("station_id").agg(
        F.count("*").alias("observed_hours"),
        F.expr(expected).alias("expected_hours"),
        fixed_point.percent("count(*)", expected).alias("completeness_pct"),
    )


def update_windows(table: DataFrame, now: str, lookback_hours: int, max_gap_days: int) -> DataFrame:
    """What the next incremental run should ask for, per station.

    One window from the last observed hour, less the lookback, up to now, and one for each gap
    that is short enough to be filled without a decision.
    """
    last = table.groupBy("station_id").agg(F.max("timestamp").alias("_last"))
    recent = last.select(
        "station_id", F.lit("recent").alias("reason"),
        (F.col("_last") - F.expr(f"INTERVAL {lookback_hours} HOURS")).alias("start"),
        F.lit(now).cast("timestamp").alias("end"))
    gaps = detect_gaps(table).where(F.col("missing_hours") <= max_gap_days * 24).select(
        "station_id", F.lit("gap").alias("reason"),
        F.col("gap_start").alias("start"), F.col("gap_end").alias("end"))
    return recent.unionByName(gaps)
