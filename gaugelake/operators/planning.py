"""Backfill plans: which station periods to request, at what cost, and how far they are."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugelake.functions import fixed_point
from gaugelake.operators.numbering import with_position
from gaugelake.schema import (
    DATE_RANGES,
    MAX_POINTS_PER_REQUEST,
    PARAMETERS_PER_HOUR,
    REQUEST_SAFETY,
)


def _timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _calendar_periods(start: Column, end: Column, months: int, unit: str) -> Column:
    """Aligned periods of whole months, cut off at both ends."""
    step = F.make_ym_interval(months=F.lit(months))
    starts = F.sequence(F.date_trunc(unit, start), end, step)
    return F.transform(starts, lambda s: F.struct(
        F.greatest(s, start).alias("start"),
        F.least(s + step - F.expr("INTERVAL 1 SECOND"), end).alias("end")))


def _fixed_periods(start: Column, end: Column, length: str, closed: bool) -> Column:
    """Periods of a fixed length; a closed one ends at its length and the next starts 1 s later."""
    span = F.expr(f"INTERVAL {length}")
    second = F.expr("INTERVAL 1 SECOND")
    starts = F.sequence(start, end, span + second if closed else span)
    last = span if closed else span - second
    return F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.least(s + last, end).alias("end")))


def backfill_plan(stations: DataFrame, start: str, end: str, granularity: str = "year",
                  n: int = 1) -> DataFrame:
    """One row per station and period; both ends of a period are included.

    granularity: ``year`` and ``month`` (calendar periods), ``months`` (n calendar months counted
    from January of the first year), ``days30`` (n x 30 days) or ``hour``. The first and the last
    period are cut off at the requested range, whose start counts from midnight.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if datetime.fromisoformat(start) > datetime.fromisoformat(end):
        raise ValueError("the range ends before it starts")
    first, last = F.date_trunc("day", _timestamp(start)), _timestamp(end)
    periods = {
        "year": lambda: _calendar_periods(first, last, 12, "year"),
        "month": lambda: _calendar_periods(first, last, 1, "month"),
        "months": lambda: _calendar_periods(F.date_trunc("year", first), last, n, "year"),
        "days30": lambda: _fixed_periods(first, last, f"{30 * n} DAYS", closed=True),
        "hour": lambda: _fixed_periods(first, last, "1 HOUR", closed=False),
    }
    if granularity not in periods:
        raise ValueError(f"unknown granularity: {granularity}")
    return (
        stations.select("station_key", F.explode(periods[granularity]()).alias("p"))
        .select("station_key", F.col("p.start").alias("start"), F.col("p.end").alias("end"))
        # a period of no length, left over where the range ends on a boundary
        .where(F.col("start") < F.col("end"))
    )


def preset_plan(stations: DataFrame, preset: str, granularity: str = "month", n: int = 1) -> DataFrame:
    """``backfill_plan`` over a named date range."""
    start, end = DATE_RANGES[preset]
    return backfill_plan(stations, start, end, granularity, n)


def months_per_request(batch_size: int) -> int:
    """Whole months of 30 days that keep a batch below the request limit, from 1 to 6."""
    hours = MAX_POINTS_PER_REQUEST * REQUEST_SAFETY / (batch_size * PARAMETERS_PER_HOUR)
    return max(1, min(6, int(hours / 720)))


def station_batches(stations: DataFrame, batch_size: int) -> DataFrame:
    """Stations in groups of ``batch_size`` by key order."""
    numbered = with_position(stations.select("station_key"), ["station_key"])
    batch = F.call_function("div", F.col("position"), F.lit(batch_size))
    return numbered.select("station_key", batch.alias("batch_id"))


def plan_cost(stations: DataFrame, start: str, end: str, batch_size: int,
              months: int | None = None) -> DataFrame:
    """Per batch: requests, hours, data points and records, and requests saved by batching."""
    months = months or months_per_request(batch_size)
    batches = station_batches(stations, batch_size).groupBy("batch_id").agg(
        F.count("*").alias("stations"))
    chunks = backfill_plan(batches.withColumn("station_key", F.col("batch_id")),
                           start, end, "months", months)
    seconds = F.unix_seconds("end") - F.unix_seconds("start")
    per_batch = chunks.groupBy(F.col("station_key").alias("batch_id")).agg(
        F.count("*").alias("requests"),
        F.sum(F.call_function("div", seconds + 1, F.lit(3600))).alias("hours"),
        F.sum(F.call_function("div", seconds, F.lit(86400))).alias("_days"),
    )
    return batches.join(per_batch, "batch_id").select(
        "batch_id", "stations", F.lit(months).alias("months_per_request"), "requests",
        (F.col("requests") * F.col("stations")).alias("single_requests"),
        "hours",
        (F.col("hours") * PARAMETERS_PER_HOUR * F.col("stations")).alias("data_points"),
        (F.col("_days") * 24 * F.col("stations")).alias("estimated_records"),
    )


def cost_totals(cost: DataFrame) -> DataFrame:
    """Requests of the whole plan against one request per station, and the percentage saved."""
    return cost.agg(
        F.count("*").alias("batches"),
        F.sum("stations").alias("stations"),
        F.sum("requests").alias("requests"),
        F.sum("single_requests").alias("single_requests"),
        fixed_point.percent("sum(single_requests) - sum(requests)", "sum(single_requests)")
        .alias("saved_pct"),
        F.sum("data_points").alias("data_points"),
        F.sum("estimated_records").alias("estimated_records"),
    )


def chunk_status(plan: DataFrame, loaded: DataFrame, failures: DataFrame) -> DataFrame:
    """State of every planned month: complete, failed (with its last error) or pending.

    ``loaded`` has (station_key, month, records) with the month as yyyy-MM, ``failures`` has
    (station_key, month, failed_at, error). A month that was loaded after a failure is complete.
    """
    key = ["station_key", "month"]
    months = plan.select("station_key", F.date_format("start", "yyyy-MM").alias("month"))
    records = loaded.groupBy(*key).agg(F.sum("records").alias("records"))
    last = F.max(F.struct("failed_at", "error"))["error"]
    errors = failures.groupBy(*key).agg(last.alias("error"))
    done = F.col("records").isNotNull()
    return months.join(records, key, "left").join(errors, key, "left").select(
        *key,
        F.when(done, "complete").when(F.col("error").isNotNull(), "failed")
        .otherwise("pending").alias("status"),
        "records",
        F.when(~done, F.col("error")).alias("error"),
    )
