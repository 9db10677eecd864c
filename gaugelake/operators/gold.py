"""Summary tables.

``daily_states`` holds what can be merged: counts, extremes, and the sums and counts behind the means as DECIMALs. Days, months, regions and
rankings are made from the states without looking at an observation again, and a day that changes changes its own states
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake.functions import fixed_point
from gaugelake.operators.queries import HUMIDITY, RAIN, TEMP, WIND
from gaugelake.schema import PARAM_PROFILES


STATES = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("hours", T.LongType()),
    T.StructField("min_temp", T.DoubleType()),
    T.StructField("max_temp", T.DoubleType()),
    *[T.StructField(f"{name}_{part}", kind) for name in ("temp", "rain", "humidity")
      for part, kind in (("sum", T.DecimalType(38, fixed_point.DECIMALS)), ("count", T.LongType()))],
    T.StructField("year", T.IntegerType()),
])

HOURLY = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    *[T.StructField(c, T.DoubleType()) for c in (TEMP, HUMIDITY, RAIN, WIND)],
    T.StructField("date", T.DateType()),
    T.StructField("year", T.IntegerType()),
])

EVENTS = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("date", T.DateType()),
    T.StructField("year", T.IntegerType()),
])


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumns({"date": F.to_date("timestamp"), "year": F.year("timestamp")})


def daily_states(silver: DataFrame) -> DataFrame:
    """Mergeable states of every station and day."""
    return _dated(silver).groupBy("station_id", "date", "year").agg(
        F.count("*").alias("hours"),
        fixed_point.lowest(TEMP).alias("min_temp"),
        fixed_point.highest(TEMP).alias("max_temp"),
        *fixed_point.partial(TEMP, "temp"),
        *fixed_point.partial(RAIN, "rain"),
        *fixed_point.partial(HUMIDITY, "humidity"),
    ).select(*STATES.names)


def hourly_rows(silver: DataFrame) -> DataFrame:
    """The key variables of all stations."""
    return _dated(silver).select(*HOURLY.names)


def event_rows(silver: DataFrame) -> DataFrame:
    return _dated(extreme_events(silver)).select(*EVENTS.names)


def placed_event_rows(silver: DataFrame) -> DataFrame:
    """``event_rows`` in ranges of day, station and time.

    The hours are dealt before they become events, so an hour with several is shuffled once, and only its values.
    """
    hours = silver.where(_any_event()).select("station_id", "timestamp", RAIN, TEMP, WIND)
    return event_rows(hours.repartitionByRange(F.to_date("timestamp"), "station_id", "timestamp"))


def daily_from_states(states: DataFrame) -> DataFrame:
    return states.select(
        "station_id", "date", "min_temp", "max_temp",
        fixed_point.partial_mean("temp", 2).alias("avg_temp"),
        fixed_point.partial_total("rain", 1).alias("total_rainfall_mm"),
        fixed_point.partial_mean("humidity", 1).alias("avg_humidity"))


def _merged(states: DataFrame, keys: list, counts: list[str] = ()) -> DataFrame:
    """States of larger groups, under the same names; further ``counts`` are added up."""
    added = ["hours", *counts, *(c for c in STATES.names if c.endswith(("_sum", "_count")))]
    return states.groupBy(*keys).agg(
        F.min("min_temp").alias("min_temp"), F.max("max_temp").alias("max_temp"), *[F.sum(c).alias(c) for c in added])


def _months(states: DataFrame) -> DataFrame:
    return _merged(states, ["station_id", F.year("date").alias("year"), F.month("date").alias("month")])


def _month_values() -> list:
    return [fixed_point.partial_mean("temp", 2).alias("avg_temp"), "min_temp", "max_temp",
            fixed_point.partial_total("rain", 1).alias("total_rainfall_mm"),
            fixed_point.partial_mean("humidity", 1).alias("avg_humidity")]


def monthly_from_states(states: DataFrame, stations: DataFrame) -> DataFrame:
    return _with_region(_months(states), stations).select(
        "region", "station_id", "station_name", "year", "month", "hours", *_month_values())


def regions_from_states(states: DataFrame, stations: DataFrame) -> DataFrame:
    parts = _with_region(_months(states), stations).withColumn("stations", F.lit(1).cast("long"))
    keys = ["region", "year", "month"]
    return _merged(parts, keys, ["stations"]).select(*keys, "stations", "hours", *_month_values())


def wettest_from_states(states: DataFrame, stations: DataFrame, limit: int = 10) -> DataFrame:
    """The days with the highest rain total and the names of their stations; days without any value sort last."""
    top = states.select(
        "station_id", F.date_trunc("day", "date").alias("day"),
        fixed_point.partial_total("rain", 1).alias("total_rainfall_mm"),
    ).orderBy(F.col("total_rainfall_mm").desc_nulls_last(), "station_id", "day").limit(limit)
    named = stations.select(F.col("id").alias("station_id"), F.col("name").alias("station_name"))
    return top.join(named, "station_id", "left").select("station_id", "station_name", "day", "total_rainfall_mm")


def daily_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("station_id", F.to_date("timestamp").alias("date")).agg(
        fixed_point.lowest(TEMP).alias("min_temp"),
        fixed_point.highest(TEMP).alias("max_temp"),
        fixed_point.mean(TEMP, 2).alias("avg_temp"),
        fixed_point.total(RAIN, 1).alias("total_rainfall_mm"),
        fixed_point.mean(HUMIDITY, 1).alias("avg_humidity"),
    )


def hourly_station(silver: DataFrame, station_id: str) -> DataFrame:
    """The key variables of one station."""
    return silver.where(F.col("station_id") == station_id).select(
        "timestamp", TEMP, HUMIDITY, RAIN, WIND)


def _monthly_parts(silver: DataFrame) -> DataFrame:
    return silver.groupBy(
        "station_id", F.year("timestamp").alias("year"), F.month("timestamp").alias("month"),
    ).agg(
        F.count("*").alias("hours"),
        fixed_point.lowest(TEMP).alias("min_temp"),
        fixed_point.highest(TEMP).alias("max_temp"),
        *fixed_point.partial(TEMP, "_temp"),
        *fixed_point.partial(RAIN, "_rain"),
        *fixed_point.partial(HUMIDITY, "_humidity"),
    )


def _with_region(parts: DataFrame, stations: DataFrame) -> DataFrame:
    return parts.join(
        stations.select(F.col("id").alias("station_id"), F.col("name").alias("station_name"),
                        "region"), "station_id", "left")


def monthly_comparison(silver: DataFrame, stations: DataFrame) -> DataFrame:
    """Monthly values of every station with its name and region.

    The join sees one row per station and month.
    """
    return _with_region(_monthly_parts(silver), stations).select(
        "region", "station_id", "station_name", "year", "month", "hours",
        fixed_point.partial_mean("_temp", 2).alias("avg_temp"),
        "min_temp", "max_temp",
        fixed_point.partial_total("_rain", 1).alias("total_rainfall_mm"),
        fixed_point.partial_mean("_humidity", 1).alias("avg_humidity"),
    )


def monthly_by_region(silver: DataFrame, stations: DataFrame) -> DataFrame:
    """Monthly values of every region, weighted by the hours of its stations."""
    return _with_region(_monthly_parts(silver), stations).groupBy("region", "year", "month").agg(
        F.count("*").alias("stations"),
        F.sum("hours").alias("hours"),
        fixed_point.partial_mean("_temp", 2, merged=True).alias("avg_temp"),
        F.min("min_temp").alias("min_temp"),
        F.max("max_temp").alias("max_temp"),
        fixed_point.partial_total("_rain", 1, merged=True).alias("total_rainfall_mm"),
        fixed_point.partial_mean("_humidity", 1, merged=True).alias("avg_humidity"),
    )


# limits of an extreme event: mm per hour, degrees Celsius, m/s (60 km/h)
HEAVY_RAIN = 20.0
FROST, HEAT = 0.0, 30.0
STRONG_WIND = 60 / 3.6


def _event_kinds() -> dict:
    return {
        "heavy_rain": (F.col(RAIN) > HEAVY_RAIN, RAIN),
        "frost": (F.col(TEMP) < FROST, TEMP),
        "heat": (F.col(TEMP) > HEAT, TEMP),
        "strong_wind": (F.col(WIND) > STRONG_WIND, WIND),
    }


def _any_event() -> Column:
    anything = None
    for condition, _ in _event_kinds().values():
        anything = condition if anything is None else anything | condition
    return anything


def extreme_events(silver: DataFrame) -> DataFrame:
    """One row per hour and kind of event."""
    kinds, anything = _event_kinds(), _any_event()
    found = F.array_compact(F.array(*[
        F.when(condition, F.struct(F.lit(kind).alias("event_type"), F.col(value).alias("value")))
        for kind, (condition, value) in kinds.items()
    ]))
    # the plain condition reaches the Parquet scan, the array does not
    return silver.where(anything).select(
        "station_id", "timestamp", F.explode(found).alias("e")).select(
        "station_id", "timestamp", "e.event_type", "e.value")


def wettest_days(silver: DataFrame, limit: int = 10) -> DataFrame:
    """The days with the highest rain total; a day without any value has none and sorts last."""
    return (
        silver.groupBy("station_id", F.date_trunc("day", "timestamp").alias("day"))
        .agg(fixed_point.total(RAIN, 1).alias("total_rainfall_mm"))
        .orderBy(F.col("total_rainfall_mm").desc_nulls_last(), "station_id", "day")
        .limit(limit)
    )


def param_profile(refined: DataFrame, profile: str) -> DataFrame:
    """Time, station and the parameters of a named profile; an absent parameter is null."""
    names = PARAM_PROFILES[profile]
    if names is None:
        return refined
    return refined.select(
        "timestamp", "location_id",
        *[F.col(n) if n in refined.columns else F.lit(None).cast("double").alias(n) for n in names])
