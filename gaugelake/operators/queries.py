"""Analytical queries over the silver table."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.functions import calendar, fixed_point

TEMP, HUMIDITY, RAIN, WIND = (
    "temperature_celsius", "humidity_percent", "rainfall_mm", "wind_speed_ms")
CORRELATED = [TEMP, HUMIDITY, RAIN, WIND]


def _mean(column: str, digits: int) -> Column:
    return fixed_point.mean(column, digits)


def _total(column: str, digits: int = 1) -> Column:
    return fixed_point.total(column, digits)


def station_comparison(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("station_id").agg(
            F.count("*").alias("total_hours"),
            F.min("timestamp").alias("start_date"),
            F.max("timestamp").alias("end_date"),
            _mean(TEMP, 2).alias("avg_temp"),
            F.round(fixed_point.lowest(TEMP), 2).alias("min_temp"),
            F.round(fixed_point.highest(TEMP), 2).alias("max_temp"),
            _mean(HUMIDITY, 1).alias("avg_humidity"),
            _total(RAIN).alias("total_rainfall_mm"),
        ).orderBy("station_id")
    )


def monthly_averages(silver: DataFrame, limit: int | None = None) -> DataFrame:
    """Per station and month, in order; ``limit`` gives the first rows as a report."""
    months = silver.groupBy(
        "station_id", F.year("timestamp").alias("year"), F.month("timestamp").alias("month"),
    ).agg(
        F.count("*").alias("hours"),
        _mean(TEMP, 2).alias("avg_temp"),
        _mean(HUMIDITY, 1).alias("avg_humidity"),
        _total(RAIN).alias("rainfall_mm"),
    ).orderBy("station_id", "year", "month")
    return months if limit is None else months.limit(limit)


def month_station_combinations(silver: DataFrame) -> DataFrame:
    """Number of months x number of stations: the size of the grid, not of its filled part."""
    # the few (station, month) pairs first, so that the distinct counts see no observation rows
    pairs = silver.select(
        "station_id", (F.year("timestamp") * 100 + F.month("timestamp")).alias("ym")).distinct()
    return pairs.agg(
        (F.countDistinct("ym") * F.countDistinct("station_id")).alias("combinations"))


def _per_value(silver: DataFrame, column: str) -> DataFrame:
    """Rows and first time per (station, value).

    Measurements have a fixed resolution, so this is small however many rows a station has.
    """
    return silver.groupBy("station_id", fixed_point.present(column).alias(column)).agg(
        F.count("*").alias("_rows"), F.min("timestamp").alias("_first"))


def hottest_coldest(silver: DataFrame) -> DataFrame:
    """The hottest and the coldest hour of each station, the earliest if there are several.

    A station without any temperature gives its earliest hour.
    """
    # one row per value, so the value itself decides; without any value the earliest hour counts
    earliest = F.min("_first")
    extremes = _per_value(silver, TEMP).groupBy("station_id").agg(
        fixed_point.highest(TEMP).alias("hot"), F.coalesce(F.max_by("_first", TEMP), earliest).alias("hot_at"),
        fixed_point.lowest(TEMP).alias("cold"), F.coalesce(F.min_by("_first", TEMP), earliest).alias("cold_at"))
    both = F.array(*[
        F.struct(F.lit(label).alias("extreme_type"), F.col(f"{name}_at").alias("timestamp"),
                 F.round(name, 1).alias("temp_celsius"))
        for label, name in (("HOTTEST", "hot"), ("COLDEST", "cold"))])
    return extremes.select("station_id", F.inline(both)).orderBy(
        F.col("station_id"), F.col("extreme_type").desc())


def rainfall_comparison(silver: DataFrame) -> DataFrame:
    wet = f"count_if({RAIN} > 0)"
    return (
        silver.groupBy("station_id").agg(
            F.count("*").alias("total_hours"),
            _total(RAIN).alias("total_rainfall_mm"),
            _mean(RAIN, 2).alias("avg_rainfall_per_hour"),
            F.round(fixed_point.highest(RAIN), 1).alias("max_hourly_rainfall"),
            F.expr(wet).alias("hours_with_rain"),
            fixed_point.percent(wet, "count(*)").alias("pct_hours_with_rain"),
        ).orderBy(F.col("total_rainfall_mm").desc_nulls_last(), "station_id")
    )


def quality_comparison(silver: DataFrame) -> DataFrame:
    outliers = "count_if(has_outliers)"
    return (
        silver.groupBy("station_id").agg(
            F.count("*").alias("total_records"),
            _mean("quality_score", 3).alias("avg_quality"),
            F.expr(outliers).alias("outlier_count"),
            fixed_point.percent(outliers, "count(*)").alias("outlier_pct"),
        ).orderBy("station_id")
    )


def wind_statistics(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.col(WIND).isNotNull()).groupBy("station_id").agg(
            _mean(WIND, 2).alias("avg_wind_speed_ms"),
            F.round(fixed_point.highest(WIND), 1).alias("max_wind_speed_ms"),
            F.round(fixed_point.highest("wind_gust_ms"), 1).alias("max_wind_gust_ms"),
            F.count_if(F.col(WIND) > 10).alias("hours_strong_wind"),
        ).orderBy(F.col("avg_wind_speed_ms").desc(), "station_id")
    )


def _in_year(silver: DataFrame, year: int) -> DataFrame:
    rows = silver.where(calendar.in_range("timestamp", f"{year}-01-01", f"{year + 1}-01-01"))
    # the directory column lets the scan skip whole years
    return rows.where(F.col("year") == year) if "year" in silver.columns else rows


def seasonal_temperatures(silver: DataFrame, year: int) -> DataFrame:
    return (
        _in_year(silver, year)
        .groupBy("station_id", calendar.season(F.col("timestamp")).alias("season")).agg(
            _mean(TEMP, 2).alias("avg_temp"),
            F.round(fixed_point.lowest(TEMP), 2).alias("min_temp"),
            F.round(fixed_point.highest(TEMP), 2).alias("max_temp"),
            _total(RAIN).alias("total_rainfall"),
        ).orderBy("station_id", calendar.season_rank(F.col("season")))
    )


def station_stats(silver: DataFrame) -> DataFrame:
    """Like ``station_comparison``, but a station without any rain value has a total of 0."""
    return (
        silver.groupBy("station_id").agg(
            F.count("timestamp").alias("total_hours"),
            _mean(TEMP, 2).alias("avg_temp"),
            F.round(fixed_point.lowest(TEMP), 2).alias("min_temp"),
            F.round(fixed_point.highest(TEMP), 2).alias("max_temp"),
            F.coalesce(_total(RAIN), F.lit(0.0)).alias("total_rainfall"),
            _mean("quality_score", 3).alias("avg_quality"),
        ).orderBy("station_id")
    )


DEVIATION_UNITS = 10 ** 6  # the standard deviation adds whole millionths of a degree
QUARTILES = {"q25_temp": 0.25, "median_temp": 0.5, "q75_temp": 0.75}


def temperature_distribution(silver: DataFrame, method: str = "nearest", digits: int = 2,
                             accuracy: int = 10_000) -> DataFrame:
    """Quartiles and sample standard deviation of the temperature per station.

    ``nearest`` takes the value whose rank is nearest to q * (n - 1), ``linear`` interpolates
    between the two neighbouring values; both are exact. ``approx`` is ``percentile_approx``, whose
    ranks are wrong by at most 1 / ``accuracy`` of the rows. The deviation is exact for temperatures
    of up to six decimals; further ones are rounded.
    """
    if method == "approx":
        return silver.groupBy("station_id").agg(
            *[F.round(F.percentile_approx(TEMP, q, accuracy), digits).alias(name)
              for name, q in QUARTILES.items()],
            F.round(F.stddev_samp(TEMP), digits).alias("std_temp")).orderBy("station_id")
    if method not in ("nearest", "linear"):
        raise ValueError(f"unknown quantile method: {method}")

    # from here on all reads the counts per value: one scan, and exact whole-number moments. The
    # values are ranked within whole degrees, and the degrees among each other, so that no task
    # sorts all values of a station. A missing temperature has no rows here, only its station.
    present = F.when(F.col(TEMP).isNotNull(), F.col("_rows")).otherwise(F.lit(0))
    values = _per_value(silver, TEMP).select(
        # keys without nulls: the join would filter nulls on one side, and scan the table twice
        F.coalesce("station_id", F.lit("")).alias("station_id"),
        F.coalesce(F.floor(TEMP), F.lit(0)).alias("_degree"), TEMP,
        present.alias("_rows"),
        F.expr(f"CAST(rint({TEMP} * {DEVIATION_UNITS}D) AS DECIMAL(38, 0))").alias("_u"),
    )
    station = Window.partitionBy("station_id")
    degrees = values.groupBy("station_id", "_degree").agg(F.sum("_rows").alias("_in")).select(
        "station_id", "_degree",
        (F.sum("_in").over(station.orderBy("_degree")) - F.col("_in")).alias("_before"),
        F.sum("_in").over(station).alias("_n"),
    )
    within = Window.partitionBy("station_id", "_degree").orderBy(F.col(TEMP).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = values.withColumn("_upto", F.sum("_rows").over(within)).join(
        degrees, ["station_id", "_degree"],
    ).withColumn("_last", F.col("_before") + F.col("_upto"))  # rank of the last row with this value

    def value_at(rank: Column) -> Column:
        inside = (rank > F.col("_last") - F.col("_rows")) & (rank <= F.col("_last"))
        return F.max(F.when(inside, F.col(TEMP)))

    def quantile(q: float) -> Column:
        position = (F.col("_n") - 1) * F.lit(q)
        if method == "nearest":
            return value_at(F.floor(position + F.lit(0.5)) + 1)
        low = value_at(F.floor(position) + 1)
        high = value_at(F.ceil(position) + 1)
        return low + (high - low) * F.max(position - F.floor(position))

    n = F.max("_n").cast("decimal(38,0)")
    s1 = F.sum(F.col("_u") * F.col("_rows"))
    s2 = F.sum(F.col("_u") * F.col("_u") * F.col("_rows"))
    variance = (n * s2 - s1 * s1).cast("double") / (n * (n - 1)).cast("double")
    std = F.when(F.max("_n") > 1, F.sqrt(variance) / F.lit(float(DEVIATION_UNITS)))
    return (
        ranked.groupBy("station_id").agg(
            *[F.round(quantile(q), digits).alias(name) for name, q in QUARTILES.items()],
            F.round(std, digits).alias("std_temp"))
        .withColumn("station_id", F.nullif("station_id", F.lit("")))
        .orderBy("station_id")
    )


def _corr(a: str, b: str, digits: int) -> Column:
    """Pearson correlation over the rows with both values; null if one of them is constant.

    ``corr`` itself divides by zero there, which is an error in ANSI mode. Adding 0 turns -0.0
    into 0.0.
    """
    return F.expr(
        f"round(try_divide(regr_sxy({a}, {b}), sqrt(regr_sxx({a}, {b}) * regr_syy({a}, {b}))),"
        f" {digits}) + 0D")


def correlation_pairs(silver: DataFrame, digits: int = 6) -> DataFrame:
    """Pearson correlation of four pairs over all rows where both values are present."""
    return silver.agg(
        _corr(TEMP, HUMIDITY, digits).alias("temp_humidity"),
        _corr(TEMP, RAIN, digits).alias("temp_rainfall"),
        _corr(HUMIDITY, RAIN, digits).alias("humidity_rainfall"),
        _corr(WIND, RAIN, digits).alias("wind_rainfall"),
    )


def correlation_matrix(silver: DataFrame, columns: list[str] | None = None,
                       digits: int = 3) -> DataFrame:
    """Square matrix of pairwise-complete correlations, one row per column, from one aggregate."""
    names = columns or CORRELATED
    pairs = {(a, b): f"_{i}_{j}" for i, a in enumerate(names) for j, b in enumerate(names) if i <= j}
    one = silver.agg(*[_corr(a, b, digits).alias(name) for (a, b), name in pairs.items()])
    rows = [
        F.struct(F.lit(a).alias("variable"),
                 *[F.col(pairs.get((a, b)) or pairs[(b, a)]).alias(b) for b in names])
        for a in names
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def rainiest_days(silver: DataFrame, limit: int = 10) -> DataFrame:
    """The days with the highest rain total; a day without any value counts as 0."""
    return (
        silver.groupBy("station_id", F.to_date("timestamp").alias("date"))
        .agg(F.coalesce(_total(RAIN, 3), F.lit(0.0)).alias("daily_rainfall"))
        .orderBy(F.col("daily_rainfall").desc(), "station_id", "date")
        .limit(limit)
    )


def null_profile(silver: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns with nulls: their number and percentage, from one pass over the table."""
    names = columns or silver.columns
    one = silver.agg(
        F.count("*").alias("_total"),
        *[F.expr(f"count_if(`{c}` IS NULL) AS n_{i}") for i, c in enumerate(names)])
    pairs = F.array(*[
        F.expr(f"struct('{c}' AS column_name, n_{i} AS null_count)") for i, c in enumerate(names)])
    return (
        one.select(F.col("_total").alias("total_records"), F.explode(pairs).alias("p"))
        .select("p.column_name", "total_records", "p.null_count",
                fixed_point.percent("p.null_count", "total_records").alias("null_pct"))
        .where(F.col("null_count") > 0)
    )


def temperature_stats(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("station_id").agg(
            F.count(TEMP).alias("count"),
            _mean(TEMP, 2).alias("mean"),
            F.round(F.stddev_samp(TEMP), 2).alias("std"),
            F.round(fixed_point.lowest(TEMP), 2).alias("min"),
            F.round(fixed_point.highest(TEMP), 2).alias("max"),
        ).orderBy("station_id")
    )


def windiest_hours(silver: DataFrame, limit: int = 10) -> DataFrame:
    """The hours with the highest wind speed; equal speeds by time, then station."""
    return (
        silver.where(F.col(WIND).isNotNull())
        .select("station_id", "timestamp", WIND, "wind_gust_ms", "wind_direction_degrees")
        .orderBy(F.col(WIND).desc(), F.col("timestamp").asc_nulls_last(), "station_id")
        .limit(limit)
    )


def coverage_span(silver: DataFrame) -> DataFrame:
    return silver.groupBy("station_id").agg(
        F.count("*").alias("hours"),
        F.min("timestamp").alias("first_hour"),
        F.max("timestamp").alias("last_hour"),
    )


def _on_days(table: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of start <= timestamp < end, which lie in at most two years of directories."""
    rows = table.where(calendar.in_range("timestamp", start, end))
    if "year" in table.columns:
        rows = rows.where(F.col("year").between(int(start[:4]), int(end[:4])))
    return rows


def hour_slice(table: DataFrame, station_id: str, day: str, hour: int | None = None) -> DataFrame:
    """All columns of one station on one day, or in one hour of it."""
    start = datetime.fromisoformat(day) + timedelta(hours=hour or 0)
    end = start + (timedelta(days=1) if hour is None else timedelta(hours=1))
    return _on_days(table.where(F.col("station_id") == station_id), str(start), str(end))


def recent_window(silver: DataFrame, station_id: str, until: str | None = None,
                  days: int = 7) -> DataFrame:
    """One station from ``days`` days before a date up to that date (today if none), in order."""
    last = date.fromisoformat(until) if until else datetime.now(timezone.utc).date()
    start, end = last - timedelta(days=days), last + timedelta(days=1)
    rows = _on_days(silver.where(F.col("station_id") == station_id), str(start), str(end))
    return rows.select("timestamp", TEMP, RAIN, HUMIDITY).orderBy("timestamp")


def temps_since(silver: DataFrame, stations: DataFrame, since: str) -> DataFrame:
    """Temperatures since a date per station name; a station that the registry lacks goes by its id.

    The observations are summed up per station before the registry names them, so the join sees
    one row per station.
    """
    rows = silver.where(F.col("timestamp") >= F.lit(since).cast("timestamp"))
    if "year" in silver.columns:
        rows = rows.where(F.col("year") >= int(since[:4]))
    per_station = rows.groupBy("station_id").agg(
        *fixed_point.partial(TEMP, "_temp"),
        fixed_point.lowest(TEMP).alias("_min"),
        fixed_point.highest(TEMP).alias("_max"),
    )
    named = per_station.join(
        stations.select(F.col("id").alias("station_id"), F.col("name").alias("station_name")),
        "station_id", "left").withColumn("station_name", F.coalesce("station_name", "station_id"))
    return named.groupBy("station_name").agg(
        fixed_point.partial_mean("_temp", 2, merged=True).alias("avg_temp"),
        F.min("_min").alias("min_temp"),
        F.max("_max").alias("max_temp"),
    )
