"""Load manifests as tables: which station periods are loaded, and how the loads went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.functions import fixed_point
from gaugelake.schema import YEAR_ENTRY

KEY = ["station_key", "year"]


def normalize_manifest(docs: DataFrame) -> DataFrame:
    """Manifest documents -> one row per (station, loaded year).

    An entry is a bare year (old documents) or an object with a year; a document may mix them.
    """
    entry = docs.select(
        "station_key", "station_id", "station_name", F.explode("years_loaded").alias("_entry"))
    # only the object form is parsed, so a bare year never reaches the strict JSON schema
    parsed = F.from_json(F.when(F.col("_entry").startswith("{"), F.col("_entry")), YEAR_ENTRY)
    return entry.withColumn("_e", parsed).select(
        "station_key", "station_id", "station_name",
        F.coalesce(F.col("_entry").try_cast("int"), F.col("_e.year")).alias("year"),
        F.col("_e.loaded_at").alias("loaded_at"),
        F.col("_e.file_path").alias("file_path"),
        F.col("_e.size_mb").alias("size_mb"),
    ).where(F.col("year").isNotNull())


def first_entries(entries: DataFrame) -> DataFrame:
    """One row per (station, year): the entry loaded first; one without a time counts as the last."""
    rest = [c for c in entries.columns if c not in KEY and c != "loaded_at"]
    first = F.min(F.struct(F.col("loaded_at").isNull().alias("_untimed"), "loaded_at", *rest)).alias("_e")
    return entries.groupBy(*KEY).agg(first).select(
        *KEY, *[F.col(f"_e.{c}").alias(c) for c in entries.columns if c not in KEY])


def mark_loaded(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Insert-if-absent: a (station, year) already in the manifest keeps its row."""
    new = first_entries(loaded).join(manifest.select(*KEY), KEY, "left_anti")
    return manifest.unionByName(new.select(*manifest.columns))


def skip_loaded(plan: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """The planned periods that still need loading; all of them if forced."""
    return plan if force else plan.join(manifest.select(*KEY), KEY, "left_anti")


def missing_years(stations: DataFrame, manifest: DataFrame, start: int, end: int) -> DataFrame:
    """Years of start..end without an entry, per station."""
    # a sequence counts downwards where its end lies before its start
    wanted = stations.where(F.lit(start <= end)).select(
        "station_key", F.explode(F.sequence(F.lit(start), F.lit(end))).alias("year"))
    return wanted.join(manifest.select(*KEY), KEY, "left_anti")


def _megabytes() -> Column:
    return F.coalesce(fixed_point.total("size_mb", 2), F.lit(0.0))


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Per station: number, size, range and list of loaded years.

    The list is short, as it holds a year once.
    """
    return manifest.groupBy("station_key").agg(
        F.count("*").alias("total_years"),
        _megabytes().alias("total_size_mb"),
        F.min("year").alias("start_year"),
        F.max("year").alias("end_year"),
        F.array_sort(F.collect_set("year")).alias("years_loaded"),
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Stations, years and size over all stations."""
    per_station = manifest.groupBy("station_key").agg(
        F.count("*").alias("_years"), *fixed_point.partial("size_mb", "_size"))
    return per_station.agg(
        F.count("*").alias("stations"),
        F.coalesce(F.sum("_years"), F.lit(0)).alias("total_years"),
        F.coalesce(fixed_point.partial_total("_size", 2, merged=True), F.lit(0.0)).alias("total_size_mb"),
    )


def append_range(ranges: DataFrame, new: DataFrame) -> DataFrame:
    """Add loaded ranges (station_key, start, end, loaded_at, records, layers)."""
    return ranges.unionByName(new.select(*ranges.columns))


def track_ranges(ranges: DataFrame) -> DataFrame:
    """Per station: ranges, records, and the hour after the end of the range loaded last."""
    last = F.max(F.struct("loaded_at", "end"))["end"]
    return ranges.groupBy("station_key").agg(
        F.count("*").alias("loaded_ranges"),
        F.sum("records").alias("total_records"),
        (last + F.expr("INTERVAL 1 HOUR")).alias("next_update_from"),
    )


def range_totals(ranges: DataFrame) -> DataFrame:
    """Records over all stations and the number of stations with any range."""
    per_station = ranges.groupBy("station_key").agg(F.sum("records").alias("_r"))
    return per_station.agg(
        F.coalesce(F.sum("_r"), F.lit(0)).alias("total_records_loaded"),
        F.count("*").alias("total_stations_active"),
    )


def complete_stations(ranges: DataFrame, start: int, end: int,
                      marked: DataFrame | None = None) -> DataFrame:
    """Stations whose loaded ranges together hold every hour of the years start..end, and those
    in ``marked`` (station_key), which are complete by an explicit mark.

    A range without a start or an end, or that ends before it starts, holds no hour. Ranges that
    start in the same hour are merged before the shuffle, so a station has a row per hour at most.
    """
    first, last = F.lit(f"{start}-01-01 00:00:00"), F.lit(f"{end}-12-31 23:00:00")
    first, last = first.cast("timestamp"), last.cast("timestamp")
    hour = F.expr("INTERVAL 1 HOUR")
    up = F.date_trunc("hour", F.col("start") + F.expr("INTERVAL '59:59.999999' MINUTE TO SECOND"))
    merged = (
        ranges.where(F.col("start").isNotNull())
        .select("station_key", F.greatest(up, first).alias("_from"),
                      F.date_trunc("hour", "end").alias("_to"))
        .where((F.col("_to") >= F.col("_from")) & (F.col("_from") <= last))
        .groupBy("station_key", "_from").agg(F.max("_to").alias("_to"))
    )
    before = (Window.partitionBy("station_key").orderBy("_from")
              .rowsBetween(Window.unboundedPreceding, -1))
    reached = F.coalesce(F.max("_to").over(before), first - hour)
    covered = (
        merged.withColumn("_hole", F.col("_from") > reached + hour)
        .groupBy("station_key").agg(F.bool_or("_hole").alias("_hole"), F.max("_to").alias("_to"))
        .where(~F.col("_hole") & (F.col("_to") >= last)).select("station_key")
    )
    if marked is None:
        return covered
    return covered.unionByName(marked.select("station_key")).distinct()


def range_status(stations: DataFrame, ranges: DataFrame, start: int, end: int,
                 marked: DataFrame | None = None) -> DataFrame:
    """Every registered station: status, records, number of ranges, complete or not."""
    loaded = ranges.groupBy("station_key").agg(
        F.count("*").alias("_ranges"), F.sum("records").alias("_records"))
    complete = complete_stations(ranges, start, end, marked).withColumn("_complete", F.lit(True))
    joined = (
        stations.select("station_key", F.col("name").alias("station_name"))
        .join(loaded, "station_key", "left").join(complete, "station_key", "left")
    )
    done = F.coalesce(F.col("_complete"), F.lit(False))
    return joined.select(
        "station_key", "station_name",
        F.when(done, "complete").when(F.col("_ranges") > 0, "in_progress")
        .otherwise("unknown").alias("status"),
        F.coalesce("_records", F.lit(0)).alias("total_records"),
        F.coalesce("_ranges", F.lit(0)).alias("n_ranges"),
        done.alias("historical_complete"),
    )


def stations_needing_load(members: DataFrame, ranges: DataFrame, start: int, end: int,
                          marked: DataFrame | None = None) -> DataFrame:
    """Group members without a complete history."""
    return members.select("station_key").join(
        complete_stations(ranges, start, end, marked), "station_key", "left_anti")


def ingest_event_summary(events: DataFrame) -> DataFrame:
    """Outcome per station, and a row with a null station for the whole pipeline.

    Counts and sizes of loaded years come from the ``year_loaded`` events; skipped and failed
    years, elapsed seconds and success from ``station_complete``.
    """
    def of(kind: str, value: str) -> str:
        return f"CASE WHEN event_type = '{kind}' THEN {value} END"

    def added(kind: str, column: str) -> Column:
        return F.expr(f"coalesce(sum({of(kind, column)}), 0)")

    def measured(kind: str, column: str) -> Column:
        return F.coalesce(fixed_point.total(of(kind, column), 2), F.lit(0.0))

    return (
        events.where(F.col("event_type").isin("year_loaded", "station_complete"))
        .rollup("station_key").agg(
            F.grouping("station_key").alias("_total"),
            F.expr("count_if(event_type = 'year_loaded')").alias("loaded_years"),
            measured("year_loaded", "file_size_mb").alias("loaded_mb"),
            fixed_point.mean(of("year_loaded", "duration_seconds"), 2).alias("seconds_per_year"),
            added("station_complete", "completed_years").alias("completed_years"),
            added("station_complete", "skipped_years").alias("skipped_years"),
            added("station_complete", "failed_years").alias("failed_years"),
            measured("station_complete", "duration_seconds").alias("elapsed_seconds"),
            (added("station_complete", "failed_years") == 0).alias("success"),
        )
        .where((F.col("_total") == 1) | F.col("station_key").isNotNull())
        .select((F.col("_total") == 1).alias("is_total"), "station_key", "loaded_years", "loaded_mb",
                "seconds_per_year", "completed_years", "skipped_years", "failed_years",
                "elapsed_seconds", "success")
    )


def pipeline_runs(events: DataFrame) -> DataFrame:
    """One row per finished pipeline run with its mean seconds per loaded year."""
    per_year = F.when(F.col("total_years_loaded") > 0,
                      F.round(F.col("duration_seconds") / F.col("total_years_loaded"), 2))
    return events.where(F.col("event_type") == "pipeline_complete").select(
        "timestamp", "total_stations", "successful_stations", "failed_stations",
        "total_years_loaded", "total_years_skipped", "duration_seconds",
        per_year.alias("seconds_per_year"), "success")
