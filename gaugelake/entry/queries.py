"""One query per operator over the star-schema tables, each on whole tables.

Analytical queries read the silver table written by Spark; the document operators read coverage
documents packed from the same observations. Lists and dates are given as text, and times without
a zone, so that the results compare with those of another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake import derive
from gaugelake.entry.workspace import Workspace, open_workspace
from gaugelake.functions import fixed_point
from gaugelake.operators import coverage, gaps, gold, manifest, planning, queries, silver
from gaugelake.plans import jobs, summaries
from gaugelake.plans.jobs import SILVER_CODES
from gaugelake.schema import (
    CATALOG_DOCUMENT,
    LOOKBACK_HOURS,
    MANIFEST_DOCUMENT,
    MAPPED_COLUMNS,
    MAX_GAP_DAYS,
    REGISTRY_DOCUMENT,
    SILVER,
)
from gaugelake.sources import files, landing, manifests, raw, registry, snapshots, tables
from gaugelake.streaming import incremental

STATION = "0-20000-0-06204"
OTHER_STATION = "0-20000-0-06207"
SEASON_YEAR = 1998
DAY = "2000-09-15"
UNTIL, DAYS = "2000-06-30", 7
SINCE = "2000-10-01"
FIRST_YEAR, LAST_YEAR = 1995, 2001
RANGE = ("1995-01-01 00:00:00", "2001-12-31 23:59:59")
NOW = "2002-01-01 00:00:00"
BATCH_SIZE = 8
DROPS = {"A": "2025-01-01T00:00:00Z", "N": "2025-01-02T00:00:00Z", "R": "2025-01-03T00:00:00Z"}

_REGISTERED: dict[str, Callable[[Workspace], DataFrame]] = {}
QUALITY = ["quality_score", "quality_flags", "has_missing_values", "has_outliers"]
LINE_KEY = ["station_id", "timestamp", *derive.LINE_ORDER]


def _register(build: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    _REGISTERED[build.__name__] = build
    return build


def _portable(df: DataFrame) -> DataFrame:
    """Times without zone, dates and lists as text."""
    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        return c.alias(f.name)
    return df.select(*[column(f) for f in df.schema])


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runnable(build):
        return lambda spark, sf_dir: _portable(build(open_workspace(spark, sf_dir)))
    return {name: runnable(build) for name, build in _REGISTERED.items()}


def _times(data: str = "data"):
    return F.aggregate(
        F.col(f"{data}.coverages"), F.lit(0),
        lambda n, c: n + F.size(c["domain"]["axes"]["t"]["values"])).cast("bigint")


# --- Sources, sinks, raw to refined ------------------------------------------

@_register
def read_raw_coverage(w: Workspace) -> DataFrame:
    return w.raw.groupBy(
        "station_id", "year", F.col("data.type").alias("type"),
        F.col("_metadata.ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("_metadata.source_api").alias("source_api"),
    ).agg(F.sum(_times()).alias("n_times"))


@_register
def split_coverages(w: Workspace) -> DataFrame:
    split = coverage.split_coverages(derive.responses(w.observations))
    return split.groupBy(
        "station_id", raw.first_year().alias("year"),
        F.size("data.coverages").cast("bigint").alias("coverages_per_document"),
        F.col("data.domainType").alias("domain_type"),
        F.variant_get("data.parameters", "$.RH.unit", "string").alias("rain_unit"),
    ).agg(F.sum(_times()).alias("n_times"))


@_register
def land_raw(w: Workspace) -> DataFrame:
    path = w.written("landed", lambda p: raw.land_raw(raw.with_metadata(
        coverage.split_coverages(derive.responses(w.observations)), w.stations,
        derive.INGESTED_AT, derive.SOURCE_API, derive.COLLECTION, requested=10, observed=w.observed), p, placed=True))
    return raw.read_raw_coverage(w.spark, path).groupBy(
        "station_id", "year",
        F.col("_metadata.station_id").alias("metadata_station_id"),
        F.col("_metadata.station_name").alias("station_name"),
        F.col("_metadata.api_collection").alias("api_collection"),
        F.col("_metadata.ingestion_method").alias("ingestion_method"),
    ).agg(F.sum(_times()).alias("n_times"))


@_register
def atomic_replace(w: Workspace) -> DataFrame:
    def write(path: str) -> None:
        rows = w.silver.select("station_id", "year", "timestamp", "temperature_celsius")
        table = snapshots.Snapshots(w.spark, path, ["year"])
        table.replace(files.rebalanced(rows, ["year"]))
        # one year again with other values, twice: the other years stay and nothing is doubled
        again = rows.where(F.col("year") == 1997).withColumn(
            "temperature_celsius", F.col("temperature_celsius") + 100.0)
        for _ in range(2):
            table.replace(files.rebalanced(again, ["year"]))
        # a job that is cut off before it publishes changes nothing
        table.stage(again.withColumn("temperature_celsius", F.lit(0.0)))
    path = w.written("replaced", write)
    table = snapshots.Snapshots(w.spark, path, ["year"]).read(T.StructType.fromDDL(
        "timestamp timestamp, temperature_celsius double, station_id string, year int"))
    return table.groupBy("station_id", "year").agg(
        F.count("*").alias("hours"),
        fixed_point.total("temperature_celsius", 1).alias("total_temp"))


@_register
def flatten_coverage(w: Workspace) -> DataFrame:
    rows = coverage.flatten_coverage(derive.responses(w.observations))
    return coverage.widen_params(rows, derive.PARAMETERS).drop("_coverage", "_pos")


@_register
def widen_params(w: Workspace) -> DataFrame:
    rows = coverage.flatten_coverage(w.raw)
    return coverage.widen_params(rows, coverage.parameter_names(w.raw)).select(
        "location_id", "timestamp", *derive.PARAMETERS)


@_register
def add_lineage(w: Workspace) -> DataFrame:
    rows = coverage.add_lineage(coverage.flatten_coverage(w.raw))
    return rows.select(
        "location_id", "timestamp", F.try_element_at("params", F.lit("T")).alias("T"),
        "_ingestion_timestamp", "_source_api",
        F.regexp_extract("_source_file", "station_id=([^/]+)/", 1).alias("source_station"),
        F.regexp_extract("_source_file", "year=([0-9]+)/", 1).alias("source_year"))


@_register
def profile_raw(w: Workspace) -> DataFrame:
    # the number of documents depends on how Spark split the input, so it is not compared
    return coverage.profile_raw(w.raw, ["station_id", "year"]).drop("n_coverages")


@_register
def count_data_points(w: Workspace) -> DataFrame:
    return coverage.count_data_points(w.raw, ["station_id"])


def _partition_summary(table: DataFrame, temperature: str) -> DataFrame:
    month = "month" if "month" in table.columns else F.month("timestamp").alias("month")
    return table.groupBy("station_id", "year", month).agg(
        F.count("*").alias("n_rows"), F.min("timestamp").alias("first_t"),
        F.max("timestamp").alias("last_t"),
        fixed_point.total(temperature, 1).alias("total_temp"))


@_register
def write_refined(w: Workspace) -> DataFrame:
    return _partition_summary(w.refined, "T")


@_register
def write_silver(w: Workspace) -> DataFrame:
    return _partition_summary(w.silver, "temperature_celsius")


@_register
def scan_refined(w: Workspace) -> DataFrame:
    return w.refined.select("location_id", "timestamp", "T", "U", "RH", "FF", "_source_api")


@_register
def scan_silver(w: Workspace) -> DataFrame:
    return w.silver.select(*MAPPED_COLUMNS, *QUALITY)


@_register
def count_stations(w: Workspace) -> DataFrame:
    return tables.count_stations(w.silver)


@_register
def reconcile_union(w: Workspace) -> DataFrame:
    columns = ["station_id", "timestamp", "cloud_cover_octas", "visibility_m", "radiation_index"]
    all_rows = w.silver.select(*columns, "year")
    octas = F.col("cloud_cover_octas")
    early = all_rows.where("year < 1997").withColumn(
        "cloud_cover_octas", F.when(octas == 9, F.lit("obscured")).otherwise(octas.cast("string")))
    middle = all_rows.where("year BETWEEN 1997 AND 1998").withColumn(
        "visibility_m", F.col("visibility_m").cast("string")).withColumn(
        "cloud_cover_octas", octas.cast("int"))
    late = all_rows.where("year > 1998").drop("radiation_index")
    parts = [p.drop("year") for p in (early, middle, late)]
    return tables.reconcile_union(parts).select(*columns)


CSV_COLUMNS = ["temperature_celsius", "rainfall_mm", "humidity_percent"]


@_register
def export_csv(w: Workspace) -> DataFrame:
    path = w.written("csv", lambda p: tables.export_csv(w.silver, p, STATION, CSV_COLUMNS))
    return w.spark.read.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").schema(
        "timestamp timestamp, temperature_celsius double, rainfall_mm double,"
        " humidity_percent double").csv(path)


@_register
def isolate_bad_files(w: Workspace) -> DataFrame:
    broken = (F.col("station_id") == STATION) | (F.col("year") == 1998)

    def write(path: str) -> None:
        text = F.to_json(F.struct("_metadata", "data"))
        (w.raw.select("station_id", "year", F.when(
            broken, F.substr(text, F.lit(1), F.length(text) - 10)).otherwise(text).alias("value"))
         .write.mode("overwrite").option("compression", "gzip").partitionBy("station_id", "year").text(path))

    path = w.written("with_broken", write)
    docs = raw.read_raw_coverage(w.spark, path, keep_corrupt=True, glob="*.txt.gz")
    good, _, outcome = raw.isolate_bad_files(docs)
    loaded = good.groupBy("station_id", "year").agg(F.sum(_times()).alias("n_times"))
    return outcome.groupBy("station_id", "year").agg(
        (F.sum("bad_documents") > 0).alias("quarantined"),
    ).join(loaded, ["station_id", "year"], "left").select(
        "station_id", "year", "quarantined", F.coalesce("n_times", F.lit(0)).alias("loaded_rows"))


def _mixed_drop(w: Workspace) -> str:
    """Raw documents as others leave them: one station pretty-printed in files of its own, the rest a document per line, one year of a
    station cut off."""
    def write(path: str) -> None:
        text = F.struct("_metadata", "data")
        pretty = F.col("station_id") == OTHER_STATION
        cut = (F.col("station_id") == STATION) & (F.col("year") == 1998)
        whole = w.raw.select("station_id", "year", F.when(pretty, F.to_json(text, {"pretty": "true"})).otherwise(
            F.to_json(text)).alias("value"), pretty.alias("_pretty"), cut.alias("_cut"))
        shown = whole.select("station_id", "year", "_pretty", F.when(
            F.col("_cut"), F.substr("value", F.lit(1), F.length("value") - 10)).otherwise(F.col("value")).alias("value"))
        for each, most in ((True, 1), (False, 0)):
            (shown.where(F.col("_pretty") == each).drop("_pretty").write.mode("append")
             .option("maxRecordsPerFile", most).option("compression", "gzip").partitionBy("station_id", "year").text(path))
    return w.written("mixed", write)


@_register
def landing_index(w: Workspace) -> DataFrame:
    """What the index of a mixed drop says of each station and year."""
    path = w.written("mixed_index", lambda p: landing.update(w.spark, _mixed_drop(w), p, "*.txt.gz"))
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_list("names"))))
    return landing.scan(w.spark, path).groupBy("station_id", "year", "form").agg(
        (F.sum("bad_documents") > 0).alias("has_bad"), F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"), F.when(F.size(names) > 0, names).alias("names"))


@_register
def refine_from_index(w: Workspace) -> DataFrame:
    """A mixed drop, refined with the index; what does not parse goes to the quarantine."""
    path = w.written("mixed_refined", lambda p: jobs.refine(
        w.spark, _mixed_drop(w), p, index=f"{p}_index", quarantine=f"{p}_bad", glob="*.txt.gz"))
    return _partition_summary(tables.scan_refined(w.spark, path, derive.PARAMETERS), "T")


# --- Silver ------------------------------------------------------------------

@_register
def map_silver_schema(w: Workspace) -> DataFrame:
    return silver.map_silver_schema(w.observations)


@_register
def enforce_types(w: Workspace) -> DataFrame:
    # as other writers leave them: codes as text, some of it no number
    drifted = w.mapped.withColumns({
        "weather_code": F.coalesce(F.col("weather_code").cast("string"), F.lit("n/a")),
        "visibility_m": F.col("visibility_m").cast("int"),
    })
    return silver.enforce_types(drifted)


@_register
def flag_missing(w: Workspace) -> DataFrame:
    return silver.flag_missing(w.mapped).select(*LINE_KEY, "has_missing_values")


@_register
def flag_outliers(w: Workspace) -> DataFrame:
    both = silver.flag_outliers(w.mapped).withColumnRenamed("has_outliers", "as_read")
    return silver.flag_outliers(both, sentinel_first=True).select(
        *LINE_KEY, "as_read", F.col("has_outliers").alias("trace_first"))


@_register
def quality_flags(w: Workspace) -> DataFrame:
    return silver.quality_flags(w.mapped).select(*LINE_KEY, "quality_flags")


@_register
def outlier_flags(w: Workspace) -> DataFrame:
    return silver.outlier_flags(w.mapped).select(*LINE_KEY, "outlier_flags")


@_register
def quality_score(w: Workspace) -> DataFrame:
    return silver.quality_score(w.mapped).select(*LINE_KEY, "quality_score")


@_register
def rain_sentinel(w: Workspace) -> DataFrame:
    return silver.rain_sentinel(w.mapped).select(*LINE_KEY, "rainfall_mm")


@_register
def dedup_first(w: Workspace) -> DataFrame:
    return silver.dedup_first(w.mapped, derive.LINE_ORDER)


@_register
def stamp_silver(w: Workspace) -> DataFrame:
    stamped = silver.stamp_silver(silver.apply_quality(w.mapped))
    return stamped.groupBy("_bronze_to_silver_version").agg(
        F.count("*").alias("n_rows"), F.count("_processed_timestamp").alias("stamped_rows"))


@_register
def sort_time(w: Workspace) -> DataFrame:
    return silver.sort_time(w.silver.select("station_id", "timestamp", "temperature_celsius"))


@_register
def quality_report(w: Workspace) -> DataFrame:
    return silver.quality_report(
        w.observations, silver.to_silver(w.observations, derive.LINE_ORDER, stamped=False))


@_register
def quality_gate(w: Workspace) -> DataFrame:
    return silver.quality_gate(w.silver)


@_register
def quality_gate_routed(w: Workspace) -> DataFrame:
    """What the gated job wrote: rows of the silver table and of its quarantine, per station and year."""
    path = w.written("gated", lambda p: tables.write_routed(
        tables.silver_to_write(w.observations, derive.LINE_ORDER), silver.is_good(), p, placed=True))

    def counted(table: DataFrame, name: str) -> DataFrame:
        return table.groupBy("station_id", "year").agg(
            F.count("*").alias("n_rows"), fixed_point.mean("quality_score", 3).alias("avg_quality"),
            fixed_point.total("temperature_celsius", 1).alias("total_temp")).withColumn("written_to", F.lit(name))

    return counted(tables.scan_silver(w.spark, path), "silver").unionByName(
        counted(tables.scan_quarantine(w.spark, path), "quarantine"))


# --- Analytical queries ------------------------------------------------------

@_register
def station_comparison(w: Workspace) -> DataFrame:
    return queries.station_comparison(w.silver)


@_register
def monthly_averages(w: Workspace) -> DataFrame:
    return queries.monthly_averages(w.silver, 12)


@_register
def month_station_combinations(w: Workspace) -> DataFrame:
    return queries.month_station_combinations(w.silver)


@_register
def hottest_coldest(w: Workspace) -> DataFrame:
    return queries.hottest_coldest(w.silver)


@_register
def rainfall_comparison(w: Workspace) -> DataFrame:
    return queries.rainfall_comparison(w.silver)


@_register
def quality_comparison(w: Workspace) -> DataFrame:
    return queries.quality_comparison(w.silver)


@_register
def wind_statistics(w: Workspace) -> DataFrame:
    return queries.wind_statistics(w.silver)


@_register
def seasonal_temperatures(w: Workspace) -> DataFrame:
    return queries.seasonal_temperatures(w.silver, SEASON_YEAR)


@_register
def station_stats_lazy(w: Workspace) -> DataFrame:
    return queries.station_stats(w.silver)


@_register
def temperature_distribution(w: Workspace) -> DataFrame:
    return queries.temperature_distribution(w.silver)


@_register
def temperature_distribution_linear(w: Workspace) -> DataFrame:
    return queries.temperature_distribution(w.silver, "linear", digits=3)


@_register
def correlation_pairs(w: Workspace) -> DataFrame:
    return queries.correlation_pairs(w.silver)


@_register
def rainiest_days(w: Workspace) -> DataFrame:
    return queries.rainiest_days(w.silver)


@_register
def null_profile(w: Workspace) -> DataFrame:
    return queries.null_profile(w.silver, [f.name for f in SILVER])


@_register
def temperature_stats_full(w: Workspace) -> DataFrame:
    return queries.temperature_stats(w.silver)


@_register
def correlation_matrix(w: Workspace) -> DataFrame:
    return queries.correlation_matrix(w.silver)


@_register
def windiest_hours(w: Workspace) -> DataFrame:
    return queries.windiest_hours(w.silver)


@_register
def coverage_span(w: Workspace) -> DataFrame:
    return queries.coverage_span(w.silver)


@_register
def hour_slice(w: Workspace) -> DataFrame:
    return queries.hour_slice(w.silver, STATION, DAY).select(*MAPPED_COLUMNS, *QUALITY)


@_register
def recent_window(w: Workspace) -> DataFrame:
    return queries.recent_window(w.silver, OTHER_STATION, UNTIL, DAYS)


@_register
def temps_since(w: Workspace) -> DataFrame:
    return queries.temps_since(w.silver, w.stations, SINCE)


# --- Registry, manifests, plans ----------------------------------------------

def _parsed(docs: DataFrame, schema: T.StructType) -> DataFrame:
    return docs.select(F.from_json("value", schema).alias("d")).select("d.*")


def _registry(w: Workspace) -> DataFrame:
    return _parsed(derive.registry_documents(w.stations), REGISTRY_DOCUMENT)


@_register
def station_dim(w: Workspace) -> DataFrame:
    return registry.station_dim(_registry(w)).withColumn("active", F.col("active").cast("string"))


@_register
def station_catalog(w: Workspace) -> DataFrame:
    return registry.station_catalog(_parsed(derive.catalog_documents(w.stations), CATALOG_DOCUMENT))


@_register
def active_stations(w: Workspace) -> DataFrame:
    return registry.active_stations(registry.station_dim(_registry(w))).select(
        "station_key", "id", "name", "active")


@_register
def station_group(w: Workspace) -> DataFrame:
    documents = _registry(w)
    return registry.station_group(
        registry.station_dim(documents), registry.group_members(documents), "machinery",
    ).select("station_key", "id", "type", "region")


STATUSES = ["F", "O", "P"]


@_register
def normalize_manifest(w: Workspace) -> DataFrame:
    return manifest.normalize_manifest(
        _parsed(derive.manifest_documents(w.loads, STATUSES), MANIFEST_DOCUMENT))


@_register
def mark_loaded(w: Workspace) -> DataFrame:
    return manifest.mark_loaded(
        derive.year_manifest(w.loads, ["F"]), derive.year_manifest(w.loads, ["O", "P"]))


def _year_plan(w: Workspace) -> DataFrame:
    return planning.backfill_plan(w.stations, *RANGE, "year").withColumn("year", F.year("start"))


@_register
def skip_loaded(w: Workspace) -> DataFrame:
    return manifest.skip_loaded(_year_plan(w), derive.year_manifest(w.loads, ["F"]))


@_register
def missing_years(w: Workspace) -> DataFrame:
    return manifest.missing_years(
        w.stations, derive.year_manifest(w.loads, ["F", "O"]), FIRST_YEAR, LAST_YEAR)


@_register
def manifest_summary(w: Workspace) -> DataFrame:
    return manifest.manifest_summary(derive.year_manifest(w.loads, STATUSES))


@_register
def manifest_totals(w: Workspace) -> DataFrame:
    return manifest.manifest_totals(derive.year_manifest(w.loads, STATUSES))


def _marked(w: Workspace) -> DataFrame:
    """Stations marked as complete: those with an urgent load that ended well."""
    return w.loads.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(
        "station_key").distinct()


RANGE_COLUMNS = ["station_key", "start", "end", "loaded_at", "records", "layers"]


def _ranges(w: Workspace, statuses: list[str]) -> DataFrame:
    layers = F.array(F.lit("bronze_raw"), F.lit("bronze_refined"), F.lit("silver"))
    return w.loads.where(F.col("o_orderstatus").isin(statuses)).withColumn(
        "layers", layers).select(*RANGE_COLUMNS)


@_register
def track_ranges(w: Workspace) -> DataFrame:
    return manifest.track_ranges(manifest.append_range(_ranges(w, ["F"]), _ranges(w, ["O", "P"])))


@_register
def range_totals(w: Workspace) -> DataFrame:
    return manifest.range_totals(_ranges(w, STATUSES))


@_register
def range_status(w: Workspace) -> DataFrame:
    return manifest.range_status(w.stations, _ranges(w, STATUSES), FIRST_YEAR, LAST_YEAR,
        _marked(w))


@_register
def stations_needing_load(w: Workspace) -> DataFrame:
    members = registry.group_members(_registry(w)).where("`group` = 'machinery'")
    return manifest.stations_needing_load(members, _ranges(w, STATUSES), FIRST_YEAR, LAST_YEAR,
        _marked(w))


@_register
def backfill_plan(w: Workspace) -> DataFrame:
    plans = {
        "year": planning.backfill_plan(w.stations, *RANGE, "year"),
        "month": planning.preset_plan(w.stations, "full", "month"),
        "months": planning.backfill_plan(w.stations, "2000-01-01", "2001-12-31 23:59:59", "months", 5),
        "days30": planning.backfill_plan(w.stations, "2000-01-01", "2001-12-31 23:59:59", "days30", 3),
        "hour": planning.backfill_plan(w.stations, "2000-02-29", "2000-02-29 23:59:59", "hour"),
    }
    return derive.union_all([
        plan.select(F.lit(name).alias("granularity"), *plan.columns) for name, plan in plans.items()])


@_register
def plan_cost(w: Workspace) -> DataFrame:
    return planning.plan_cost(w.stations, *RANGE, BATCH_SIZE)


@_register
def plan_cost_totals(w: Workspace) -> DataFrame:
    return planning.cost_totals(planning.plan_cost(w.stations, *RANGE, BATCH_SIZE))


@_register
def ingest_event_summary(w: Workspace) -> DataFrame:
    path = w.written("events", lambda p: derive.event_lines(w.loads).write.mode("overwrite").text(p))
    return manifest.ingest_event_summary(manifests.read_events(w.spark, path))


@_register
def detect_gaps(w: Workspace) -> DataFrame:
    return gaps.detect_gaps(w.silver)


@_register
def detect_gaps_in_range(w: Workspace) -> DataFrame:
    return gaps.detect_gaps(w.silver, start=SINCE, end=NOW)


@_register
def chunk_status(w: Workspace) -> DataFrame:
    month = F.date_format("start", "yyyy-MM").alias("month")
    done = w.loads.where("o_orderstatus = 'F'").select("station_key", month, "records")
    failed = w.loads.where("o_orderstatus = 'P'").select(
        "station_key", month, F.col("loaded_at").alias("failed_at"),
        F.col("o_orderpriority").alias("error"))
    return planning.chunk_status(
        planning.backfill_plan(w.stations, *RANGE, "month"), done, failed)


@_register
def completeness(w: Workspace) -> DataFrame:
    return gaps.completeness(w.silver)


# --- Gold and incremental ----------------------------------------------------

@_register
def gold_daily_summary(w: Workspace) -> DataFrame:
    return gold.daily_from_states(w.gold("daily"))


@_register
def gold_hourly_station(w: Workspace) -> DataFrame:
    return gold.hourly_station(w.gold("hourly"), STATION)


@_register
def gold_monthly_comparison(w: Workspace) -> DataFrame:
    return gold.monthly_from_states(w.gold("daily"), w.stations)


@_register
def gold_monthly_by_region(w: Workspace) -> DataFrame:
    return gold.regions_from_states(w.gold("daily"), w.stations)


@_register
def gold_extreme_events(w: Workspace) -> DataFrame:
    return w.gold("events").drop("date", "year")


@_register
def wettest_days(w: Workspace) -> DataFrame:
    return gold.wettest_from_states(w.gold("daily"), w.stations)


@_register
def gold_refresh(w: Workspace) -> DataFrame:
    """A day is corrected in the silver table, and the summaries follow by that day alone."""
    def correct(path: str) -> None:
        silver_path, gold_path = f"{path}/silver", f"{path}/gold"
        tables.write_silver(w.silver, silver_path, placed=True)  # in its ranges as it is read
        summaries.build(w.spark, silver_path, gold_path)
        corrected = w.silver.where(F.to_date("timestamp") == F.lit(DAY).cast("date")).drop("year").withColumn(
            "temperature_celsius", F.col("temperature_celsius") + 1.5).withColumn("rainfall_mm", F.col("rainfall_mm") + 300.0)
        days = incremental.upsert(corrected, silver_path, keep="last")
        summaries.refresh(w.spark, silver_path, gold_path, days)
    states = summaries.scan(w.spark, f"{w.written('corrected', correct)}/gold", "daily")
    return gold.daily_from_states(states)


@_register
def param_profile(w: Workspace) -> DataFrame:
    return gold.param_profile(w.refined, "core")


@_register
def param_profile_temperature(w: Workspace) -> DataFrame:
    return gold.param_profile(w.refined, "temperature")


@_register
def update_windows(w: Workspace) -> DataFrame:
    return gaps.update_windows(w.silver, NOW, LOOKBACK_HOURS, MAX_GAP_DAYS)


def _three_drops(w: Workspace, name: str, keep: str) -> DataFrame:
    """Three drops of raw files arrive one after the other, and each is loaded on arrival."""
    def load(path: str) -> None:
        landing, checkpoint = f"{w.root}/{name}_drops", f"{w.root}/{name}_checkpoint"
        for flag, ingested_at in DROPS.items():
            drop = w.observations.where(F.col("l_returnflag") == flag)
            documents = raw.with_metadata(
                coverage.split_coverages(derive.responses(drop)), None, ingested_at,
                derive.SOURCE_API, derive.COLLECTION, requested=10)
            raw.land_raw(documents, landing, replace=False, placed=True)
            incremental.incremental_load(
                w.spark, landing, path, checkpoint, keep=keep,
                order_by=["_ingestion_timestamp", *SILVER_CODES])

    return tables.scan_silver(w.spark, w.written(name, load)).select(*MAPPED_COLUMNS, *QUALITY)


@_register
def incremental_load(w: Workspace) -> DataFrame:
    """The first copy of an hour stays."""
    return _three_drops(w, "incremental", "first")


@_register
def incremental_upsert(w: Workspace) -> DataFrame:
    """A later drop corrects the hours of earlier ones."""
    return _three_drops(w, "upserted", "last")
