"""The three jobs of the pipeline; each can be run again on its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.operators import coverage, queries, silver
from gaugelake.schema import SILVER_MAPPING
from gaugelake.session import configure
from gaugelake.sources import landing, raw, tables

# order of the copies of an hour that came in several documents
REFINED_ORDER = ["_ingestion_timestamp", "_source_file", "_coverage", "_pos"]
SILVER_CODES = [c for c in SILVER_MAPPING
                if c not in ("timestamp", "location_id", "latitude", "longitude")]


def refine(spark: SparkSession, raw_root: str, refined_path: str, station_id: str | None = None,
           year: int | None = None, multiline: bool | None = None,
           names: list[str] | None = None, layout: list[str] = tables.BY_YEAR,
           quarantine: str | None = None, index: str | None = None, glob: str = raw.RAW_FILES) -> list[str]:
    """Raw documents -> refined table; gives the parameter names that became columns.

    With a landing index (``landing.update`` brings it up to date first, parsing new files only) every document is parsed once, and only
    directories with a file of the year. Without one, files of a document per line and pretty-printed ones are told apart by reading them
    once more, unless ``multiline`` says which they are, and without ``names`` the vocabulary is read from the
    documents first. Documents that do not parse are written to ``quarantine``; if it is not given
    they are an error, raised after the others are written.
    """
    configure(spark)
    if index is not None:
        landing.update(spark, raw_root, index, glob)
        files = landing.reaching(landing.scan(spark, index), station_id, year)
        names = names or landing.parameter_names(files)
        docs = landing.read(spark, raw_root, files, glob)
    elif multiline is None:
        docs = raw.read_either_form(spark, raw_root, station_id, glob)
    else:
        docs = raw.read_raw_coverage(spark, raw_root, station_id, multiline=multiline, keep_corrupt=True, glob=glob)
    if year is not None:
        # a document lies under the year it starts in and may run on into later ones; a partition
        # is replaced as a whole, so every document that could reach this year is read
        docs = docs.where(F.col("year") <= year)
    names = names or coverage.parameter_names(raw.isolate_bad_files(docs)[0])
    docs, counts = raw.counted(docs)
    good, bad, _ = raw.isolate_bad_files(docs)
    rows = coverage.flatten_wide(good, names).drop("station_id", "year")
    if year is not None:
        rows = rows.where(F.year("timestamp") == year)
    tables.write_refined(coverage.add_lineage(rows), refined_path, layout, station_id)
    if quarantine is None:
        raw.refuse_losses(counts, docs)
    else:
        bad.write.mode("overwrite").json(quarantine)
    return names


def clean(spark: SparkSession, refined_path: str, silver_path: str,
          names: list[str] = SILVER_CODES, station_id: str | None = None, year: int | None = None,
          sentinel_first: bool = False, layout: list[str] = tables.BY_YEAR, min_score: float | None = None) -> DataFrame | None:
    """Refined table -> silver table.

    With ``min_score`` the rows below it go to the quarantine of the silver table (``tables.scan_quarantine``) instead, in the same pass,
    and the result is the gate: per station the rows that went either way and whether its percentages pass, from a few columns of
    the files just written. A single station cannot be gated, as the gate replaces whole directories.
    """
    configure(spark)
    refined = tables.scan_refined(spark, refined_path, names, station_id, year, layout)
    if min_score is None and station_id is not None:
        tables.replace_stations(silver.to_silver(refined, REFINED_ORDER, sentinel_first), silver_path, layout)
        return None
    if min_score is not None and station_id is not None and "station_id" not in layout:
        raise ValueError("name no station: the gate replaces whole directories")
    result = tables.silver_to_write(refined, REFINED_ORDER, layout, sentinel_first)
    if min_score is None:
        tables.write_silver(result, silver_path, layout, placed=True)
        return None
    tables.write_routed(result, silver.is_good(min_score), silver_path, layout, placed=True)
    both = tables.scan_silver(spark, silver_path, layout).unionByName(tables.scan_quarantine(spark, silver_path, layout))
    return silver.quality_gate(both, min_score)


def report(silver_table: DataFrame, year: int) -> dict[str, DataFrame]:
    """The queries of the station report over one table.

    Persist the table first if several of them will be run and its columns fit the cluster.
    """
    return {
        "station_comparison": queries.station_comparison(silver_table),
        "monthly_averages": queries.monthly_averages(silver_table, 12),
        "month_station_combinations": queries.month_station_combinations(silver_table),
        "hottest_coldest": queries.hottest_coldest(silver_table),
        "rainfall_comparison": queries.rainfall_comparison(silver_table),
        "quality_comparison": queries.quality_comparison(silver_table),
        "wind_statistics": queries.wind_statistics(silver_table),
        "seasonal_temperatures": queries.seasonal_temperatures(silver_table, year),
        "station_stats": queries.station_stats(silver_table),
        "temperature_distribution": queries.temperature_distribution(silver_table),
        "correlation_pairs": queries.correlation_pairs(silver_table),
        "rainiest_days": queries.rainiest_days(silver_table),
        "null_profile": queries.null_profile(silver_table),
        "temperature_stats": queries.temperature_stats(silver_table),
        "correlation_matrix": queries.correlation_matrix(silver_table),
        "windiest_hours": queries.windiest_hours(silver_table),
    }
