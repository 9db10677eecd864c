"""Ingest events, manifest documents and the manifest table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake.operators import manifest
from gaugelake.schema import INGEST_EVENT, MANIFEST_DOCUMENT, YEAR_ENTRY
from gaugelake.sources.files import exists
from gaugelake.sources.raw import canonical_id

MANIFEST = T.StructType([T.StructField("station_key", T.StringType()), *YEAR_ENTRY.fields])


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Ingest events, one JSON object per line."""
    return spark.read.schema(INGEST_EVENT).json(path)


def read_manifests(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Manifest documents; the entries of ``years_loaded`` stay text until they are normalised."""
    return spark.read.schema(MANIFEST_DOCUMENT).option("multiLine", multiline).json(path)


def landed_years(spark: SparkSession, raw_root: str, stations: DataFrame) -> DataFrame:
    """Manifest entries for the raw files under ``raw_root``, from their directory entries alone."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(raw_root)
        .select(
            canonical_id(F.regexp_extract("path", "station_id=([^/]+)/", 1)).alias("id"),
            F.regexp_extract("path", "year=([0-9]+)/", 1).cast("int").alias("year"),
            "modificationTime", "length",
            F.regexp_extract("path", "^(.*/year=[0-9]+)/", 1).alias("file_path"))
    )
    entries = files.groupBy("id", "year", "file_path").agg(
        F.max("modificationTime").alias("at"), F.sum("length").alias("bytes"))
    return entries.join(stations.select("station_key", "id"), "id").select(
        "station_key", "year",
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("loaded_at"), "file_path",
        F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 2).alias("size_mb"))


def read_manifest_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(path)


def record_loaded(loaded: DataFrame, path: str) -> None:
    """Insert-if-absent into the stored manifest; repeating the call adds nothing."""
    new = manifest.first_entries(loaded.select(*MANIFEST.fieldNames()))
    if exists(loaded.sparkSession, path):
        known = read_manifest_table(loaded.sparkSession, path).select(*manifest.KEY)
        new = new.join(known, manifest.KEY, "left_anti")
    new.select(*MANIFEST.fieldNames()).write.mode("append").parquet(path)
