"""Refined and silver tables as versions of partitioned Parquet files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake.functions.calendar import with_partition_columns
from gaugelake.functions.fixed_point import present
from gaugelake.operators import silver
from gaugelake.schema import PARTITION_FIELDS, SILVER
from gaugelake.sources.files import exists, rebalanced
from gaugelake.sources.raw import canonical_id
from gaugelake.sources.snapshots import ROUTE, Snapshots

# directories of the stored tables: by year, the files follow the bytes, however many stations there are;
# with the station as a directory, a station and year (or month) should fill a file
BY_YEAR = ["year"]
MONTHLY = ["station_id", "year", "month"]
YEARLY = ["station_id", "year"]


def stored(spark: SparkSession, path: str, layout: list[str], branch: str = "") -> Snapshots:
    """The versions of a table in a layout, where a station's part of a directory can be replaced."""
    return Snapshots(spark, path, layout, None if "station_id" in layout else "station_id", branch)


def _with_directories(df: DataFrame, layout: list[str]) -> DataFrame:
    return with_partition_columns(df).drop(*[c for c in ("year", "month") if c not in layout])


def clustered(df: DataFrame, layout: list[str]) -> DataFrame:
    """Rows with their directory columns, cut into ranges of (directory, station, time) and sorted.

    Neighbouring ranges lie in one file, so its statistics let a query of one station or time skip row groups, and
    a station with most of the rows is written by many tasks.
    """
    order = _order(layout)
    return _with_directories(df, layout).repartitionByRange(*order).sortWithinPartitions(*order)


def _order(layout: list[str]) -> list[str]:
    return [*layout, *[c for c in ("station_id", "timestamp") if c not in layout]]


def silver_to_write(refined: DataFrame, order_by: list[str], layout: list[str] = BY_YEAR, sentinel_first: bool = False) -> DataFrame:
    """Silver rows with their directory columns, in the ranges of ``clustered`` already, to be written with ``placed``.

    The copies of an hour fall into one range, so the shuffle that places the rows lets them be deduplicated, too.
    """
    order = _order(layout)
    return silver.to_silver(
        refined, order_by, sentinel_first, key=order,
        placed=lambda df: _with_directories(df, layout).repartitionByRange(*order))


def _to_directories(df: DataFrame, layout: list[str], placed: bool) -> DataFrame:
    return df.sortWithinPartitions(*_order(layout)) if placed else clustered(df, layout)


def write_refined(refined: DataFrame, path: str, layout: list[str] = BY_YEAR, station_id: str | None = None) -> None:
    """Refined rows by the directories of their own time, sorted within files; all of them, or those of one station.

    Cutting exact ranges would parse all documents twice, so the rows are gathered by directory only; documents lie by station, and so do the rows.
    """
    rows = _with_directories(refined.withColumn("station_id", F.col("location_id")), layout)
    order = [c for c in ("station_id", "timestamp") if c not in layout]
    table = stored(refined.sparkSession, path, layout)
    if station_id is None or table.within is None:
        table.replace(rebalanced(rows, layout, order))
    else:
        table.replace_values(rebalanced(rows, layout, order))


def write_silver(rows: DataFrame, path: str, layout: list[str] = BY_YEAR, placed: bool = False) -> None:
    """Replace the directories that occur in ``rows``; ``placed`` if they come from ``silver_to_write`` or a table that was written so."""
    stored(rows.sparkSession, path, layout).replace(_to_directories(rows, layout, placed))


QUARANTINE = "quarantine"


def write_routed(silver_rows: DataFrame, good: Column, path: str, layout: list[str] = BY_YEAR, placed: bool = False) -> None:
    """Write the good rows to the silver table and the others to its quarantine, in one pass over ``silver_rows``.

    One job writes the files of both, a directory each; then two versions name them. A directory (year) that occurs is
    replaced in both tables, so a row that has become good leaves the quarantine. ``placed`` rows come from ``silver_to_write``.
    """
    spark = silver_rows.sparkSession
    routed = silver_rows.withColumn(ROUTE, F.when(good, "good").otherwise("bad"))
    order = [ROUTE, *_order(layout)]
    rows = routed if placed else _with_directories(routed, layout).repartitionByRange(*order)
    rows = rows.sortWithinPartitions(*order)
    table, quarantine = stored(spark, path, layout), stored(spark, path, layout, QUARANTINE)
    commit = table.stage(rows)
    ways = {QUARANTINE: f"{commit}/{ROUTE}=bad", "": f"{commit}/{ROUTE}=good"}
    parts = sorted({part for way in ways.values() for part in table._parts(way)})
    # the quarantine first: a reader between the two finds a row in both rather than in none
    quarantine.replace_staged(ways[QUARANTINE], parts)
    table.replace_staged(ways[""], parts)


def scan_quarantine(spark: SparkSession, path: str, layout: list[str] = BY_YEAR) -> DataFrame:
    """The rows that ``write_routed`` kept out of the silver table at ``path``; none if it never ran."""
    return stored(spark, path, layout, QUARANTINE).read(silver_schema(layout))


def replace_stations(rows: DataFrame, path: str, layout: list[str] = BY_YEAR) -> None:
    """Replace what ``rows`` has of each station and directory; other stations of the directory stay."""
    table = stored(rows.sparkSession, path, layout)
    if table.within is None:
        table.replace(clustered(rows, layout))
    else:
        table.replace_values(clustered(rows, layout), arranged=lambda df: clustered(df, layout))


def _read(spark: SparkSession, path: str, layout: list[str], schema: T.StructType) -> DataFrame:
    """The last version of a table, or the files of one that has no versions."""
    table = stored(spark, path, layout)
    return table.read(schema) if table.version() else spark.read.schema(schema).parquet(path)


def scan_refined(spark: SparkSession, path: str, params: list[str],
                 station_id: str | None = None, year: int | None = None,
                 layout: list[str] = BY_YEAR, with_params: bool = True) -> DataFrame:
    """The refined table, of one station and year if given, with one column per parameter."""
    fields = [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("_coverage", T.IntegerType()),
        T.StructField("_pos", T.IntegerType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingestion_timestamp", T.StringType()),
        T.StructField("_source_api", T.StringType()),
        *[T.StructField(p, T.DoubleType()) for p in params],
        T.StructField("station_id", T.StringType()),
        *[f for f in PARTITION_FIELDS if f.name in layout],
    ]
    table = _read(spark, path, layout, T.StructType(fields))
    if station_id is not None:
        table = table.where(F.col("station_id") == station_id)
    if year is not None:
        table = table.where(F.col("year") == year)
    return table


def scan_silver(spark: SparkSession, path: str, layout: list[str] = BY_YEAR) -> DataFrame:
    """The silver table with its declared schema, never an inferred one."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no silver table at {path}")
    return _read(spark, path, layout, silver_schema(layout))


def silver_schema(layout: list[str]) -> T.StructType:
    return T.StructType([*SILVER.fields, *[f for f in PARTITION_FIELDS if f.name in layout]])


def scan_foreign_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver files of another writer: times in nanoseconds, all-null columns without a type, NaN for no value.

    Sets ``spark.sql.legacy.parquet.nanosAsLong`` on the session, which only concerns columns that
    Spark cannot read otherwise.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    times = [f.name for f in SILVER if isinstance(f.dataType, T.TimestampType)]
    stored = T.StructType([
        T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in SILVER])
    table = spark.read.schema(stored).option("recursiveFileLookup", True).parquet(path)

    def column(field: T.StructField):
        if field.name in times:
            micros = F.call_function("div", F.col(field.name), F.lit(1000))
            return F.timestamp_micros(micros).alias(field.name)
        if field.name == "station_id":
            return canonical_id(F.col("station_id")).alias("station_id")
        if isinstance(field.dataType, T.DoubleType):
            return present(field.name).alias(field.name)
        return F.col(field.name)

    return table.select(*[column(f) for f in SILVER])


def count_stations(table: DataFrame) -> DataFrame:
    """Number of stations; no other column is read, and none at all where the station is a directory."""
    return table.select("station_id").distinct().agg(F.count("*").alias("stations"))


DRIFTING = ["cloud_cover_octas", "visibility_m", "radiation_index"]


def reconcile_union(parts: list[DataFrame], drifting: list[str] = DRIFTING) -> DataFrame:
    """One table from parts whose types differ or that lack columns.

    The drifting columns become doubles, null where a value is NaN or does not convert; a column that a
    part lacks is null there, and a column name that occurs twice in a part is taken once.
    """
    def aligned(part: DataFrame) -> DataFrame:
        seen, keep = set(), []
        for i, name in enumerate(part.columns):
            if name not in seen:
                seen.add(name)
                keep.append((i, name))
        unique = part.toDF(*[f"c{i}" for i in range(len(part.columns))]).select(
            *[F.col(f"c{i}").alias(name) for i, name in keep])
        return unique.withColumns({
            c: F.nanvl(F.col(c).try_cast("double"), F.lit(None)) for c in drifting if c in unique.columns})

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(aligned, parts))


def export_csv(silver: DataFrame, path: str, station_id: str, columns: list[str]) -> None:
    """Chosen measurements of one station as CSV, sorted by time over the files in name order."""
    (
        silver.where(F.col("station_id") == station_id)
        .select("timestamp", *columns).orderBy("timestamp")
        .write.mode("overwrite").option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    )
