"""Observations, documents and manifests made from the star-schema tables.

The engine works on station observations. The tables it is checked on hold orders and line items,
so this module reshapes them: a line item becomes an observation, a customer a station, an order a
load. Everything is computed by Spark from whole tables, so the work grows with them: every hundred
suppliers observe at ten stations of their own, whose hours hold about 60,000 line items at any scale,
with one in twenty falling on an hour that is taken.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.schema import COVERAGE, PAYLOAD

# --- Observations -----------------------------------------------------------

# the parameters of a derived observation; P is not part of the silver mapping
PARAMETERS = ["T", "T10N", "TD", "U", "RH", "DR", "DD", "FF", "FX", "FH", "Q", "SQ", "VV", "P",
              "N", "WW", "EE", "IX"]
# tells apart any two line items that differ in what is observed
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# understood by Spark and by DuckDB alike; reads a view named lineitem
OBSERVATION_SQL = """
SELECT '0-20000-0-0' || CAST(6200 + CAST((l_suppkey - l_suppkey % 100) / 10 AS BIGINT)
  + l_suppkey % 10 AS STRING) AS location_id,
 l_shipdate + ((l_orderkey * 7 + l_linenumber) % 24) * INTERVAL '1' HOUR AS timestamp,
 CAST(3500 + l_suppkey % 10 * 37 AS DOUBLE) / 1000 AS longitude,
 CAST(51000 + l_suppkey % 10 * 211 AS DOUBLE) / 1000 AS latitude,
 CASE WHEN h % 37 = 0 THEN NULL ELSE CAST(h % 1101 - 550 AS DOUBLE) / 10 END AS T,
 CASE WHEN h % 37 = 0 THEN NULL ELSE CAST(h % 1101 - 560 AS DOUBLE) / 10 END AS T10N,
 CAST(h * 7 % 301 - 100 AS DOUBLE) / 10 AS TD,
 CASE WHEN h % 41 = 0 THEN NULL ELSE CAST(h * 3 % 106 AS DOUBLE) END AS U,
 CASE WHEN h % 5 = 0 THEN CAST(-1 AS DOUBLE) WHEN h % 3 = 0 THEN CAST(h % 2101 AS DOUBLE) / 10
      ELSE CAST(0 AS DOUBLE) END AS RH,
 CAST(h % 61 AS DOUBLE) AS DR,
 CAST(h * 11 % 371 AS DOUBLE) AS DD,
 CASE WHEN h % 43 = 0 THEN NULL ELSE CAST(h * 5 % 521 AS DOUBLE) / 10 END AS FF,
 CASE WHEN h % 43 = 0 THEN NULL ELSE CAST(h * 5 % 521 + h % 50 AS DOUBLE) / 10 END AS FX,
 CAST(h * 5 % 497 AS DOUBLE) / 10 AS FH,
 CAST(h * 13 % 331 AS DOUBLE) AS Q,
 CAST(h * 17 % 61 AS DOUBLE) AS SQ,
 CAST(h % 84 * 100 AS DOUBLE) AS VV,
 CAST(9500 + h * 19 % 1001 AS DOUBLE) / 10 AS P,
 CAST(h * 23 % 10 AS DOUBLE) AS N,
 CASE WHEN h % 47 = 0 THEN NULL ELSE CAST(h % 100 AS DOUBLE) END AS WW,
 CAST(h * 29 % 53 AS DOUBLE) / 10 AS EE,
 CAST(h * 31 % 8 AS DOUBLE) AS IX,
 l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag
FROM (SELECT *, l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 AS h FROM lineitem)
"""

SOURCE_API = "observation service"
COLLECTION = "hourly-observations"
INGESTED_AT = "2025-01-01T00:00:00Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(lineitem: DataFrame) -> DataFrame:
    """Refined rows, one per line item, with the columns of the line item that order them."""
    text = OBSERVATION_SQL.replace("FROM lineitem", "FROM {lineitem}")
    rows = lineitem.sparkSession.sql(text, lineitem=lineitem)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


# --- Raw documents ----------------------------------------------------------

_DOCUMENT_ROWS = 8192
_CROWD = 4 * _DOCUMENT_ROWS  # rows of a station and year that go into several documents
_TASK_ROWS = 8 * _DOCUMENT_ROWS
_OBSERVED = ["timestamp", "longitude", "latitude", *PARAMETERS]


def _packed(values: list[tuple[str, Column]], schema) -> Column:
    given = dict(values)
    return F.struct(*[
        given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def _coverage(rows: Column) -> Column:
    def values(field: str) -> Column:
        return F.transform(rows, lambda r: r[field])

    def axis(field: str) -> Column:
        return F.struct(F.slice(values(field), 1, 1).alias("values"))

    times = F.transform(rows, lambda r: F.date_format(r["timestamp"], "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    ranges = F.create_map(*[
        part for p in PARAMETERS
        for part in (F.lit(p), F.struct(values(p).alias("values")))
    ])
    axes = F.struct(axis("longitude").alias("x"), axis("latitude").alias("y"),
                    F.struct(times.alias("values")).alias("t"))
    return _packed([
        ("type", F.lit("Coverage")),
        ("eumetnet:locationId", F.col("location_id")),
        ("domain", F.struct(axes.alias("axes"))),
        ("ranges", ranges),
    ], COVERAGE)


def _dealt(obs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Observations dealt by block of stations and, if there are crowds, part; and the columns that name a document.

    Stations and years are counted first. There are as many blocks as leave some thousand rows to a block and year, and only a crowded
    station and year has several parts. The years of a block go together, so that a task makes the directory of a station once.
    """
    year = F.year("timestamp").alias("_year")
    sizes = obs.groupBy("location_id", year).agg(F.count("*").alias("_n"))
    years = sizes.groupBy("_year").agg(F.sum("_n").alias("n"), F.max("_n").alias("most")).collect()
    total = sum(row["n"] for row in years)
    blocks = max(1, total // (_DOCUMENT_ROWS * max(1, len(years))))
    block = F.pmod(F.xxhash64("location_id"), F.lit(blocks)).alias("_block")
    keys, rows = ["_block", "_year"], obs
    if any(row["most"] > _CROWD for row in years):
        crowds = sizes.where(F.col("_n") > _CROWD).select(
            F.col("location_id").alias("_of"), F.col("_year").alias("_in"), F.ceil(F.col("_n") / _DOCUMENT_ROWS).alias("_parts"))
        same = F.col("location_id").eqNullSafe(F.col("_of")) & F.year("timestamp").eqNullSafe(F.col("_in"))
        rows = rows.withColumn("_id", F.monotonically_increasing_id()).join(F.broadcast(crowds), same, "left").withColumn(
            "_part", F.coalesce(F.col("_id") % F.col("_parts"), F.lit(0)))
        keys.append("_part")
    dealt = rows.select(block, year, *keys[2:], "location_id", *_OBSERVED).repartition(
        -(-total // _TASK_ROWS) or 1, "_block", *keys[2:])
    return dealt, keys


def responses(obs: DataFrame) -> DataFrame:
    """Observations packed into multi-station coverage collections of a year, column ``data``.

    A document has some thousand rows whatever the distribution of stations and times, and all of a station and year lie in one
    task, but for crowds of more than ``_CROWD`` rows; so documents split by station can be landed where they are
    (``placed``). The rows are shuffled once, as they are: lists gathered before a shuffle would be sorted, and spilled, by every
    task that reads the input.
    """
    rows, keys = _dealt(obs)
    each = (
        rows.groupBy(*keys, "location_id")
        .agg(F.array_sort(F.collect_list(F.struct(*_OBSERVED))).alias("_rows"))
        .select(*keys, _coverage(F.col("_rows")).alias("c"))
    )
    labels = F.parse_json(F.lit('{"T":{"unit":"C"},"RH":{"unit":"mm"},"FF":{"unit":"m/s"}}'))
    system = F.parse_json(F.lit('[{"coordinates":["x","y"]}]'))
    return each.groupBy(*keys).agg(F.collect_list("c").alias("c")).select(
        _packed([
            ("type", F.lit("CoverageCollection")),
            ("domainType", F.lit("PointSeries")),
            ("coverages", F.col("c")),
            ("parameters", labels),
            ("referencing", system),
        ], PAYLOAD).alias("data"))


# --- Stations ---------------------------------------------------------------

_DOCUMENT_STATIONS = 100

# understood by Spark and by DuckDB alike; reads views named customer, nation and region
STATION_SQL = """
SELECT lower(replace(c_name, '#', '_')) AS station_key,
 '0-20000-0-0' || CAST(6200 + c_custkey AS STRING) AS id,
 c_name AS name,
 CAST(50000 + c_custkey % 4000 AS DOUBLE) / 1000 AS latitude,
 CAST(3000 + c_custkey * 7 % 4000 AS DOUBLE) / 1000 AS longitude,
 CAST(c_custkey % 120 - 4 AS DOUBLE) AS elevation_m,
 r_name AS region,
 n_name AS province,
 lower(c_mktsegment) AS type,
 CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal >= 1000 END AS active,
 CASE WHEN c_acctbal > 9000 THEN 'critical' ELSE 'high' END AS priority,
 '1995-01-01' AS load_from,
 'Station of ' || n_name AS description,
 c_custkey
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def stations(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    text = (STATION_SQL.replace("FROM customer", "FROM {customer}")
            .replace("JOIN nation", "JOIN {nation}").replace("JOIN region", "JOIN {region}"))
    return customer.sparkSession.sql(text, customer=customer, nation=nation, region=region)


def registry_documents(station_rows: DataFrame) -> DataFrame:
    """Registry documents of a hundred stations each, with their types as station groups."""
    block = F.call_function("div", F.col("c_custkey"), F.lit(_DOCUMENT_STATIONS))
    names = ["id", "name", "latitude", "longitude", "elevation_m", "region", "province", "type",
             "active", "priority", "load_from", "description"]
    entry = F.struct("station_key", F.struct(*names).alias("s"))
    groups = station_rows.groupBy(block.alias("b"), F.col("type").alias("g")).agg(
        F.array_sort(F.collect_list("station_key")).alias("m"),
        F.collect_list(entry).alias("e"))
    return groups.groupBy("b").agg(
        F.map_from_entries(F.flatten(F.collect_list("e"))).alias("stations"),
        F.map_from_entries(F.collect_list(F.struct("g", "m"))).alias("station_groups"),
    ).select(F.to_json(F.struct("stations", "station_groups")).alias("value"))


def catalog_documents(station_rows: DataFrame) -> DataFrame:
    """GeoJSON feature collections of a hundred stations each."""
    block = F.call_function("div", F.col("c_custkey"), F.lit(_DOCUMENT_STATIONS))
    feature = F.struct(
        F.lit("Feature").alias("type"), F.col("id"),
        F.struct("name").alias("properties"),
        F.struct(F.lit("Point").alias("type"),
                 F.array("longitude", "latitude").alias("coordinates")).alias("geometry"))
    return station_rows.groupBy(block.alias("b")).agg(F.collect_list(feature).alias("features")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value"))


# --- Manifests and events ---------------------------------------------------

# understood by Spark and by DuckDB alike; an order is a load of its customer's station
LOAD_SQL = """
SELECT lower(replace(c_name, '#', '_')) AS station_key,
 c_name AS station_name, c_mktsegment,
 CAST(year(o_orderdate) AS INT) AS year,
 o_orderdate AS start,
 o_orderdate + (o_orderkey % 40 * 24 + 23) * INTERVAL '1' HOUR AS "end",
 TIMESTAMP '2020-01-01 00:00:00' + o_orderkey % 100000000 * INTERVAL '1' SECOND AS loaded_at,
 (o_orderkey % 40 + 1) * 24 AS records,
 CAST(o_orderkey % 997 AS DOUBLE) / 100 AS size_mb,
 CAST(o_orderkey % 31 + 4 AS DOUBLE) / 4 AS seconds,
 o_orderkey, o_orderstatus, o_orderpriority
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def loads(orders: DataFrame, customer: DataFrame) -> DataFrame:
    text = (LOAD_SQL.replace("FROM orders", "FROM {orders}")
            .replace("JOIN customer", "JOIN {customer}").replace('"end"', "`end`"))
    rows = orders.sparkSession.sql(text, orders=orders, customer=customer)
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in ("start", "end", "loaded_at")})


def _entries(of: DataFrame) -> DataFrame:
    return of.groupBy("station_key", "station_name", "c_mktsegment", "year").agg(
        F.min("loaded_at").alias("loaded_at"),
        F.sum(F.rint(F.col("size_mb") * 100).cast("bigint")).alias("_cents"),
    ).select(
        "station_key", "station_name", "c_mktsegment", "year",
        F.date_format("loaded_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("loaded_at"),
        F.concat(F.lit("raw/"), "station_key", F.lit("/"), F.col("year").cast("string"))
        .alias("file_path"),
        (F.col("_cents") / F.lit(100.0)).alias("size_mb"),
    )


def year_manifest(load_rows: DataFrame, statuses: list[str]) -> DataFrame:
    """Loaded years per station, from the loads with the given statuses."""
    return _entries(load_rows.where(F.col("o_orderstatus").isin(statuses))).drop("c_mktsegment")


def manifest_documents(load_rows: DataFrame, statuses: list[str]) -> DataFrame:
    """One manifest document per station: as bare years for one market segment, mixed for another,
    as objects for the rest. A station has as many entries as years."""
    rows = _entries(load_rows.where(F.col("o_orderstatus").isin(statuses)))
    entry = F.to_json(F.struct("year", "loaded_at", "file_path", "size_mb"))
    year = F.col("year").cast("string")
    text = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", year)
        .when((F.col("c_mktsegment") == "BUILDING") & (F.col("year") % 2 == 0), year)
        .otherwise(entry)
    )
    return rows.groupBy("station_key", "station_name").agg(F.collect_list(text).alias("e")).select(
        F.concat(
            F.lit('{"station_key":"'), "station_key", F.lit('","station_id":"id of '),
            "station_key", F.lit('","station_name":"'), "station_name",
            F.lit('","years_loaded":['), F.concat_ws(",", "e"), F.lit("]}")).alias("value"))


def event_lines(load_rows: DataFrame) -> DataFrame:
    """Ingest events as JSON lines: one per successful load and one per station and year."""
    when = F.date_format("loaded_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    loaded = load_rows.where(F.col("o_orderstatus") == "F").select(F.to_json(F.struct(
        when.alias("timestamp"), F.lit("INFO").alias("level"),
        F.lit("year_loaded").alias("event_type"), "station_key", "station_name", "year",
        F.col("size_mb").alias("file_size_mb"), F.col("seconds").alias("duration_seconds"),
    )).alias("value"))

    def number(status: str) -> Column:
        return F.count_if(F.col("o_orderstatus") == status)

    runs = load_rows.groupBy("station_key", "station_name", "year").agg(
        F.max("loaded_at").alias("loaded_at"),
        F.count("*").alias("total_years"), number("F").alias("completed_years"),
        number("O").alias("skipped_years"), number("P").alias("failed_years"),
        (F.sum(F.rint(F.col("seconds") * 4).cast("bigint")) / F.lit(4.0)).alias("duration_seconds"),
    ).select(F.to_json(F.struct(
        when.alias("timestamp"), F.lit("INFO").alias("level"),
        F.lit("station_complete").alias("event_type"), "station_key", "station_name",
        "total_years", "completed_years", "skipped_years", "failed_years", "duration_seconds",
        (F.col("failed_years") == 0).alias("success"),
    )).alias("value"))
    return loaded.unionByName(runs)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
