"""Coverage documents -> rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugelake.schema import COVERAGE, PAYLOAD

LOCATION = "eumetnet:locationId"
# columns of a flattened row besides the parameters
ROW_KEYS = ["timestamp", "longitude", "latitude", "location_id"]
ORIGIN = ["_coverage", "_pos"]
_CARRIED = ["_source_file", "_metadata", "station_id", "year"]


def payload(docs: DataFrame) -> Column:
    """The coverage payload of either document form: under ``data`` or at top level."""
    if "coverages" not in docs.columns:
        return F.col("data")
    bare = F.struct(*[F.col(f"`{f.name}`") for f in PAYLOAD])
    if "data" not in docs.columns:
        return bare
    return F.when(F.col("data").isNotNull(), F.col("data")).otherwise(bare)


def _carried(docs: DataFrame) -> list[str]:
    return [c for c in _CARRIED if c in docs.columns]


def coverages(docs: DataFrame, bare: bool = False) -> DataFrame:
    """One row per coverage of a collection: the carried columns, ``_coverage`` and ``coverage``.

    With ``bare`` a document that is itself a coverage gives one row, and any other document
    without coverages one row with a null coverage.
    """
    shaped = docs.select(*_carried(docs), payload(docs).alias("_p"))
    members, generator = F.col("_p.coverages"), F.posexplode
    if bare:
        own = F.struct(*[F.col(f"_p.`{f.name}`").alias(f.name) for f in COVERAGE])
        members = F.when(F.col("_p.type") == "Coverage", F.array(own)).otherwise(members)
        generator = F.posexplode_outer
    return shaped.select(*_carried(docs), F.col("_p.type").alias("_type"),
                         generator(members).alias("_coverage", "coverage"))


def split_coverages(docs: DataFrame, requested: list[str] | None = None) -> DataFrame:
    """Split multi-station responses into one document per station.

    A coverage of a collection becomes a collection of its own with the shared parameters and
    referencing copied; one without a location id is skipped. A bare coverage is accepted only
    when exactly one station was requested, and is kept as it is. Other types yield nothing.
    """
    shaped = docs.select(payload(docs).alias("p"))
    only = F.lit(requested[0] if requested and len(requested) == 1 else None).cast("string")
    members = F.when(F.col("p.type") == "CoverageCollection", F.col("p.coverages"))
    exploded = shaped.select("p", F.explode_outer(members).alias("coverage"))
    station = (
        F.when(F.col("p.type") == "CoverageCollection",
               F.nullif(F.col(f"coverage.`{LOCATION}`"), F.lit("")))
        .when(F.col("p.type") == "Coverage", only)
    )
    single = F.struct(*[
        (F.array("coverage") if f.name == "coverages"
         else F.col(f"p.`{f.name}`") if f.name in ("type", "domainType", "parameters", "referencing")
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in PAYLOAD
    ])
    document = F.when(F.col("p.type") == "CoverageCollection", single).otherwise(F.col("p"))
    return (
        exploded.select(station.alias("station_id"), document.alias("data"))
        .where(F.col("station_id").isNotNull())
    )


def _place() -> list[Column]:
    """Position and station of a coverage."""
    return [
        F.get(F.col("coverage.domain.axes.x.values"), F.lit(0)).alias("longitude"),
        F.get(F.col("coverage.domain.axes.y.values"), F.lit(0)).alias("latitude"),
        F.col(f"coverage.`{LOCATION}`").alias("location_id"),
    ]


def flatten_coverage(docs: DataFrame) -> DataFrame:
    """One row per coverage and time, with all parameter values in a ``params`` map.

    The first x and y are the position. A range array shorter than the time axis gives null for
    the times it does not reach, and a coverage without times gives no rows. A time that does not
    parse is null; ``isolate_bad_files`` finds the documents that hold one.

    The rows are put together within the coverage before it is exploded: beside each exploded row
    Spark would otherwise copy all values of its coverage.
    """
    rows = F.transform("coverage.domain.axes.t.values", lambda t, i: F.struct(
        F.try_to_timestamp(t).alias("timestamp"), i.alias("_pos"),
        F.transform_values("coverage.ranges", lambda _, r: F.get(r["values"], i)).alias("params")))
    return coverages(docs).select(
        *_carried(docs), "_coverage", *_place(), F.inline(rows),
    ).select(*ROW_KEYS, "params", *ORIGIN, *_carried(docs))


_BLOCK = 64  # times


def flatten_wide(docs: DataFrame, names: list[str]) -> DataFrame:
    """``flatten_coverage`` with one column per parameter instead of the map.

    For known names, this never builds the maps: each value is taken from the array of its
    parameter. The arrays are cut into short blocks first, so that little is copied beside a row
    even where Spark does not generate code for the step.
    """
    _check_names(names, [*ROW_KEYS, *ORIGIN, *_carried(docs)])
    keys = [*_carried(docs), "_coverage", "longitude", "latitude", "location_id"]
    arrays = [f"_v{i}" for i in range(len(names))]
    whole = coverages(docs).select(
        *_carried(docs), "_coverage", *_place(), F.col("coverage.domain.axes.t.values").alias("_t"),
        *[F.try_element_at("coverage.ranges", F.lit(name))["values"].alias(a)
          for name, a in zip(names, arrays, strict=True)],
    ).where(F.size("_t") > 0)
    starts = F.sequence(F.lit(0), F.size("_t") - 1, F.lit(_BLOCK))
    blocks = whole.select("*", F.explode(starts).alias("_from")).select(
        *keys, "_from",
        *[F.slice(a, F.col("_from") + 1, F.lit(_BLOCK)).alias(a) for a in ("_t", *arrays)])
    return blocks.select("*", F.posexplode("_t").alias("_i", "_time")).select(
        F.try_to_timestamp("_time").alias("timestamp"), "longitude", "latitude", "location_id",
        "_coverage", (F.col("_from") + F.col("_i")).alias("_pos"), *_carried(docs),
        *[F.get(F.col(a), F.col("_i")).alias(name) for name, a in zip(names, arrays, strict=True)])


def _check_names(names: list[str], taken: list[str]) -> None:
    clash = set(taken).intersection(names)
    if clash:
        raise ValueError(f"parameter names equal to row columns: {sorted(clash)}")


def parameter_names(docs: DataFrame) -> list[str]:
    """The parameter vocabulary, read from the keys of the documents before any row is made.

    Only the distinct names reach the driver; there are a few dozen whatever the data size.
    """
    names = coverages(docs).select(F.explode(F.map_keys("coverage.ranges")).alias("n")).distinct()
    return sorted(r["n"] for r in names.collect())


def widen_params(rows: DataFrame, names: list[str]) -> DataFrame:
    """One column per parameter instead of the map; an absent parameter is null."""
    kept = [c for c in rows.columns if c != "params"]
    _check_names(names, kept)
    return rows.select(
        *kept, *[F.try_element_at("params", F.lit(n)).alias(n) for n in names],
    )


def add_lineage(rows: DataFrame) -> DataFrame:
    """Name the source file, time of ingestion and source service of each row."""
    return (
        rows.withColumn("_ingestion_timestamp", F.col("_metadata.ingestion_timestamp"))
        .withColumn("_source_api", F.col("_metadata.source_api"))
        .drop("_metadata")
    )


def profile_coverages(docs: DataFrame, sample_size: int = 5) -> DataFrame:
    """What each coverage of a raw drop holds, with a few values per parameter."""
    times = F.col("coverage.domain.axes.t.values")
    head = F.transform_values(
        "coverage.ranges",
        lambda _, r: F.slice(
            F.filter(r["values"], lambda v: v.isNotNull()), 1, sample_size),
    )
    each = coverages(docs, bare=True)
    return each.select(
        *[c for c in _carried(docs) if c != "_metadata"],
        F.col("_type").alias("type"),
        "_coverage",
        F.col(f"coverage.`{LOCATION}`").alias("location_id"),
        F.get(times, F.lit(0)).alias("first_t"),
        F.get(times, F.size(times) - 1).alias("last_t"),
        F.coalesce(F.size(times), F.lit(0)).alias("n_times"),
        F.array_sort(F.map_keys("coverage.ranges")).alias("parameters"),
        head.alias("samples"),
    )


def profile_raw(docs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The profile summed up per source file, or per the given columns."""
    keys = by or ["_source_file"]
    # one row per coverage and parameter, of which the first stands for the coverage
    each = profile_coverages(docs).select(
        *keys, "type", "_coverage", "first_t", "last_t", "n_times",
        F.posexplode_outer("parameters").alias("i", "parameter"))
    first = F.coalesce(F.col("i"), F.lit(0)) == 0
    return each.groupBy(*keys).agg(
        F.array_sort(F.collect_set("type")).alias("types"),
        F.count(F.when(first, F.col("_coverage"))).alias("n_coverages"),
        F.coalesce(F.sum(F.when(first, F.col("n_times"))), F.lit(0)).alias("n_times"),
        F.min("first_t").alias("first_t"),
        F.max("last_t").alias("last_t"),
        F.array_sort(F.collect_set("parameter")).alias("parameters"),
    )


def count_data_points(docs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Times x parameters over the coverages of the collections; other types count 0."""
    shaped = docs.select(*(by or []), payload(docs).alias("p"))
    points = F.aggregate(
        F.coalesce(F.col("p.coverages"), F.array().cast(PAYLOAD["coverages"].dataType)),
        F.lit(0).cast("bigint"),
        lambda acc, c: acc + F.coalesce(
            F.size(c["domain"]["axes"]["t"]["values"]).cast("bigint")
            * F.size(c["ranges"]).cast("bigint"), F.lit(0).cast("bigint")),
    )
    counted = F.when(F.col("p.type") == "CoverageCollection", points).otherwise(F.lit(0))
    return shaped.groupBy(*(by or [])).agg(
        F.coalesce(F.sum(counted), F.lit(0)).cast("bigint").alias("data_points"))
