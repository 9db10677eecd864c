"""Station registry, station groups and station catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.schema import REGISTRY_DOCUMENT


def read_registry(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Registry documents: a map of station records and a map of groups."""
    return spark.read.schema(REGISTRY_DOCUMENT).option("multiLine", multiline).json(path)


def station_dim(registry: DataFrame) -> DataFrame:
    """One row per station, under its key."""
    return registry.select(F.explode("stations").alias("station_key", "s")).select("station_key", "s.*")


def lookup_station(stations: DataFrame, station_key: str) -> DataFrame:
    """The record of one station; an unknown key is an error."""
    found = stations.where(F.col("station_key") == station_key)
    if found.isEmpty():
        raise ValueError(f"unknown station: {station_key}")
    return found


def active_stations(stations: DataFrame) -> DataFrame:
    """Stations marked active; one without the mark is not."""
    return stations.where(F.coalesce("active", F.lit(False)))


def group_members(registry: DataFrame) -> DataFrame:
    """One row per group and member."""
    return registry.select(F.explode("station_groups").alias("group", "m")).select(
        "group", F.explode("m").alias("station_key"))


def station_group(stations: DataFrame, members: DataFrame, names: str | list[str]) -> DataFrame:
    """Stations of a group, or of a list of keys (comma-separated, or as such); an unknown name gives none.

    A single name is that of a group or, as in a list of one, the key of a station.
    """
    wanted = [n.strip() for n in (names.split(",") if isinstance(names, str) else names)]
    listed = stations.where(F.col("station_key").isin(wanted)).select("station_key")
    if len(wanted) == 1:
        listed = listed.union(members.where(F.col("group") == wanted[0]).select("station_key"))
    return stations.join(listed, "station_key", "left_semi")


def station_catalog(documents: DataFrame) -> DataFrame:
    """GeoJSON feature collections -> id, name and position of each station."""
    feature = documents.select(F.explode("features").alias("f"))
    position = F.col("f.geometry.coordinates")
    return feature.select(
        F.col("f.id").alias("id"),
        F.col("f.properties.name").alias("name"),
        F.get(position, F.lit(0)).alias("longitude"),
        F.get(position, F.lit(1)).alias("latitude"),
    )
