"""The stored summary tables: daily states, hourly rows and extreme events, built as a whole or by day."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake.operators import gold
from gaugelake.session import configure
from gaugelake.sources import tables
from gaugelake.sources.snapshots import Snapshots


class Kind(NamedTuple):
    schema: T.StructType
    rows: Callable[[DataFrame], DataFrame]  # from silver rows
    order: list[str]
    placed: Callable[[DataFrame], DataFrame] | None = None  # as ``rows``, in ranges of the order already


KINDS = {
    "daily": Kind(gold.STATES, gold.daily_states, ["year", "date", "station_id"]),
    "hourly": Kind(gold.HOURLY, gold.hourly_rows, ["year", "station_id", "timestamp"]),
    "events": Kind(gold.EVENTS, gold.event_rows, ["year", "date", "station_id", "timestamp"], gold.placed_event_rows),
}


def _stored(spark: SparkSession, gold_path: str, name: str) -> Snapshots:
    return Snapshots(spark, f"{gold_path}/{name}", ["year"], within="date")


def _arranged(kind: Kind) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.repartitionByRange(*kind.order).sortWithinPartitions(*kind.order)


def _whole(name: str, silver: DataFrame, layout: list[str]) -> DataFrame:
    """The rows of a summary table as they are to be written.

    The hourly rows of a silver table by year are in their ranges as they are read, and are sorted only.
    """
    kind = KINDS[name]
    if name == "hourly" and layout == tables.BY_YEAR:
        return kind.rows(silver).sortWithinPartitions(*kind.order)
    if kind.placed is not None:
        return kind.placed(silver).sortWithinPartitions(*kind.order)
    return _arranged(kind)(kind.rows(silver))


def build(spark: SparkSession, silver_path: str, gold_path: str, layout: list[str] = tables.BY_YEAR) -> None:
    """All summary tables, from the whole silver table; what was there before is replaced."""
    silver = tables.scan_silver(configure(spark), silver_path, layout)
    for name in KINDS:
        _stored(spark, gold_path, name).overwrite(_whole(name, silver, layout))


def refresh(spark: SparkSession, silver_path: str, gold_path: str, days: list[str | None],
            layout: list[str] = tables.BY_YEAR) -> None:
    """Work out these days (ISO, null for rows without a time) again, and replace them and nothing else.

    Only the silver files of their years are read, and of these the row groups that hold one of the days, where the layout keeps time
    together. Days that are gone from the silver table, or no longer have any event, are emptied. A table that is not there yet is
    built as a whole. After many changes ``compact`` makes single files again.
    """
    if not days:
        return
    if not all(_stored(spark, gold_path, name).version() for name in KINDS):
        build(spark, silver_path, gold_path, layout)
        return
    silver = tables.scan_silver(configure(spark), silver_path, layout)
    given = sorted(d for d in days if d is not None)
    years = sorted({int(d[:4]) for d in given})
    day, time = F.to_date("timestamp"), F.col("timestamp")
    chosen = F.lit(False)
    if given:
        span = (time >= F.lit(given[0]).cast("timestamp")) & (
            time < F.date_add(F.lit(given[-1]).cast("date"), 1).cast("timestamp"))
        chosen = span & day.isin([F.lit(d).cast("date") for d in given])
        if "year" in layout:
            chosen = F.col("year").isin(years) & chosen
    if None in days:
        chosen = chosen | time.isNull()
    rows = silver.where(chosen)
    for name, kind in KINDS.items():
        table = _stored(spark, gold_path, name)
        table.replace_values(_arranged(kind)(kind.rows(rows)), arranged=_arranged(kind), emptied=list(days))
        table.compact(kind.schema, _arranged(kind), MOST_LAYERS)


MOST_LAYERS = 16


def compact(spark: SparkSession, gold_path: str) -> None:
    """Rewrite the years that refreshes have replaced days of."""
    for name, kind in KINDS.items():
        _stored(spark, gold_path, name).compact(kind.schema, _arranged(kind), 1)


def scan(spark: SparkSession, gold_path: str, name: str) -> DataFrame:
    """One of the summary tables: ``daily`` (states), ``hourly`` or ``events``."""
    table = _stored(spark, gold_path, name)
    if not table.version():
        raise FileNotFoundError(f"no summary table at {gold_path}/{name}")
    return table.read(KINDS[name].schema)
