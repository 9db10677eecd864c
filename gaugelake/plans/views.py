"""The tables under fixed names, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugelake.operators import gold
from gaugelake.session import configure
from gaugelake.sources import tables


def register_views(spark: SparkSession, silver_path: str, stations: DataFrame | None = None,
                   layout: list[str] = tables.BY_YEAR) -> None:
    """Temporary views ``silver``, ``gold_daily_summary``, ``gold_extreme_events`` and, with a
    registry, ``stations``, ``gold_monthly_comparison`` and ``gold_monthly_by_region``."""
    silver = tables.scan_silver(configure(spark), silver_path, layout)
    views = {
        "silver": silver,
        "gold_daily_summary": gold.daily_summary(silver),
        "gold_extreme_events": gold.extreme_events(silver),
    }
    if stations is not None:
        views["stations"] = stations
        views["gold_monthly_comparison"] = gold.monthly_comparison(silver, stations)
        views["gold_monthly_by_region"] = gold.monthly_by_region(silver, stations)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
