"""Seconds per headline query; prints one JSON line.

The two pipeline jobs run first, from raw JSON documents to the refined and on to the silver table,
files written included, and on to the summary tables. The analytical queries then read a silver table. Their results are computed
in full (noop sink), and the best of the repeated runs counts. Packing the star-schema tables into
documents is not timed.
"""

from __future__ import annotations

import json
import os
import time

from gaugelake import derive
from gaugelake.entry.queries import registered
from gaugelake.entry.workspace import open_workspace
from gaugelake.operators import coverage
from gaugelake.plans import jobs, summaries
from gaugelake.session import get_session

HEADLINE = [
    "station_comparison", "monthly_averages", "month_station_combinations", "hottest_coldest",
    "rainfall_comparison", "quality_comparison", "wind_statistics", "seasonal_temperatures",
    "station_stats_lazy", "temperature_distribution", "correlation_pairs", "rainiest_days",
    "null_profile", "temperature_stats_full", "correlation_matrix", "windiest_hours",
    "gold_daily_summary", "gold_hourly_station", "gold_monthly_comparison", "gold_extreme_events",
    "wettest_days", "detect_gaps", "completeness", "quality_gate",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = get_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    workspace = open_workspace(spark, sf_dir)

    def compute(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    raw = workspace.raw_root
    refined, cleaned, summarised = (f"{workspace.root}/bench_{name}" for name in ("refined", "silver", "gold"))
    names = derive.PARAMETERS
    actions = {
        "raw_to_refined": lambda: jobs.refine(spark, raw, refined, multiline=False, names=names),
        "refined_to_silver": lambda: jobs.clean(spark, refined, cleaned, names),
        "silver_to_gold": lambda: summaries.build(spark, cleaned, summarised),
        "flatten_documents": lambda: compute(coverage.flatten_wide(workspace.raw, names)),
    }
    runs = registered()
    for name in HEADLINE:
        actions[name] = lambda name=name: compute(runs[name](spark, sf_dir))
    n = workspace.silver.count()
    seconds = {name: min(timed(action) for _ in range(repeats)) for name, action in actions.items()}

    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": sf_dir.rsplit("/sf", 1)[-1],
        "silver_rows": n,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
