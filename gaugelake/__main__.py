"""The jobs from the command line, for ``spark-submit`` or ``python -m gaugelake``.

    refine      --raw DIR --refined DIR  [--registry FILE --station KEY] [--year Y]
                [--index DIR]  (landing index: saves the passes that look for forms and parameter names)
                [--parameters T,U,RH]
    clean       --refined DIR --silver DIR  [--registry FILE --station KEY] [--year Y] [--min-score S] [--gold DIR]
    incremental --raw DIR --silver DIR --checkpoint DIR  [--keep first|last] [--gold DIR]
    report      --silver DIR --year Y
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from gaugelake.plans import jobs, summaries
from gaugelake.sources import landing, registry, tables
from gaugelake.streaming.incremental import incremental_load


def _station_id(spark: SparkSession, args: argparse.Namespace) -> str | None:
    if args.station is None:
        return None
    if args.registry is None:
        raise SystemExit("--station needs --registry")
    stations = registry.station_dim(registry.read_registry(spark, args.registry))
    return registry.lookup_station(stations, args.station).first()["id"]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gaugelake")
    parser.add_argument("job", choices=["refine", "clean", "incremental", "report"])
    for name in ("raw", "refined", "silver", "checkpoint", "registry", "station", "quarantine", "gold", "index"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--year", type=int)
    parser.add_argument("--parameters", type=lambda text: text.split(","))
    parser.add_argument("--layout", choices=["year", "station-year", "station-month"], default="year",
                        help="directories of the tables")
    parser.add_argument("--min-score", type=float, help="clean: rows with a lower quality score go to the quarantine")
    parser.add_argument("--keep", choices=["first", "last"], default="first",
                        help="incremental: which copy of an hour counts, the stored or the new one")
    parser.add_argument("--multiline", action="store_true", default=None,
                        help="one pretty-printed document per file; both forms are told apart otherwise")
    args = parser.parse_args(argv)
    needed = {"refine": ("raw", "refined"), "clean": ("refined", "silver"),
              "incremental": ("raw", "silver", "checkpoint"), "report": ("silver", "year")}
    missing = [n for n in needed[args.job] if getattr(args, n) is None]
    if missing:
        parser.error(f"{args.job} needs " + ", ".join(f"--{n}" for n in missing))

    spark = SparkSession.builder.appName(f"gaugelake {args.job}").getOrCreate()
    layout = {"year": tables.BY_YEAR, "station-year": tables.YEARLY, "station-month": tables.MONTHLY}[args.layout]
    if args.job == "refine":
        names = jobs.refine(spark, args.raw, args.refined, _station_id(spark, args), args.year,
                            args.multiline, args.parameters, layout, args.quarantine, args.index)
        if args.index:
            print("{} of {} files ok".format(*landing.totals(landing.scan(spark, args.index)).first()))
        print("parameters:", ", ".join(names))
    elif args.job == "clean":
        gate = jobs.clean(spark, args.refined, args.silver, station_id=_station_id(spark, args),
                          year=args.year, layout=layout, min_score=args.min_score)
        if gate is not None:
            gate.orderBy("station_id").show(40, truncate=False)
        if args.gold:
            summaries.build(spark, args.silver, args.gold, layout)
    elif args.job == "incremental":
        incremental_load(spark, args.raw, args.silver, args.checkpoint, layout=layout,
                         multiline=args.multiline, quarantine=args.quarantine, keep=args.keep, gold_path=args.gold)
    else:
        silver = tables.scan_silver(spark, args.silver, layout)
        for name, result in jobs.report(silver, args.year).items():
            print(name)
            result.show(40, truncate=False)


if __name__ == "__main__":
    main()
