"""Hand-made coverage documents."""

import json
from pathlib import Path

A, B = "0-20000-0-06283", "0-20000-0-06275"


def coverage(station, times, ranges, x=6.65, y=52.067):
    c = {
        "type": "Coverage",
        "domain": {"axes": {"x": {"values": [x]}, "y": {"values": [y]}}},
        "ranges": {name: {"type": "NdArray", "values": values} for name, values in ranges.items()},
    }
    if times is not None:
        c["domain"]["axes"]["t"] = {"values": times}
    if station is not None:
        c["eumetnet:locationId"] = station
    return c


def collection(*coverages):
    return {
        "type": "CoverageCollection", "domainType": "PointSeries", "coverages": list(coverages),
        "parameters": {"T": {"unit": {"symbol": "C"}}}, "referencing": [{"coordinates": ["x", "y"]}],
    }


def enveloped(data, station=A, at="2025-11-16T10:00:00Z"):
    return {"_metadata": {"ingestion_timestamp": at, "station_id": station, "station_name": "S",
                          "source_api": "api", "api_collection": "c",
                          "ingestion_method": "single_station"}, "data": data}


def hours(day, first, n):
    return [f"{day}T{h:02d}:00:00Z" for h in range(first, first + n)]


def land(root, station, year, name, document, indent=2):
    folder = Path(root) / f"station_id={station}" / f"year={year}"
    folder.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=indent)
    (folder / name).write_text(text)
