import json

import pytest
from documents import A, B, collection, coverage, enveloped, hours, land

from gaugelake.__main__ import main
from gaugelake.plans import jobs
from gaugelake.plans.views import register_views
from gaugelake.sources import tables
from gaugelake.streaming.incremental import incremental_load


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    root = base / "raw"
    for station, shift in ((A, 0), (B, 10)):
        land(root, station, 2024, "1.json", enveloped(collection(coverage(
            station, hours("2024-01-01", 0, 24), {"T": [shift + h / 10 for h in range(24)], "RH": [-1] * 24,
                                                  "FF": [11] * 24})), station))
        land(root, station, 2025, "2.json", enveloped(collection(coverage(
            station, hours("2025-07-01", 0, 3), {"T": [shift, None, 99], "RH": [0, 1, 2]})), station))
    (base / "stations.json").write_text(
        '{"stations": {"a": {"id": "%s", "name": "Alpha", "region": "East"}, "b": {"id": "%s", "name": "Beta"}}}' % (A, B))
    return base


def test_command_line(spark, folders, capsys):
    raw, refined, silver, registry = (str(folders / n) for n in ("raw", "refined", "silver", "stations.json"))
    main(["refine", "--raw", raw, "--refined", refined, "--multiline"])
    assert "FF, RH, T" in capsys.readouterr().out
    main(["clean", "--refined", refined, "--silver", silver])
    assert tables.scan_silver(spark, silver).count() == 54
    # one station and year again: nothing else changes
    main(["clean", "--refined", refined, "--silver", silver, "--registry", registry, "--station", "a", "--year", "2025"])
    assert tables.scan_silver(spark, silver).count() == 54
    main(["report", "--silver", silver, "--year", "2024"])
    out = capsys.readouterr().out
    assert "station_comparison" in out and "windiest_hours" in out and "HOTTEST" in out
    main(["incremental", "--raw", raw, "--silver", str(folders / "other"), "--checkpoint", str(folders / "ck"), "--multiline"])
    assert tables.scan_silver(spark, str(folders / "other")).count() == 54
    with pytest.raises(SystemExit):
        main(["report", "--silver", silver])
    with pytest.raises(ValueError):
        main(["clean", "--refined", refined, "--silver", silver, "--registry", registry, "--station", "z"])


def test_views_take_sql(spark, folders):
    from gaugelake.sources.registry import read_registry, station_dim
    register_views(spark, str(folders / "silver"), station_dim(read_registry(spark, str(folders / "stations.json"))))
    rows = spark.sql("""
        SELECT station_id, CASE WHEN month(timestamp) IN (6, 7, 8) THEN 'Summer' ELSE 'Other' END AS season,
               round(avg(temperature_celsius), 2) AS t, count(CASE WHEN wind_speed_ms > 10 THEN 1 END) AS windy
        FROM silver WHERE year(timestamp) = 2024 GROUP BY station_id, season ORDER BY station_id""").collect()
    assert [(r["station_id"], r["t"], r["windy"]) for r in rows] == [(B, 11.15, 24), (A, 1.15, 24)]
    assert spark.sql("SELECT * FROM gold_extreme_events WHERE event_type = 'heat'").count() == 2
    east = spark.sql("SELECT sum(hours) FROM gold_monthly_by_region WHERE region = 'East'").first()[0]
    assert east == 27


def test_report_runs_in_full(spark, folders):
    silver = tables.scan_silver(spark, str(folders / "silver")).cache()
    results = {name: df.collect() for name, df in jobs.report(silver, 2024).items()}
    assert len(results) == 16 and all(results.values())
    silver.unpersist()


def test_both_forms_of_files_and_no_document_lost(spark, tmp_path):
    root = tmp_path / "raw + more"
    day = {A: "2024-01-01", B: "2024-01-02"}
    docs = {s: enveloped(collection(coverage(s, hours(d, 0, 3), {"T": [1, 2, 3]})), s) for s, d in day.items()}
    land(root, A, 2024, "pretty.json", docs[A])
    land(root, B, 2024, "line.json", docs[B], indent=None)
    refined = str(tmp_path / "refined")
    assert jobs.refine(spark, str(root), refined) == ["T"]
    assert tables.scan_refined(spark, refined, ["T"]).count() == 6
    incremental_load(spark, str(root), str(tmp_path / "silver"), str(tmp_path / "ck"))
    assert tables.scan_silver(spark, str(tmp_path / "silver")).count() == 6

    land(root, B, 2024, "broken.json", json.dumps(docs[B])[:-5])
    with pytest.raises(ValueError, match="1 of 3 documents"):
        jobs.refine(spark, str(root), refined)
    with pytest.raises(Exception, match="1 of 1 documents"):
        incremental_load(spark, str(root), str(tmp_path / "silver"), str(tmp_path / "ck"))
    bad = str(tmp_path / "bad")
    jobs.refine(spark, str(root), refined, quarantine=bad)
    incremental_load(spark, str(root), str(tmp_path / "silver"), str(tmp_path / "ck"), quarantine=bad + "2")
    assert spark.read.json(bad).count() == 1 and spark.read.json(bad + "2").count() == 1
    assert tables.scan_silver(spark, str(tmp_path / "silver")).count() == 6
