import calendar as cal
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugelake.operators import gaps, manifest, numbering, planning

SECOND = timedelta(seconds=1)


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame([("a", "A"), ("b", "B")], "station_key string, name string")


def periods(df, key="a"):
    rows = df.where(F.col("station_key") == key).orderBy("start").collect()
    return [(r["start"], r["end"]) for r in rows]


def months_from(start, end, n):
    out = []
    while start < end:
        month = start.month - 1 + n
        after = datetime(start.year + month // 12, month % 12 + 1, 1)
        out.append((start, min(after - SECOND, end)))
        start = after
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 7, 12])
def test_calendar_months(stations, n):
    got = periods(planning.backfill_plan(stations, "2000-01-01", "2003-12-31 23:59:59", "months", n))
    assert got == months_from(datetime(2000, 1, 1), datetime(2003, 12, 31, 23, 59, 59), n)


def test_months_are_cut_at_both_ends(stations):
    got = periods(planning.backfill_plan(stations, "2024-01-15 13:30:00", "2024-03-10 06:00:00", "month"))
    assert got == [
        (datetime(2024, 1, 15), datetime(2024, 1, 31, 23, 59, 59)),
        (datetime(2024, 2, 1), datetime(2024, 2, 29, 23, 59, 59)),
        (datetime(2024, 3, 1), datetime(2024, 3, 10, 6))]


def test_a_range_that_ends_where_a_period_starts_gets_no_empty_period(stations):
    got = periods(planning.backfill_plan(stations, "2024-01-01", "2024-03-01", "month"))
    assert len(got) == 2 and got[-1][1] == datetime(2024, 2, 29, 23, 59, 59)


def test_years_hours_and_presets(stations):
    years = periods(planning.preset_plan(stations, "full", "year"))
    assert years == [(datetime(y, 1, 1), datetime(y, 12, 31, 23, 59, 59)) for y in (2024, 2025)]
    day = periods(planning.backfill_plan(stations, "2024-02-29", "2024-02-29 23:59:59", "hour"))
    assert len(day) == 24 and day[5] == (datetime(2024, 2, 29, 5), datetime(2024, 2, 29, 5, 59, 59))
    for arguments in (("2024-01-01", "2024-01-02", "week"), ("2024-01-02", "2024-01-01", "year"),
                      ("2024-01-01", "2024-01-02", "months", 0)):
        with pytest.raises(ValueError):
            planning.backfill_plan(stations, *arguments)


def test_thirty_day_chunks(stations):
    start, end = datetime(2000, 1, 1), datetime(2001, 12, 31, 23, 59, 59)
    expected, at = [], start
    while at < end:
        stop = min(at + timedelta(days=60), end)
        expected.append((at, stop))
        at = stop + SECOND
    assert periods(planning.backfill_plan(stations, "2000-01-01", "2001-12-31 23:59:59", "days30", 2)) == expected


@pytest.mark.parametrize("granularity,n", [("year", 1), ("month", 1), ("months", 5), ("days30", 3), ("hour", 1)])
def test_periods_tile_the_range(stations, granularity, n):
    got = periods(planning.backfill_plan(stations, "2023-12-30", "2024-03-05 12:59:59", granularity, n))
    assert got[0][0] <= datetime(2023, 12, 30) and got[-1][1] == datetime(2024, 3, 5, 12, 59, 59)
    assert all(b[0] == a[1] + SECOND for a, b in zip(got, got[1:]))


def test_positions(spark):
    keys = [f"k{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(k,) for k in keys], "station_key string").repartition(7)
    got = {r["station_key"]: r["position"] for r in numbering.with_position(df, ["station_key"]).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_cost(spark):
    assert [planning.months_per_request(b) for b in (1, 5, 8, 10, 100)] == [6, 3, 2, 1, 1]
    df = spark.createDataFrame([(f"s{i:02d}",) for i in range(10)], "station_key string")
    cost = planning.plan_cost(df, "2000-01-01", "2025-12-31 23:59:59", 8)
    rows = {r["batch_id"]: r for r in cost.collect()}
    assert [rows[b]["stations"] for b in (0, 1)] == [8, 2]
    assert rows[0]["requests"] == 156 and rows[0]["single_requests"] == 1248
    days = sum(366 if cal.isleap(y) else 365 for y in range(2000, 2026))
    assert rows[1]["hours"] == days * 24 and rows[1]["data_points"] == days * 24 * 23 * 2
    # a chunk of two months lacks its last second, so each counts one day less
    assert rows[1]["estimated_records"] == (days - 156) * 24 * 2
    total = planning.cost_totals(cost).first()
    assert (total["requests"], total["single_requests"], total["saved_pct"]) == (312, 1560, 80.0)


def test_chunk_status(spark, stations):
    plan = planning.backfill_plan(stations, "2024-01-01", "2024-03-31 23:59:59", "month")
    loaded = spark.createDataFrame([("a", "2024-01", 700), ("a", "2024-01", 44)],
                                   "station_key string, month string, records long")
    failures = spark.createDataFrame(
        [("a", "2024-01", 1, "old"), ("a", "2024-02", 1, "timeout"), ("a", "2024-02", 2, "quota")],
        "station_key string, month string, failed_at int, error string")
    got = {(r["station_key"], r["month"]): (r["status"], r["records"], r["error"])
           for r in planning.chunk_status(plan, loaded, failures).collect()}
    assert got["a", "2024-01"] == ("complete", 744, None)
    assert got["a", "2024-02"] == ("failed", None, "quota")
    assert got["a", "2024-03"] == ("pending", None, None) == got["b", "2024-01"]


# --- manifests ---------------------------------------------------------------

ENTRY = "station_key string, year int, loaded_at string, file_path string, size_mb double"


def test_normalize_old_new_and_mixed_documents(spark):
    docs = spark.createDataFrame([
        ("old", "i", "n", ["2001", "2000"]),
        ("mixed", "i", "n", ["2001", '{"year":2003,"loaded_at":"t","size_mb":1.25}', '{"year":2002}']),
        ("none", "i", "n", []), ("null", "i", "n", None)],
        "station_key string, station_id string, station_name string, years_loaded array<string>")
    got = {(r["station_key"], r["year"]): (r["loaded_at"], r["file_path"], r["size_mb"])
           for r in manifest.normalize_manifest(docs).collect()}
    empty = (None, None, None)
    assert got == {("old", 2000): empty, ("old", 2001): empty, ("mixed", 2001): empty,
                   ("mixed", 2002): empty, ("mixed", 2003): ("t", None, 1.25)}


def test_manifest_documents_from_files(spark, tmp_path):
    from gaugelake.sources import manifests
    (tmp_path / "a.json").write_text("""{"station_key": "a", "station_name": "A",
      "years_loaded": [2001, {"year": 2002, "size_mb": 3.5, "file_path": "p"}], "summary": {"total_years": 2}}""")
    docs = manifests.read_manifests(spark, str(tmp_path))
    got = {(r["station_key"], r["year"], r["size_mb"], r["file_path"])
           for r in manifest.normalize_manifest(docs).collect()}
    assert got == {("a", 2001, None, None), ("a", 2002, 3.5, "p")}


def test_mark_loaded_inserts_only_what_is_absent(spark):
    old = spark.createDataFrame([("a", 2000, "t0", "p0", 1.0)], ENTRY)
    new = spark.createDataFrame([("a", 2000, "t9", "p9", 9.0), ("a", 2001, "t2", "p2", 2.0),
                                 ("a", 2001, "t1", "p1", 1.5)], ENTRY)
    once = manifest.mark_loaded(old, new)
    expected = {("a", 2000, "t0", "p0", 1.0), ("a", 2001, "t1", "p1", 1.5)}
    assert {tuple(r) for r in once.collect()} == expected
    assert {tuple(r) for r in manifest.mark_loaded(once, new).collect()} == expected


def test_recording_landed_files(spark, tmp_path):
    from documents import A, B, collection, coverage, hours, land

    from gaugelake.sources import manifests
    root, path = str(tmp_path / "raw"), str(tmp_path / "manifest")
    for station, year in ((A, 2023), (A, 2024), (B.replace("-", "_"), 2024)):
        land(root, station, year, "data.json", collection(coverage(A, hours("2024-01-01", 0, 20), {"T": list(range(20))})) )
    stations = spark.createDataFrame([("a", A), ("b", B)], "station_key string, id string")
    landed = manifests.landed_years(spark, root, stations)
    assert sorted((r["station_key"], r["year"]) for r in landed.collect()) == [("a", 2023), ("a", 2024), ("b", 2024)]
    manifests.record_loaded(landed.where("year = 2023"), path)
    first = manifests.read_manifest_table(spark, path).first()
    assert first["file_path"].endswith(f"station_id={A}/year=2023") and first["loaded_at"].endswith("Z")
    manifests.record_loaded(landed.withColumn("loaded_at", F.lit("later")), path)
    manifests.record_loaded(landed, path)
    table = manifests.read_manifest_table(spark, path)
    assert table.count() == 3 and table.where("year = 2023").first()["loaded_at"] == first["loaded_at"]


def test_missing_skipped_and_summary(spark, stations):
    table = spark.createDataFrame([("a", 2000, "t", "p", 1.1), ("a", 2002, "t", "p", 2.25), ("c", 2001, "t", None, None)], ENTRY)
    missing = manifest.missing_years(stations, table, 2000, 2002)
    assert sorted(map(tuple, missing.collect())) == [("a", 2001), ("b", 2000), ("b", 2001), ("b", 2002)]
    assert manifest.missing_years(stations, table, 2002, 2000).count() == 0
    plan = stations.select("station_key", F.lit(2000).alias("year"))
    assert [r["station_key"] for r in manifest.skip_loaded(plan, table).collect()] == ["b"]
    assert manifest.skip_loaded(plan, table, force=True).count() == 2
    summary = {r["station_key"]: r for r in manifest.manifest_summary(table).collect()}
    assert (summary["a"]["total_years"], summary["a"]["total_size_mb"], summary["a"]["years_loaded"]) == (
        2, 3.35, [2000, 2002])
    assert (summary["c"]["total_size_mb"], summary["c"]["start_year"], summary["c"]["end_year"]) == (0.0, 2001, 2001)
    assert manifest.manifest_totals(table).first().asDict() == {
        "stations": 2, "total_years": 3, "total_size_mb": 3.35}
    assert manifest.manifest_totals(table.limit(0)).first().asDict() == {
        "stations": 0, "total_years": 0, "total_size_mb": 0.0}


def test_ranges(spark, stations):
    schema = "station_key string, start timestamp, end timestamp, loaded_at timestamp, records long, layers array<string>"

    def r(key, start, end, at, n):
        return (key, datetime(*start), datetime(*end), datetime(2025, 1, at), n, ["silver"])

    ranges = spark.createDataFrame([
        r("a", (2000, 1, 1), (2001, 6, 30, 23), 2, 10), r("a", (1999, 1, 1), (2000, 3, 31, 22), 3, 5)], schema)
    row = manifest.track_ranges(ranges).first()
    # the range appended last counts, not the one that ends last
    assert (row["loaded_ranges"], row["total_records"], row["next_update_from"]) == (2, 15, datetime(2000, 3, 31, 23))
    assert manifest.range_totals(ranges).first().asDict() == {
        "total_records_loaded": 15, "total_stations_active": 1}
    rest = spark.createDataFrame([r("a", (2001, 7, 1), (2001, 12, 31, 23), 4, 5)], schema)
    whole = ranges.unionByName(rest)
    status = {x["station_key"]: x for x in manifest.range_status(stations, whole, 2000, 2001).collect()}
    assert (status["a"]["status"], status["a"]["historical_complete"]) == ("complete", True)
    assert (status["b"]["status"], status["b"]["total_records"], status["b"]["n_ranges"]) == ("unknown", 0, 0)
    assert manifest.range_status(stations, whole, 2000, 2002).where("station_key = 'a'").first()["status"] == "in_progress"
    # touching a year is not holding it
    assert manifest.range_status(stations, ranges, 2000, 2001).where("station_key = 'a'").first()["status"] == "in_progress"
    assert [x["station_key"] for x in manifest.stations_needing_load(stations, whole, 2000, 2001).collect()] == ["b"]


def test_complete_stations(spark):
    schema = "station_key string, start timestamp, end timestamp"
    ranges = spark.createDataFrame([
        ("new year", datetime(2000, 12, 31, 22), datetime(2001, 1, 1, 1)),
        ("hole", datetime(2000, 1, 1), datetime(2000, 5, 31, 22)),
        ("hole", datetime(2000, 6, 1), datetime(2001, 12, 31, 23)),
        ("covered hole", datetime(2000, 5, 1), datetime(2000, 7, 1)),
        ("covered hole", datetime(2000, 1, 1), datetime(2000, 5, 31, 22)),
        ("covered hole", datetime(2000, 6, 1), datetime(2001, 12, 31, 23)),
        ("covered hole", datetime(2000, 6, 1), datetime(2000, 6, 2)),
        ("nested", datetime(1999, 1, 1), datetime(2003, 1, 1)),
        ("nested", datetime(2000, 2, 1), datetime(2000, 3, 1)),
        ("late", datetime(2000, 1, 1, 0, 30), datetime(2002, 1, 1)),
        ("no end", datetime(2000, 1, 1), None), ("no start", None, datetime(2002, 1, 1)),
        ("backwards", datetime(2002, 1, 1), datetime(2000, 1, 1)),
    ], schema)

    def names(df):
        return sorted(x["station_key"] for x in df.collect())

    assert names(manifest.complete_stations(ranges, 2000, 2001)) == ["covered hole", "nested"]
    marked = spark.createDataFrame([("hole",), ("nested",), ("unseen",)], "station_key string")
    assert names(manifest.complete_stations(ranges, 2000, 2001, marked)) == [
        "covered hole", "hole", "nested", "unseen"]
    assert names(manifest.complete_stations(ranges.limit(0), 2000, 2001)) == []


def test_events(spark, tmp_path):
    from gaugelake.sources import manifests
    lines = [
        '{"event_type":"year_loaded","station_key":"a","year":2000,"file_size_mb":1.25,"duration_seconds":2.0}',
        '{"event_type":"year_loaded","station_key":"a","year":2001,"file_size_mb":1.5,"duration_seconds":3.0}',
        '{"event_type":"station_complete","station_key":"a","total_years":3,"completed_years":2,"skipped_years":1,"failed_years":0,"duration_seconds":6.5,"success":true}',
        '{"event_type":"station_complete","station_key":"b","total_years":2,"completed_years":0,"skipped_years":0,"failed_years":2,"duration_seconds":1.0,"success":false}',
        '{"event_type":"pipeline_complete","total_stations":2,"successful_stations":1,"failed_stations":1,"total_years_loaded":2,"total_years_skipped":1,"duration_seconds":7.5,"success":false}',
        '{"message":"free text"}', "not json"]
    (tmp_path / "log.json").write_text("\n".join(lines))
    events = manifests.read_events(spark, str(tmp_path))
    got = {(r["is_total"], r["station_key"]): r for r in manifest.ingest_event_summary(events).collect()}
    assert set(got) == {(False, "a"), (False, "b"), (True, None)}
    a, b, total = got[False, "a"], got[False, "b"], got[True, None]
    assert (a["loaded_years"], a["loaded_mb"], a["seconds_per_year"], a["elapsed_seconds"], a["success"]) == (2, 2.75, 2.5, 6.5, True)
    assert (b["loaded_years"], b["seconds_per_year"], b["failed_years"], b["success"]) == (0, None, 2, False)
    assert (total["loaded_years"], total["skipped_years"], total["elapsed_seconds"], total["success"]) == (2, 1, 7.5, False)
    run = manifest.pipeline_runs(events).first()
    assert (run["failed_stations"], run["seconds_per_year"]) == (1, 3.75)


# --- gaps --------------------------------------------------------------------

def test_gaps_against_brute_force(spark):
    import random
    random.seed(3)
    base = datetime(1969, 12, 25)
    hours = {s: sorted(random.sample(range(40_000), 3_000)) for s in ("x", "y")}
    rows = [(s, base + timedelta(hours=h, minutes=random.randrange(60))) for s in hours for h in hours[s] for _ in (0, 1)]
    table = spark.createDataFrame(rows, "station_id string, timestamp timestamp")
    got = {(r["station_id"], r["gap_start"], r["gap_end"], r["missing_hours"]) for r in gaps.detect_gaps(table).collect()}
    expected = {(s, base + timedelta(hours=a + 1), base + timedelta(hours=b - 1), b - a - 1)
                for s in hours for a, b in zip(hours[s], hours[s][1:]) if b - a > 1}
    assert got == expected
    complete = {r["station_id"]: r for r in gaps.completeness(table).collect()}
    for s in hours:
        missing = sum(g[3] for g in got if g[0] == s)
        assert complete[s]["observed_hours"] + missing == complete[s]["expected_hours"]
    assert gaps.detect_gaps(table, min_hours=24).count() == sum(g[3] >= 24 for g in got)


def test_gaps_of_a_range_include_its_ends(spark):
    rows = [("x", datetime(2024, 1, 2)), ("x", datetime(2024, 1, 3)), ("x", datetime(2024, 6, 1)), ("y", datetime(2020, 1, 1))]
    table = spark.createDataFrame(rows, "station_id string, timestamp timestamp")
    got = {(r["station_id"], r["gap_start"], r["gap_end"])
           for r in gaps.detect_gaps(table, start="2024-01-01", end="2024-01-04").collect()}
    assert got == {("x", datetime(2024, 1, 1), datetime(2024, 1, 1, 23)), ("x", datetime(2024, 1, 2, 1), datetime(2024, 1, 2, 23)),
                   ("x", datetime(2024, 1, 3, 1), datetime(2024, 1, 3, 23)), ("y", datetime(2024, 1, 1), datetime(2024, 1, 3, 23))}


def test_no_gaps(spark):
    one = spark.createDataFrame([("x", datetime(2024, 1, 1)), ("x", None)], "station_id string, timestamp timestamp")
    assert gaps.detect_gaps(one).count() == 0
    assert gaps.completeness(one).first()["completeness_pct"] == 100.0


def test_update_windows(spark):
    rows = [("x", datetime(2024, 1, 1)), ("x", datetime(2024, 1, 3)), ("x", datetime(2024, 2, 1))]
    table = spark.createDataFrame(rows, "station_id string, timestamp timestamp")
    got = {(r["reason"], r["start"], r["end"]) for r in gaps.update_windows(table, "2024-02-02", 48, 7).collect()}
    assert got == {("recent", datetime(2024, 1, 30), datetime(2024, 2, 2)),
                   ("gap", datetime(2024, 1, 1, 1), datetime(2024, 1, 2, 23))}
