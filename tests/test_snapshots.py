"""Versions of tables, replaced parts, corrections and the summary tables that follow them."""

import threading
from datetime import date, datetime, timedelta

import pytest
from documents import A, B, collection, coverage, enveloped, hours, land
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_silver import refined

from gaugelake.operators import gold, queries, silver
from gaugelake.plans import jobs, summaries
from gaugelake.sources import snapshots, tables
from gaugelake.sources.snapshots import ConcurrentChange, Snapshots
from gaugelake.streaming import incremental

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()),
                       T.StructField("part", T.IntegerType())])


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA).coalesce(1)


def content(table, version=None):
    return sorted(((r["k"], r["v"], r["part"]) for r in table.read(SCHEMA, version).collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "t"), ["part"], "k")


def test_replace_and_read_back_versions(spark, table):
    assert table.version() == 0 and content(table) == []
    assert table.replace(rows(spark, ("a", 1, 1), ("b", 2, 1), ("a", 3, 2))) == 1
    assert table.replace(rows(spark, ("c", 9, 1))) == 2
    assert content(table) == [("a", 3, 2), ("c", 9, 1)]
    assert content(table, 1) == [("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]
    table.append(rows(spark, ("d", 4, 3)))
    assert content(table) == [("a", 3, 2), ("c", 9, 1), ("d", 4, 3)]
    table.overwrite(rows(spark, ("z", 0, 7)))
    assert content(table) == [("z", 0, 7)]


def test_a_reader_sees_the_old_or_the_new_table(spark, table, monkeypatch):
    table.replace(rows(spark, ("a", 1, 1)))
    reader = table.read(SCHEMA)

    class CutOff(Exception):
        pass

    with monkeypatch.context() as m:  # files written, nothing published
        def cut_off(*_):
            raise CutOff
        m.setattr(Snapshots, "_put", cut_off)
        with pytest.raises(CutOff):
            table.replace(rows(spark, ("a", 2, 1)))
    assert content(table) == [("a", 1, 1)]
    table.replace(rows(spark, ("a", 3, 1)))
    assert content(table) == [("a", 3, 1)]
    assert [r["v"] for r in reader.collect()] == [1]  # its files are still there


def test_readers_during_many_replacements(spark, table):
    """Every part always has the same value as the others."""
    table.replace(rows(spark, *((k, 0, p) for k in "abc" for p in (1, 2))))
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append({r["v"] for r in table.read(SCHEMA).collect()})

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for v in range(1, 6):
            table.replace(rows(spark, *((k, v, p) for k in "abc" for p in (1, 2))))
    finally:
        done.set()
        reader.join()
    assert seen and all(len(values) == 1 for values in seen)


def test_concurrent_changes(spark, table):
    table.replace(rows(spark, ("a", 1, 1)))
    assert not table._put(1, [])  # the number is taken
    base = table.version()
    table.append(rows(spark, ("b", 2, 1)))
    with pytest.raises(ConcurrentChange):
        table.replace(rows(spark, ("a", 9, 1)), base)
    writers = [threading.Thread(target=lambda i=i: table.append(rows(spark, (f"w{i}", i, 5)))) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert len(content(table)) == 6


@pytest.mark.parametrize("most", [10_000, 1])
def test_replaced_values(spark, table, most, monkeypatch):
    """Also where a version may not name so many values and directories are rewritten."""
    monkeypatch.setattr(snapshots, "MOST_VALUES", most)
    table.replace(rows(spark, ("a", 1, 1), ("b", 2, 1), (None, 3, 1), ("a", 4, 2), ("b", 5, 2)))
    table.replace_values(rows(spark, ("a", 10, 1), ("a", 11, 1), (None, 12, 1)))
    assert content(table) == [("a", 10, 1), ("a", 11, 1), ("a", 4, 2), ("b", 2, 1), ("b", 5, 2), (None, 12, 1)]
    table.replace_values(rows(spark, ("a", 20, 1), ("c", 21, 3)), emptied=["b"])
    assert content(table) == [("a", 20, 1), ("a", 4, 2), ("c", 21, 3), (None, 12, 1)]
    before = content(table)
    table.compact(SCHEMA, lambda df: df.coalesce(1), 1)
    assert content(table) == before
    assert len(table.layers()) == 3


def test_only_what_is_replaced_is_written(spark, table, tmp_path):
    table.replace(rows(spark, *((f"k{i}", i, 1) for i in range(50))))
    table.replace_values(rows(spark, ("k7", 70, 1)))
    commits = {layer.commit: layer for layer in table.layers()}
    sizes = {c: spark.read.parquet(str(tmp_path / "t" / "data" / f"commit={c}")).count() for c in commits}
    assert sorted(sizes.values()) == [1, 50]
    assert {len(layer.hidden) for layer in commits.values()} == {0, 1}


def test_expired_versions(spark, table, tmp_path):
    for v in range(4):
        table.replace(rows(spark, ("a", v, 1)))
    unpublished = table.stage(rows(spark, ("a", 100, 1)))
    table.expire(keep=2)
    assert table.versions() == [3, 4] and content(table) == [("a", 3, 1)] and content(table, 3) == [("a", 2, 1)]
    assert len(list((tmp_path / "t" / "data").glob("commit=*"))) == 3
    assert (tmp_path / "t" / "data" / f"commit={unpublished}").is_dir()  # another job may be about to publish it


def test_values_of_odd_names(spark, tmp_path):
    schema = T.StructType.fromDDL("k string, part string")
    table = Snapshots(spark, str(tmp_path / "odd"), ["part"], "k")
    values = [("it's", "a b"), ('"q"', "x/y:z"), ("", None), ("%20", "a=b"), (None, "1")]
    table.replace(spark.createDataFrame(values, schema))
    table.replace_values(spark.createDataFrame([("it's", "a b"), (None, "1")], schema))
    got = {(r["k"], r["part"]) for r in table.read(schema).collect()}
    assert got == set(values)


# --- corrections ---------------------------------------------------------------

def hourly(spark, start, n, station=A, **values):
    return silver.to_silver(refined(spark, [
        {"location_id": station, "timestamp": start + timedelta(hours=i), **values} for i in range(n)]), ["seq"])


def temperatures(spark, path, layout=tables.BY_YEAR):
    return {(r["station_id"], r["timestamp"]): r["temperature_celsius"]
            for r in tables.scan_silver(spark, path, layout).collect()}


@pytest.mark.parametrize("layout", [tables.BY_YEAR, tables.YEARLY, tables.MONTHLY])
@pytest.mark.parametrize("keep", ["first", "last"])
def test_upsert(spark, tmp_path, layout, keep):
    path = str(tmp_path / "silver")
    start = datetime(2023, 12, 30)
    first = hourly(spark, start, 72, A, T=1.0).unionByName(hourly(spark, start, 72, B, T=2.0))
    assert len(incremental.upsert(first, path, layout, keep)) == 3
    again = hourly(spark, start + timedelta(hours=40), 48, A, T=5.0)
    for _ in range(2):
        days = incremental.upsert(again, path, layout, keep)
        assert sorted(days) == ["2023-12-31", "2024-01-01", "2024-01-02"]
    wanted = {(s, start + timedelta(hours=i)): t for s, t in ((A, 1.0), (B, 2.0)) for i in range(72)}
    for i in range(40, 88):
        key = (A, start + timedelta(hours=i))
        wanted[key] = 5.0 if keep == "last" else wanted.get(key, 5.0)
    assert temperatures(spark, path, layout) == wanted
    incremental.upsert(again.limit(0), path, layout, keep)
    untimed = silver.to_silver(refined(spark, [{"timestamp": None, "location_id": A, "T": 3.0}]), ["seq"])
    for _ in range(2):
        incremental.upsert(untimed, path, layout, keep)
    assert temperatures(spark, path, layout) == {**wanted, (A, None): 3.0}


def test_a_correction_touches_its_station_and_year(spark, tmp_path):
    path = str(tmp_path / "silver")
    start = datetime(2023, 12, 1)
    incremental.upsert(hourly(spark, start, 1000, A, T=1.0).unionByName(hourly(spark, start, 1000, B, T=2.0)), path)
    before = {layer.commit for layer in tables.stored(spark, path, tables.BY_YEAR).layers()}
    incremental.upsert(hourly(spark, datetime(2024, 1, 5), 2, A, T=9.0), path, keep="last")
    new = [x for x in tables.stored(spark, path, tables.BY_YEAR).layers() if x.commit not in before]
    assert [x.part for x in new] == ["year=2024"]
    written = spark.read.parquet(f"{path}/data/commit={new[0].commit}")
    assert [r[0] for r in written.select("station_id").distinct().collect()] == [A]
    with pytest.raises(ValueError):
        incremental.upsert(hourly(spark, start, 1), path, keep="newest")


def test_corrected_hours_arrive_as_in_a_recomputation(spark, tmp_path):
    root, path, checkpoint, gold_path = (str(tmp_path / n) for n in ("raw", "silver", "checkpoint", "gold"))

    def drop(station, name, at, day, first, *values):
        land(root, station, 2024, name, enveloped(collection(
            coverage(station, hours(day, first, len(values)), {"T": list(values)})), station, at))

    def load():
        incremental.incremental_load(spark, root, path, checkpoint, multiline=True, keep="last", gold_path=gold_path,
                                     max_files=1)

    drop(A, "1.json", "2025-01-01T00:00:00Z", "2024-01-01", 0, 1, 2, 3)
    drop(B, "1.json", "2025-01-01T00:00:00Z", "2024-01-03", 0, 4)
    load()
    drop(A, "2.json", "2025-01-02T00:00:00Z", "2024-01-01", 1, 20, 30, 4)  # within 48 hours: two corrected, one new
    load()
    load()
    got = temperatures(spark, path)
    assert [got[A, datetime(2024, 1, 1, h)] for h in range(4)] == [1, 20, 30, 4] and len(got) == 5

    names = jobs.refine(spark, root, str(tmp_path / "refined"), multiline=True)
    # the last copy counts, so the copies of an hour are ordered from the last ingestion on
    table = tables.scan_refined(spark, str(tmp_path / "refined"), names)
    latest = table.withColumn("_age", -F.unix_timestamp(F.col("_ingestion_timestamp").cast("timestamp")))
    full = silver.to_silver(latest, ["_age", "_source_file", "_pos"])
    assert {(r["station_id"], r["timestamp"]): r["temperature_celsius"] for r in full.collect()} == got
    daily = gold.daily_from_states(summaries.scan(spark, gold_path, "daily"))
    assert {tuple(r) for r in daily.collect()} == {tuple(r) for r in gold.daily_summary(full).collect()}


# --- summaries -----------------------------------------------------------------

def months(spark, states, stations):
    return {tuple(r) for r in gold.monthly_from_states(states, stations).collect()}


def test_stored_summaries(spark, tmp_path):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    with pytest.raises(FileNotFoundError):
        summaries.scan(spark, gold_path, "daily")
    start = datetime(2023, 12, 28)
    base = hourly(spark, start, 200, A, T=1.25, RH=30.0, U=50.0, FF=20.0).unionByName(hourly(spark, start, 200, B, T=-2.5, RH=-1.0))
    incremental.upsert(base, silver_path)
    summaries.build(spark, silver_path, gold_path)
    stations = spark.createDataFrame([(A, "Alpha", "N"), (B, "Beta", "N")], "id string, name string, region string")

    def check():
        table = tables.scan_silver(spark, silver_path)
        states = summaries.scan(spark, gold_path, "daily")
        assert {tuple(r) for r in gold.daily_from_states(states).collect()} == {tuple(r) for r in gold.daily_summary(table).collect()}
        assert months(spark, states, stations) == {tuple(r) for r in gold.monthly_comparison(table, stations).collect()}
        assert ({tuple(r) for r in gold.regions_from_states(states, stations).collect()}
                == {tuple(r) for r in gold.monthly_by_region(table, stations).collect()})
        for station in (A, B):
            assert ({tuple(r) for r in gold.hourly_station(summaries.scan(spark, gold_path, "hourly"), station).collect()}
                    == {tuple(r) for r in gold.hourly_station(table, station).collect()})
        events = summaries.scan(spark, gold_path, "events").drop("date", "year")
        assert {tuple(r) for r in events.collect()} == {tuple(r) for r in gold.extreme_events(table).collect()}
        wet = gold.wettest_from_states(states, stations, 3).collect()
        assert [r["total_rainfall_mm"] for r in wet] == [r["total_rainfall_mm"] for r in gold.wettest_days(table, 3).collect()]
        assert wet[0]["station_name"] in ("Alpha", "Beta")

    check()
    daily = summaries._stored(spark, gold_path, "daily")
    before = {layer.commit for layer in daily.layers()}
    day = datetime(2024, 1, 2)
    # warmer and dry: the day loses its events, and no other day is written
    days = incremental.upsert(hourly(spark, day, 24, A, T=7.0, RH=0.0), silver_path, keep="last")
    assert days == ["2024-01-02"]
    summaries.refresh(spark, silver_path, gold_path, days)
    new = {layer.commit for layer in daily.layers()} - before
    written = spark.read.parquet(*[f"{gold_path}/daily/data/commit={c}" for c in new])
    assert {r[0] for r in written.select("date").collect()} == {date(2024, 1, 2)} and written.count() == 2
    check()
    summaries.refresh(spark, silver_path, gold_path, [])
    untimed = silver.to_silver(refined(spark, [{"timestamp": None, "location_id": A, "T": 3.0}]), ["seq"])
    summaries.refresh(spark, silver_path, gold_path, incremental.upsert(untimed, silver_path))
    check()
    summaries.compact(spark, gold_path)
    check()


def test_hours_are_shuffled_once_at_most_for_the_summaries(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = hourly(spark, datetime(2023, 12, 31), 48, A, T=35.0, RH=30.0, U=50.0, FF=20.0).unionByName(
        hourly(spark, datetime(2023, 12, 31), 48, B, T=-2.5, RH=-1.0))
    tables.write_silver(rows, path)
    table = tables.scan_silver(spark, path)
    made = {}
    for name, kind in summaries.KINDS.items():
        whole = summaries._whole(name, table, tables.BY_YEAR)
        made[name] = whole._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, whole.collect())) == sorted(map(repr, kind.rows(table).collect()))
    # as they are read; and before an hour becomes several events
    assert "Exchange" not in made["hourly"]
    assert made["events"].index("Generate explode") < made["events"].index("Exchange rangepartitioning")


def test_many_refreshes_keep_few_layers(spark, tmp_path, monkeypatch):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    monkeypatch.setattr(summaries, "MOST_LAYERS", 3)
    for i in range(6):
        days = incremental.upsert(hourly(spark, datetime(2024, 1, 1 + i), 24, A, T=float(i)), silver_path, keep="last")
        summaries.refresh(spark, silver_path, gold_path, days)
    assert len(summaries._stored(spark, gold_path, "daily").layers()) <= 4
    states = summaries.scan(spark, gold_path, "daily")
    assert sorted(r["avg_temp"] for r in gold.daily_from_states(states).collect()) == [0, 1, 2, 3, 4, 5]


def test_gated_rows_go_to_the_quarantine(spark, tmp_path):
    path = str(tmp_path / "silver")
    start = datetime(2024, 1, 1)
    good = dict.fromkeys([c for c in jobs.SILVER_CODES], 1.0)
    rows = hourly(spark, start, 30, A, **good).unionByName(hourly(spark, start, 30, B, **{**good, "T": 99.0, "U": 300.0}))
    tables.write_routed(rows, silver.is_good(), path)

    def stations(table):
        return {r["station_id"]: r["count"] for r in table.groupBy("station_id").count().collect()}

    assert stations(tables.scan_silver(spark, path)) == {A: 30} and stations(tables.scan_quarantine(spark, path)) == {B: 30}
    # B has become good: it leaves the quarantine; another year stays as it is
    tables.write_routed(hourly(spark, datetime(2023, 1, 1), 5, B, **{**good, "T": 99.0, "U": 300.0}), silver.is_good(), path)
    tables.write_routed(hourly(spark, start, 30, A, **good).unionByName(hourly(spark, start, 30, B, **good)), silver.is_good(), path)
    assert stations(tables.scan_silver(spark, path)) == {A: 30, B: 30}
    assert stations(tables.scan_quarantine(spark, path)) == {B: 5}
    # other jobs go on with the silver table alone
    incremental.upsert(hourly(spark, start, 31, A, **good), path, keep="last")
    assert stations(tables.scan_silver(spark, path)) == {A: 31, B: 30}
    assert tables.scan_quarantine(spark, str(tmp_path / "other")).count() == 0


def test_nan_is_no_value(spark):
    nan = float("nan")
    table = spark.createDataFrame(
        [("s", datetime(2024, 1, 1, h), t, 50.0, r, 3.0, 4.0, 1.0, False, False) for h, (t, r) in enumerate(
            [(1.0, nan), (nan, 2.0), (2.0, 4.0)])],
        "station_id string, timestamp timestamp, temperature_celsius double, humidity_percent double, rainfall_mm double,"
        " wind_speed_ms double, wind_gust_ms double, quality_score double, has_outliers boolean, has_missing_values boolean")
    row = queries.station_comparison(table).first()
    assert (row["avg_temp"], row["min_temp"], row["max_temp"], row["total_rainfall_mm"]) == (1.5, 1.0, 2.0, 6.0)
    assert queries.rainfall_comparison(table).first()["avg_rainfall_per_hour"] == 3.0
    assert [r["temp_celsius"] for r in queries.hottest_coldest(table).collect()] == [2.0, 1.0]
    assert gold.daily_summary(table).first()["avg_temp"] == 1.5
    assert queries.temperature_distribution(table).first()["median_temp"] in (1.0, 2.0)
    text = spark.createDataFrame([("NaN",), ("1.5",), ("x",)], "T string")
    assert [r[0] for r in silver.map_silver_schema(text).select("temperature_celsius").collect()] == [None, 1.5, None]


def test_thousands_of_hidden_values_go_to_spark_as_one_text(spark, monkeypatch):
    calls, lit = [], F.lit
    values = (*[f"s{i}" for i in range(3000)], "it's", "back\\slash", "", "s{1}", None)
    monkeypatch.setattr(snapshots.F, "lit", lambda v: calls.append(v) or lit(v))
    outside = snapshots._outside("k", T.StringType(), values)
    monkeypatch.undo()
    assert len(calls) < 10
    table = spark.createDataFrame([(v,) for v in ["s7", "s3000", "it's", "its", "back\\slash", "backslash", "", " ", "s{1}", None]], "k string")
    assert {r["k"] for r in table.where(outside).collect()} == {"s3000", "its", "backslash", " "}
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), (None,)], "d string").selectExpr("CAST(d AS date) AS d")
    kept = days.where(snapshots._outside("d", T.DateType(), ("2024-01-02",))).selectExpr("CAST(d AS string) AS d")
    assert {r["d"] for r in kept.collect()} == {"2024-01-01", None}


def test_only_what_an_upsert_merges_is_shuffled(spark):
    old = spark.createDataFrame([(A, 2023, 1), (A, 2024, 2), (B, 2023, 3), (None, None, 4)], "station_id string, year int, v int")
    new = old.where("v in (1, 4)")
    touched = incremental._of_touched(old, new, ["station_id", "year"])
    assert "BroadcastHashJoin" in touched._jdf.queryExecution().executedPlan().toString()
    assert {r["v"] for r in touched.collect()} == {1, 4}
