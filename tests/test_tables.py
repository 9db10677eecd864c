from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from documents import A, B, collection, coverage, enveloped, hours, land
from pyspark.sql import functions as F
from test_silver import refined

from gaugelake.operators import silver
from gaugelake.plans import jobs
from gaugelake.schema import MAPPED_COLUMNS, SILVER
from gaugelake.sources import files, registry, tables
from gaugelake.streaming import incremental


def hourly(spark, n, station="s", start=datetime(2023, 12, 31), **values):
    return silver.to_silver(refined(spark, [
        {"location_id": station, "timestamp": start + timedelta(hours=i), **values} for i in range(n)]), ["seq"])


def test_silver_round_trip(spark, tmp_path):
    path = str(tmp_path / "silver")
    with pytest.raises(FileNotFoundError):
        tables.scan_silver(spark, path)
    table = hourly(spark, 48, station=A).unionByName(hourly(spark, 24, station=B))
    tables.write_silver(table, path, tables.MONTHLY)
    back = tables.scan_silver(spark, path, tables.MONTHLY)
    assert back.columns == [*(f.name for f in SILVER if f.name != "station_id"), "station_id", "year", "month"]
    same = [c for c in table.columns if not c.startswith("_")]
    assert back.select(same).exceptAll(table.select(same)).count() == 0
    assert back.count() == 72
    # the directory keeps the id as it is, so the column needs no translation
    commit = next((tmp_path / "silver" / "data").iterdir())
    assert (commit / f"station_id={A}" / "year=2023" / "month=12").is_dir()
    assert tables.count_stations(back).first()["stations"] == 2
    plan = tables.count_stations(back)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_filters_reach_the_scan(spark, tmp_path):
    from gaugelake.operators import queries
    path = str(tmp_path / "silver")
    tables.write_silver(hourly(spark, 48, station=A), path)
    table = tables.scan_silver(spark, path)
    plan = queries.seasonal_temperatures(table, 2024)._jdf.queryExecution().executedPlan().toString()
    assert "year#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(timestamp" in plan.split("PushedFilters:")[1]
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "rainfall_mm" in schema and "humidity" not in schema
    plan = queries.recent_window(table, A, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(station_id,{A})" in plan.split("PushedFilters:")[1]
    tables.write_silver(hourly(spark, 48, station=A), path + "2", tables.MONTHLY)
    table = tables.scan_silver(spark, path + "2", tables.MONTHLY)
    plan = queries.recent_window(table, A, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert A in plan.split("PartitionFilters:")[1].split("]")[0]


def test_a_large_directory_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "silver")
    saved = {k: spark.conf.get(k, None) for k in (
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
        rows = spark.range(0, 20_000, 1, 4).select(
            F.lit("hot").alias("station_id"), F.timestamp_seconds(F.col("id")).alias("timestamp"),
            F.rand(1).alias("v"))
        tables.stored(spark, path, tables.MONTHLY).replace(tables.clustered(rows, tables.MONTHLY))
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    written = list((tmp_path / "silver" / "data").glob("commit=*/station_id=hot/year=1970/month=1/*.parquet"))
    assert len(written) > 1
    assert spark.read.parquet(path + "/data").count() == 20_000
    # neighbouring times lie in one file
    spans = [r for r in spark.read.parquet(path + "/data").groupBy(F.input_file_name()).agg(
        F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).orderBy("a").collect()]
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_atomic_replace_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)], "station_id string, year int, v double")
    files.atomic_replace(rows, path, ["station_id", "year"])
    for _ in range(2):
        files.atomic_replace(rows.where("v = 2.0").withColumn("v", F.lit(9.0)), path, ["station_id", "year"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1.0, 3.0, 9.0]


def test_silver_of_another_writer(spark, tmp_path):
    folder = tmp_path / "silver" / f"station_id={A.replace('-', '_')}" / "year=2024" / "month=01"
    folder.mkdir(parents=True)
    n = 3
    frame = pd.DataFrame({c: [1.0] * n for c in MAPPED_COLUMNS})
    frame["timestamp"] = pd.to_datetime([f"2024-01-01T0{h}:00:00.000001Z" for h in range(n)])
    frame["station_id"] = A
    frame["weather_code"] = pd.array([1, None, 3], dtype="Int64")
    frame["radiation_index"] = pd.array([1, 2, 3], dtype="Int64")
    frame["evaporation_mm"] = None  # all null: stored without a type
    frame["quality_score"], frame["quality_flags"] = 0.8, ""
    frame["has_missing_values"], frame["has_outliers"] = True, False
    frame["_processed_timestamp"] = pd.Timestamp.now(tz="UTC")
    frame["_bronze_to_silver_version"] = "1.0"
    frame = frame.astype({"timestamp": "datetime64[ns, UTC]", "_processed_timestamp": "datetime64[ns, UTC]"})
    frame.to_parquet(folder / "20240101_to_20240131.parquet", index=False)
    got = tables.scan_foreign_silver(spark, str(tmp_path / "silver")).orderBy("timestamp").collect()
    assert [r["timestamp"].replace(tzinfo=timezone.utc).isoformat() for r in got][0] == "2024-01-01T00:00:00.000001+00:00"
    assert {r["station_id"] for r in got} == {A} and {r["evaporation_mm"] for r in got} == {None}
    assert [r["weather_code"] for r in got] == [1, None, 3]


def test_reconcile_union(spark):
    a = spark.createDataFrame([("s", "3", 1.0)], "station_id string, cloud_cover_octas string, visibility_m double")
    b = spark.createDataFrame([("t", "x", 7)], "station_id string, cloud_cover_octas string, radiation_index long")
    c = spark.createDataFrame([("u", 5, 6)], "station_id string, cloud_cover_octas int, v int").toDF(
        "station_id", "cloud_cover_octas", "cloud_cover_octas")
    df = tables.reconcile_union([a, b, c])
    got = {r["station_id"]: (r["cloud_cover_octas"], r["visibility_m"], r["radiation_index"]) for r in df.collect()}
    assert got == {"s": (3.0, 1.0, None), "t": (None, None, 7.0), "u": (5.0, None, None)}


def test_export_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    tables.export_csv(hourly(spark, 30, station=A).unionByName(hourly(spark, 3, station=B)), path, A,
                      ["temperature_celsius", "rainfall_mm"])
    text = [line for f in sorted((tmp_path / "csv").glob("*.csv")) for line in f.read_text().splitlines()
            if not line.startswith("timestamp")]
    assert len(text) == 30 and text == sorted(text)
    assert text[0] == "2023-12-31 00:00:00,1.0,0.0"


def test_registry(spark, tmp_path):
    (tmp_path / "stations.json").write_text("""{"version": "1", "stations": {
      "a": {"id": "0-1", "name": "A", "latitude": 52.1, "active": true, "region": "East"},
      "b": {"id": "0-2", "name": "B", "active": false}, "c": {"id": "0-3", "name": "C"}},
      "station_groups": {"coast": ["a", "c"], "none": []}}""")
    docs = registry.read_registry(spark, str(tmp_path))
    stations = registry.station_dim(docs)
    assert stations.count() == 3
    assert [r["station_key"] for r in registry.active_stations(stations).collect()] == ["a"]
    assert registry.lookup_station(stations, "b").first()["name"] == "B"
    with pytest.raises(ValueError):
        registry.lookup_station(stations, "z")
    members = registry.group_members(docs)

    def group(names):
        return sorted(r["station_key"] for r in registry.station_group(stations, members, names).collect())

    assert group("coast") == ["a", "c"] and group("unknown") == [] and group("none") == []
    assert group("a, b") == ["a", "b"]


# --- incremental load ---------------------------------------------------------

def temperatures(spark, path):
    return {(r["station_id"], r["timestamp"]): r["temperature_celsius"]
            for r in tables.scan_silver(spark, path).collect()}


def test_incremental_equals_full_recomputation(spark, tmp_path):
    root, path, checkpoint = (str(tmp_path / n) for n in ("raw", "silver", "checkpoint"))

    def drop(station, name, at, first, *values):
        land(root, station, 2024, name, enveloped(collection(
            coverage(station, hours("2024-01-01", first, len(values)), {"T": list(values)})), station, at))

    def load():
        incremental.incremental_load(spark, root, path, checkpoint, multiline=True, quarantine=str(tmp_path / "bad"))

    drop(A, "1.json", "2025-01-01T00:00:00Z", 0, 1, 2, 3)
    load()
    # the next run looks back: two hours come again with other values, one is new
    drop(A, "2.json", "2025-01-02T00:00:00Z", 1, 20, 30, 4)
    drop(B, "2.json", "2025-01-02T00:00:00Z", 0, 7)
    load()
    load()  # nothing new
    land(root, A, 2024, "3.json", '{"coverages": [')
    load()
    assert [f.name for f in (tmp_path / "bad").glob("batch=*/*.json")]
    got = temperatures(spark, path)
    assert [got[A, datetime(2024, 1, 1, h)] for h in range(4)] == [1, 2, 3, 4]
    assert got[B, datetime(2024, 1, 1)] == 7 and len(got) == 5

    names = jobs.refine(spark, root, str(tmp_path / "refined"), multiline=True, quarantine=str(tmp_path / "bad2"))
    assert spark.read.json(str(tmp_path / "bad2")).count() == 1
    jobs.clean(spark, str(tmp_path / "refined"), str(tmp_path / "full"), names)
    assert temperatures(spark, str(tmp_path / "full")) == got

    table = tables.stored(spark, path, tables.BY_YEAR)
    assert len(table.layers()) > 1
    incremental.compact(spark, path)
    assert temperatures(spark, path) == got and len(table.layers()) == 1


def test_repeating_a_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "silver")
    untimed = silver.to_silver(refined(spark, [{"timestamp": None, "location_id": A}]), ["seq"])
    batch = hourly(spark, 24, station=A).unionByName(untimed)
    incremental.insert_new(batch.limit(10), path)
    incremental.insert_new(batch, path)
    incremental.insert_new(batch, path)
    incremental.insert_new(batch.limit(0), path)
    incremental.insert_new(untimed, path)
    assert tables.scan_silver(spark, path).count() == 25


@pytest.mark.parametrize("layout", [tables.BY_YEAR, tables.YEARLY, tables.MONTHLY])
def test_rows_are_deduplicated_in_the_shuffle_that_places_them(spark, tmp_path, layout):
    start = datetime(2023, 12, 31, 20)
    raw = refined(spark, [{"location_id": s, "timestamp": None if i == 7 else start + timedelta(hours=i % 6), "T": float(i)}
                          for s in (A, None) for i in range(10)])
    placed = tables.silver_to_write(raw, ["seq"], layout)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan[plan.index("Exchange"):]
    path = str(tmp_path / "silver")
    tables.write_silver(placed, path, layout, placed=True)
    columns = ["station_id", "timestamp", "temperature_celsius", "quality_score", "quality_flags"]
    got, wanted = tables.scan_silver(spark, path, layout).select(columns), silver.to_silver(raw, ["seq"]).select(columns)
    assert got.count() == 14
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0
    routed = str(tmp_path / "routed")
    tables.write_routed(placed, F.col("temperature_celsius") < 3, routed, layout, placed=True)
    both = [tables.scan_silver(spark, routed, layout), tables.scan_quarantine(spark, routed, layout)]
    assert [t.count() for t in both] == [6, 8]
