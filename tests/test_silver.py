import itertools
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gaugelake.operators import silver
from gaugelake.schema import MAPPED_COLUMNS, SILVER, SILVER_DECLARED, SILVER_MAPPING

FULL = {"T": 1.0, "T10N": 1.0, "TD": 1.0, "U": 50.0, "RH": 0.0, "DR": 0.0, "DD": 10.0, "FF": 3.0,
        "FX": 5.0, "FH": 3.0, "Q": 1.0, "SQ": 1.0, "VV": 1.0, "N": 1.0, "WW": 1.0, "EE": 1.0, "IX": 1.0}
COLUMNS = ["timestamp", "location_id", "latitude", "longitude", *FULL, "seq"]
SCHEMA = "timestamp timestamp, location_id string, latitude double, longitude double, " + ", ".join(
    f"{c} double" for c in FULL) + ", seq long"


def refined(spark, rows):
    """Rows as dicts of the values that differ from a faultless one."""
    out = []
    for i, r in enumerate(rows):
        base = {"timestamp": datetime(2024, 1, 1, i % 24), "location_id": "s", "latitude": 1.0,
                "longitude": 2.0, **FULL, "seq": i}
        out.append(tuple({**base, **r}[c] for c in COLUMNS))
    return spark.createDataFrame(out, SCHEMA)


def cleaned(spark, rows, **options):
    return silver.to_silver(refined(spark, rows), ["seq"], **options).orderBy("timestamp").collect()


def test_columns_of_the_stored_table(spark):
    df = silver.to_silver(refined(spark, [{}]), ["seq"])
    assert df.columns == [f.name for f in SILVER] and len(df.columns) == 27
    assert [f.dataType for f in df.schema] == [f.dataType for f in SILVER]
    assert len(MAPPED_COLUMNS) == 21 and len(SILVER_DECLARED) == 22


def test_absent_parameter_is_null_and_makes_every_row_missing(spark):
    df = refined(spark, [{}, {}]).drop("EE").withColumn("EXTRA", F.lit(1.0))
    rows = silver.to_silver(df, ["seq"]).collect()
    assert all(r["evaporation_mm"] is None and r["has_missing_values"] and r["quality_score"] == 0.8
               for r in rows)
    assert "EXTRA" not in rows[0]


@pytest.mark.parametrize("code,low,high", [
    ("T", -50, 50), ("U", 0, 100), ("RH", 0, 200), ("FF", 0, 50), ("DD", 0, 360)])
def test_range_ends_are_plausible(spark, code, low, high):
    values = [low, high, low - 0.1, high + 0.1, None, float("nan")]
    rows = cleaned(spark, [{code: None if v is None else float(v)} for v in values])
    assert [r["has_outliers"] for r in rows] == [False, False, True, True, False, False]
    name = SILVER_MAPPING[code]
    assert [r["quality_flags"] for r in rows] == ["", "", f"{name}_outlier;", f"{name}_outlier;", "", ""]
    assert [r["has_missing_values"] for r in rows] == [False] * 4 + [True] * 2
    assert [r["quality_score"] for r in rows] == [1.0, 1.0, 0.7, 0.7, 0.8, 0.8]


def test_trace_rain(spark):
    row = cleaned(spark, [{"RH": -1.0}])[0]
    assert (row["rainfall_mm"], row["has_outliers"], row["quality_score"]) == (0.0, True, 0.7)
    row = cleaned(spark, [{"RH": -1.0}], sentinel_first=True)[0]
    assert (row["rainfall_mm"], row["has_outliers"], row["quality_score"]) == (0.0, False, 1.0)
    row = cleaned(spark, [{"RH": -0.5}], sentinel_first=True)[0]
    assert (row["rainfall_mm"], row["has_outliers"]) == (-0.5, True)


def test_score_of_every_combination(spark):
    faults = {"T": 99.0, "U": 200.0, "RH": 500.0, "FF": 99.0, "DD": 999.0}
    cases = [c for n in range(6) for c in itertools.combinations(faults, n)]
    rows = [{**{k: faults[k] for k in c}, "TD": None if missing else 1.0,
             "timestamp": datetime(2024, 1, 1 + i // 24, i % 24)}
            for i, (c, missing) in enumerate(itertools.product(cases, (False, True)))]
    got = cleaned(spark, rows)
    for (c, missing), r in zip(itertools.product(cases, (False, True)), got, strict=True):
        assert math.isclose(r["quality_score"], max(0.0, 1.0 - 0.2 * missing - 0.3 * len(c)), abs_tol=1e-9)
        assert r["quality_flags"] == "".join(f"{SILVER_MAPPING[k]}_outlier;" for k in faults if k in c)
        assert (r["quality_score"] == 1.0) == (not r["has_outliers"] and not r["has_missing_values"])


def test_flag_array(spark):
    df = silver.map_silver_schema(refined(spark, [{"T": 99.0, "DD": -1.0}, {}]), keep=["seq"])
    got = [r["outlier_flags"] for r in silver.outlier_flags(df).orderBy("seq").collect()]
    assert got == [["temperature_celsius", "wind_direction_degrees"], []]


def test_first_copy_stays(spark):
    hour = datetime(2024, 1, 1)
    rows = [{"timestamp": hour, "T": float(t), "seq": s} for t, s in ((5, 3), (6, 1), (7, 2))]
    rows += [{"timestamp": hour, "location_id": "other"}, {"timestamp": None}, {"timestamp": None}]
    df = refined(spark, rows)
    for parts in (1, 3, 7):
        got = silver.dedup_first(silver.map_silver_schema(df.repartition(parts), ["seq"]), ["seq"])
        assert {(r["station_id"], r["timestamp"], r["temperature_celsius"]) for r in got.collect()} == {
            ("s", hour, 6.0), ("other", hour, 1.0), ("s", None, 1.0)}
        again = silver.dedup_first(got, ["seq"])
        assert again.exceptAll(got).count() == 0 and got.exceptAll(again).count() == 0


def test_hot_hour_is_cut_down_before_the_shuffle(spark):
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.lit("s").alias("station_id"), F.col("id").alias("seq"))
    df = df.withColumn("timestamp", F.timestamp_seconds(F.col("k") * 3600))
    result = silver.dedup_first(df, ["seq"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    expected = len({0 if i % 3 == 0 else i for i in range(200_000)})
    assert result.count() == expected
    assert result.where("k = 0").first()["seq"] == 0


def test_a_crowded_hour_is_thinned_where_copies_are_gathered_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(silver, "_CROWD", 1000)
    df = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.call_function("div", F.col("id"), F.lit(2))).alias("k"),
        F.lit("s").alias("station_id"), (-F.col("id")).alias("seq"))
    df = df.withColumn("timestamp", F.timestamp_seconds(F.col("k") * 3600))
    thin = silver.thin_crowds(df, ["seq"])
    assert thin.where("k = 0").count() == 1
    got, wanted = silver.dedup_first(thin, ["seq"]), silver.dedup_first(df, ["seq"])
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0
    monkeypatch.setattr(silver, "_CROWD", 10_000)
    assert silver.thin_crowds(df, ["seq"]) is df


def test_enforce_types(spark):
    df = spark.createDataFrame([("7", "x", 1, float("nan"))],
                               "weather_code string, visibility_m string, humidity_percent int, dewpoint_celsius double")
    out = silver.enforce_types(df)
    assert out.columns == [f.name for f in SILVER_DECLARED]
    row = out.first()
    assert (row["weather_code"], row["visibility_m"], row["humidity_percent"], row["dewpoint_celsius"]) == (
        7, None, 1.0, None)
    assert row["air_pressure_hpa"] is None


def test_report_and_gate(spark):
    hour = datetime(2024, 1, 1)
    rows = [{"timestamp": hour}, {"timestamp": hour, "T": 99.0}, {}, {"T": 99.0, "U": 500.0}, {"Q": None}]
    raw = refined(spark, rows)
    table = silver.to_silver(raw, ["seq"])
    report = silver.quality_report(raw, table)
    assert report.first().asDict() == {
        "station_id": "s", "rows_in": 5, "rows_out": 4, "duplicates_removed": 1, "avg_quality": 0.8,
        "missing_pct": 25.0, "outlier_pct": 25.0}
    assert silver.quality_totals(report).first().asDict() == {
        "batches": 1, "rows_in": 5, "rows_out": 4, "duplicates_removed": 1}
    gate = silver.quality_gate(table).first()
    assert (gate["good_rows"], gate["quarantined_rows"], gate["passed"]) == (3, 1, False)
    assert silver.quality_gate(table, max_outlier_pct=25.0).first()["passed"]
    good, quarantine = silver.split_by_quality(table)
    assert (good.count(), quarantine.count()) == (3, 1)
