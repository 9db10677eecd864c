import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugelake.functions import fixed_point
from gaugelake.operators import gold, queries
from gaugelake.schema import MAPPED_COLUMNS, QUALITY_FIELDS, SILVER

START = datetime(2024, 1, 1)
SCHEMA = ", ".join(f"{c} {SILVER[c].dataType.simpleString()}"
                   for c in [*MAPPED_COLUMNS, *(f.name for f in QUALITY_FIELDS)])


def table(spark, rows):
    names = [*MAPPED_COLUMNS, *(f.name for f in QUALITY_FIELDS)]
    base = dict.fromkeys(names)
    base.update(quality_score=1.0, quality_flags="", has_missing_values=False, has_outliers=False)
    return spark.createDataFrame([tuple({**base, **r}[n] for n in names) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def frame():
    """1200 hours of three stations, one of them with half of the rows, plus a station of nulls."""
    rng = np.random.default_rng(7)
    n = 1200
    df = pd.DataFrame({
        "station_id": np.where(rng.random(n) < 0.5, "hot", np.where(rng.random(n) < 0.5, "b", "c")),
        "timestamp": [START + timedelta(hours=7 * i) for i in range(n)],
        "temperature_celsius": rng.integers(-550, 551, n) / 10,
        "humidity_percent": rng.integers(0, 101, n).astype(float),
        "rainfall_mm": rng.integers(0, 50, n) / 10,
        "wind_speed_ms": rng.integers(0, 300, n) / 10,
        "wind_gust_ms": rng.integers(0, 400, n) / 10,
    })
    df.loc[rng.random(n) < 0.1, "temperature_celsius"] = np.nan
    df.loc[rng.random(n) < 0.1, "rainfall_mm"] = np.nan
    df.loc[rng.random(n) < 0.1, "wind_speed_ms"] = np.nan
    nulls = pd.DataFrame({"station_id": ["empty"] * 3, "timestamp": [START + timedelta(hours=h) for h in (2, 0, 1)]})
    return pd.concat([df, nulls], ignore_index=True)


@pytest.fixture(scope="module")
def silver(spark, frame):
    def plain(v):
        return None if pd.isna(v) else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v

    rows = [{k: plain(v) for k, v in r.items()} for r in frame.to_dict("records")]
    return table(spark, rows).cache()


def by_station(df):
    return {r["station_id"]: r.asDict() for r in df.collect()}


def half_up(value, digits):
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(value).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def exact_mean(values, digits):
    from fractions import Fraction
    values = [v for v in values if not pd.isna(v)]
    mean = Fraction(sum(round(v * 1000) for v in values), 1000 * len(values))
    scaled = mean * 10 ** digits
    return math.copysign(math.floor(abs(scaled) + Fraction(1, 2)), mean) / 10 ** digits


def test_fixed_point_rounds_ties_away_from_zero(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.15), (2, -0.1), (2, -0.15), (3, None)], "k int, v double")
    got = {r["k"]: r for r in df.groupBy("k").agg(
        fixed_point.mean("v", 2).alias("m"), fixed_point.total("v", 1).alias("t"),
        fixed_point.percent("count(v)", "count(*)").alias("p")).collect()}
    assert (got[1]["m"], got[1]["t"]) == (0.13, 0.3)
    assert (got[2]["m"], got[2]["t"]) == (-0.13, -0.3)
    assert (got[3]["m"], got[3]["t"], got[3]["p"]) == (None, None, 0.0)


def test_sums_of_many_decimals_and_large_values_are_exact(spark):
    rows = ([(1, 1e13), (1, 0.0004), (1, -1e13)] + [(2, 0.1)] * 10 + [(3, 1e18)] * 3
            + [(4, None), (4, 0.0004)] + [(5, i / 7) for i in range(1000)])
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r["k"]: r for r in df.groupBy("k").agg(
        fixed_point.mean("v", 2).alias("m"), fixed_point.total("v", 4).alias("t")).collect()}
    assert (got[1]["m"], got[1]["t"]) == (0.0, 0.0004)
    assert (got[2]["m"], got[2]["t"]) == (0.1, 1.0)
    assert (got[3]["m"], got[3]["t"], got[4]["t"]) == (1e18, 3e18, 0.0004)
    assert (got[5]["m"], got[5]["t"]) == (round(499.5 / 7, 2), round(499500 / 7, 4))
    parts = df.groupBy("k").agg(*fixed_point.partial("v", "p"))
    assert parts.where("k < 3").agg(fixed_point.partial_total("p", 4, merged=True)).first()[0] == 1.0004
    assert parts.where("k = 2").agg(fixed_point.partial_mean("p", 2, merged=True)).first()[0] == 0.1
    whole = df.where("k = 1 or k = 5")
    assert len({whole.repartition(n).agg(fixed_point.total("v")).first()[0] for n in (1, 3, 8)}) == 1


def test_fixed_point_does_not_depend_on_partitions(spark):
    df = spark.range(10_000).select((F.col("id") % 7 / 10).alias("v"))
    totals = {df.repartition(n).agg(fixed_point.total("v", 3)).first()[0] for n in (1, 3, 8)}
    assert len(totals) == 1


def test_station_comparison_and_stats(silver, frame):
    got, stats = by_station(queries.station_comparison(silver)), by_station(queries.station_stats(silver))
    for station, part in frame.groupby("station_id"):
        row = got[station]
        assert row["total_hours"] == len(part) == stats[station]["total_hours"]
        assert row["start_date"] == part["timestamp"].min()
        if station == "empty":
            assert row["avg_temp"] is None and row["total_rainfall_mm"] is None
            assert stats[station]["total_rainfall"] == 0.0
            continue
        assert row["avg_temp"] == exact_mean(part["temperature_celsius"], 2) == stats[station]["avg_temp"]
        assert row["avg_humidity"] == exact_mean(part["humidity_percent"], 1)
        assert row["total_rainfall_mm"] == round(part["rainfall_mm"].sum(), 1)


def test_distribution_against_ranks(silver, frame):
    nearest = by_station(queries.temperature_distribution(silver))
    linear = by_station(queries.temperature_distribution(silver, "linear", digits=3))
    approx = by_station(queries.temperature_distribution(silver, "approx"))
    for station, part in frame.groupby("station_id"):
        values = np.sort(part["temperature_celsius"].dropna())
        for name, q in queries.QUARTILES.items():
            if station == "empty":
                assert nearest[station][name] is None and linear[station][name] is None
                continue
            assert nearest[station][name] == values[int(np.floor(q * (len(values) - 1) + 0.5))]
            assert linear[station][name] == pytest.approx(np.quantile(values, q), abs=1e-9)
            assert abs(approx[station][name] - np.quantile(values, q)) <= 1.0
        if station != "empty":
            assert nearest[station]["std_temp"] == round(values.std(ddof=1), 2)
    with pytest.raises(ValueError):
        queries.temperature_distribution(silver, "other")


def test_distribution_of_many_values_in_few_degrees(spark):
    rng = np.random.default_rng(1)
    values = {None: np.array([1.0, 2.0]), "x": rng.normal(0, 0.4, 400).round(4), "y": np.array([-0.0, 0.0, 5e9]), "z": np.array([1.5])}
    rows = [{"station_id": s, "timestamp": START + timedelta(hours=i), "temperature_celsius": float(v)}
            for s, part in values.items() for i, v in enumerate(part)]
    got = by_station(queries.temperature_distribution(table(spark, rows), digits=4))
    for s, part in values.items():
        part = np.sort(part)
        for name, q in queries.QUARTILES.items():
            assert got[s][name] == part[int(np.floor(q * (len(part) - 1) + 0.5))]
    assert got["x"]["std_temp"] == pytest.approx(values["x"].std(ddof=1), abs=1e-4)
    assert got["z"]["std_temp"] is None


def test_deviation_of_more_than_three_decimals(spark):
    rows = [{"station_id": "a", "timestamp": START + timedelta(hours=i), "temperature_celsius": v}
            for i, v in enumerate((1.00004, 2.00004, 3.00008))]
    got = by_station(queries.temperature_distribution(table(spark, rows), digits=6))
    assert got["a"]["std_temp"] == 1.00002


def test_hottest_and_coldest(silver, frame):
    got = {(r["station_id"], r["extreme_type"]): r for r in queries.hottest_coldest(silver).collect()}
    assert len(got) == 8
    for station, part in frame.groupby("station_id"):
        for kind, ascending in (("HOTTEST", False), ("COLDEST", True)):
            first = part.sort_values(["temperature_celsius", "timestamp"], ascending=[ascending, True],
                                     na_position="last").iloc[0]
            assert got[station, kind]["timestamp"] == first["timestamp"]
    order = [(r["station_id"], r["extreme_type"]) for r in queries.hottest_coldest(silver).collect()]
    assert order == sorted(order, key=lambda k: (k[0], k[1] != "HOTTEST"))


def test_one_value_is_both_hottest_and_coldest(spark):
    one = table(spark, [{"station_id": "s", "timestamp": START, "temperature_celsius": 3.0}])
    assert [(r["extreme_type"], r["temp_celsius"]) for r in queries.hottest_coldest(one).collect()] == [
        ("HOTTEST", 3.0), ("COLDEST", 3.0)]


def test_correlations(silver, frame, spark):
    expected = frame[queries.CORRELATED].corr()
    for r in queries.correlation_matrix(silver).collect():
        for c in queries.CORRELATED:
            assert r[c] == pytest.approx(expected.loc[r["variable"], c], abs=6e-4)
    pairs = queries.correlation_pairs(silver).first()
    assert pairs["temp_rainfall"] == pytest.approx(
        expected.loc["temperature_celsius", "rainfall_mm"], abs=1e-6)
    constant = table(spark, [{"station_id": "s", "timestamp": START, "temperature_celsius": 1.0,
                              "humidity_percent": float(h)} for h in range(3)])
    assert queries.correlation_pairs(constant).first()["temp_humidity"] is None


def test_rankings(silver, frame):
    wind = frame.dropna(subset=["wind_speed_ms"]).sort_values(
        ["wind_speed_ms", "timestamp"], ascending=[False, True]).head(10)
    got = queries.windiest_hours(silver).collect()
    assert [(r["timestamp"], r["wind_speed_ms"]) for r in got] == list(zip(wind["timestamp"], wind["wind_speed_ms"]))
    frame = frame.assign(date=frame["timestamp"].dt.date)
    days = frame.groupby(["station_id", "date"])["rainfall_mm"].sum().round(3).reset_index().sort_values(
        ["rainfall_mm", "station_id", "date"], ascending=[False, True, True]).head(10)
    got = queries.rainiest_days(silver).collect()
    assert [(r["station_id"], r["date"], r["daily_rainfall"]) for r in got] == [
        tuple(r) for r in days[["station_id", "date", "rainfall_mm"]].itertuples(index=False)]


def test_wettest_day_without_any_value_sorts_last(spark):
    rows = [{"station_id": "s", "timestamp": START + timedelta(days=i), "rainfall_mm": v}
            for i, v in enumerate([None, 0.0, 2.0])]
    assert [r["total_rainfall_mm"] for r in gold.wettest_days(table(spark, rows)).collect()] == [2.0, 0.0, None]
    assert [r["daily_rainfall"] for r in queries.rainiest_days(table(spark, rows)).collect()] == [2.0, 0.0, 0.0]


def test_rain_wind_quality(silver, frame):
    rain, wind = by_station(queries.rainfall_comparison(silver)), by_station(queries.wind_statistics(silver))
    assert set(rain) == {"hot", "b", "c", "empty"} and set(wind) == {"hot", "b", "c"}
    for station, part in frame.groupby("station_id"):
        wet = int((part["rainfall_mm"] > 0).sum())
        assert rain[station]["hours_with_rain"] == wet
        assert rain[station]["pct_hours_with_rain"] == pytest.approx(100 * wet / len(part), abs=0.0501)
        if station in wind:
            assert wind[station]["hours_strong_wind"] == int((part["wind_speed_ms"] > 10).sum())
    assert [r["station_id"] for r in queries.rainfall_comparison(silver).collect()][-1] == "empty"
    quality = by_station(queries.quality_comparison(silver))
    assert quality["hot"]["avg_quality"] == 1.0 and quality["hot"]["outlier_pct"] == 0.0


def test_months_and_seasons(silver, frame):
    months = queries.monthly_averages(silver)
    parts = frame.groupby(["station_id", frame["timestamp"].dt.year, frame["timestamp"].dt.month]).size()
    assert {(r["station_id"], r["year"], r["month"]): r["hours"] for r in months.collect()} == dict(parts)
    assert len(queries.monthly_averages(silver, 12).collect()) == 12
    n = frame["timestamp"].dt.strftime("%Y%m").nunique() * frame["station_id"].nunique()
    assert queries.month_station_combinations(silver).first()[0] == n
    rows = queries.seasonal_temperatures(silver, 2024).collect()
    assert [r["season"] for r in rows if r["station_id"] == "hot"] == ["Winter", "Spring", "Summer", "Fall"]
    assert [r["season"] for r in rows if r["station_id"] == "empty"] == ["Winter"]


def test_null_profile(silver, frame):
    got = {r["column_name"]: r for r in queries.null_profile(silver).collect()}
    assert got["rainfall_mm"]["null_count"] == frame["rainfall_mm"].isna().sum()
    assert got["visibility_m"]["null_pct"] == 100.0
    assert "station_id" not in got and "quality_score" not in got


def test_windows_of_time(silver, spark):
    day = queries.hour_slice(silver, "empty", "2024-01-01")
    assert day.count() == 3
    assert queries.hour_slice(silver, "empty", "2024-01-01", 1).count() == 1
    recent = queries.recent_window(silver, "hot", "2024-02-08").collect()
    times = [r["timestamp"] for r in recent]
    assert times == sorted(times) and times[0] >= datetime(2024, 2, 1) and datetime(2024, 2, 8) <= times[-1] < datetime(2024, 2, 9)
    assert queries.recent_window(silver, "hot").count() == 0
    stations = spark.createDataFrame([("hot", "Twin", "N"), ("b", "Twin", "S"), ("c", "C", "S")],
                                     "id string, name string, region string")
    since = queries.temps_since(silver, stations, "2024-06-01")
    rows = silver.where("timestamp >= '2024-06-01' AND station_id IN ('hot', 'b')").toPandas()
    got = {r["station_name"]: r for r in since.collect()}
    assert set(got) == {"Twin", "C"}
    assert got["Twin"]["avg_temp"] == exact_mean(rows["temperature_celsius"], 2)


def test_gold(silver, frame, spark):
    stations = spark.createDataFrame([("hot", "Hot", "N"), ("b", "B", "S"), ("c", "C", "S")],
                                     "id string, name string, region string")
    regions = gold.monthly_by_region(silver, stations).collect()
    assert sum(r["hours"] for r in regions) == len(frame)
    south = next(r for r in regions if r["region"] == "S" and r["month"] == 5)
    part = frame[frame["station_id"].isin(["b", "c"]) & (frame["timestamp"].dt.month == 5)]
    assert south["stations"] == 2 and south["avg_temp"] == exact_mean(part["temperature_celsius"], 2)
    assert gold.monthly_comparison(silver, stations).where("region IS NULL").count() == 1
    events = gold.extreme_events(silver).toPandas()["event_type"].value_counts()
    assert events["frost"] == (frame["temperature_celsius"] < 0).sum()
    assert events["heat"] == (frame["temperature_celsius"] > 30).sum()
    assert events["strong_wind"] == (frame["wind_speed_ms"] * 3.6 > 60).sum()
    assert "heavy_rain" not in events
    daily = gold.daily_summary(silver).count()
    assert daily == len(frame.groupby(["station_id", frame["timestamp"].dt.date]))


def test_profiles(spark):
    df = spark.createDataFrame([(START, "s", 1.0, 2.0)], "timestamp timestamp, location_id string, T double, FF double")
    assert gold.param_profile(df, "full").columns == df.columns
    core = gold.param_profile(df, "core")
    assert core.columns == ["timestamp", "location_id", "T", "RH", "FF", "DD", "P", "U"]
    assert core.first()["P"] is None and core.first()["FF"] == 2.0
