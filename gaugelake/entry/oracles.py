"""The results of the registered queries as SQL over the star-schema tables."""

from __future__ import annotations

from gaugelake.derive import (
    COLLECTION,
    INGESTED_AT,
    LINE_ORDER,
    LOAD_SQL,
    OBSERVATION_SQL,
    PARAMETERS,
    SOURCE_API,
    STATION_SQL,
)
from gaugelake.entry import queries as q
from gaugelake.plans.jobs import SILVER_CODES
from gaugelake.schema import (
    LOOKBACK_HOURS,
    MAPPED_COLUMNS,
    MAX_GAP_DAYS,
    SILVER_MAPPING,
    THRESHOLDS,
)

_LINE = ", ".join(LINE_ORDER)
_PARAMS = ", ".join(PARAMETERS)


def _mean(column: str, digits: int) -> str:
    """Mean of thousandths, rounded half away from zero in whole numbers."""
    s = f"sum(CAST(round({column} * 1000) AS BIGINT))"
    k = f"(count({column}) * {10 ** (3 - digits)})"
    return (f"CASE WHEN count({column}) > 0 THEN CAST(sign({s}) * ((abs({s}) * 2 + {k}) // (2 * {k}))"
            f" AS DOUBLE) / {10 ** digits} END")


def _total(column: str, digits: int) -> str:
    s = f"sum(CAST(round({column} * 1000) AS BIGINT))"
    k = 10 ** (3 - digits)
    return f"CAST(sign({s}) * ((abs({s}) * 2 + {k}) // {2 * k}) AS DOUBLE) / {10 ** digits}"


def _pct(part: str, whole: str, digits: int = 1) -> str:
    return (f"CASE WHEN {whole} > 0 THEN CAST((({part}) * {200 * 10 ** digits} + {whole})"
            f" // (2 * {whole}) AS DOUBLE) / {10 ** digits} END")


def _corr(a: str, b: str, digits: int) -> str:
    return f"round(corr({a}, {b}), {digits}) + 0.0"


_RENAMED = ", ".join(
    (f"CAST({code} AS BIGINT)" if code in ("WW", "IX") else code) + f" AS {name}"
    for code, name in SILVER_MAPPING.items())
_MISSING = "(" + " OR ".join(f"{c} IS NULL" for c in MAPPED_COLUMNS) + ")"


def _outlier(column: str, trace_first: bool = False) -> str:
    low, high = THRESHOLDS[column]
    value = "CASE WHEN rainfall_mm = -1 THEN 0 ELSE rainfall_mm END" \
        if trace_first and column == "rainfall_mm" else column
    return f"coalesce(({value}) < {low} OR ({value}) > {high}, false)"


_ANY_OUTLIER = "(" + " OR ".join(_outlier(c) for c in THRESHOLDS) + ")"
_FLAGS = " || ".join(f"CASE WHEN {_outlier(c)} THEN '{c}_outlier;' ELSE '' END" for c in THRESHOLDS)
_SCORE = (f"CAST(greatest(10 - 2 * CAST({_MISSING} AS INTEGER) - 3 * ("
          + " + ".join(f"CAST({_outlier(c)} AS INTEGER)" for c in THRESHOLDS)
          + "), 0) AS DOUBLE) / 10")
_CLEANED = ", ".join(
    "CASE WHEN rainfall_mm = -1 THEN CAST(0 AS DOUBLE) ELSE rainfall_mm END AS rainfall_mm"
    if c == "rainfall_mm" else c for c in MAPPED_COLUMNS)


def _silver_from(order: str) -> str:
    return f"""
mapped AS (SELECT {_RENAMED}, {_LINE}, l_returnflag, {_PARAMS} FROM obs),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY station_id, timestamp ORDER BY {order}) AS rn FROM mapped) WHERE rn = 1),
silver AS (SELECT {_CLEANED}, {_SCORE} AS quality_score, {_FLAGS} AS quality_flags,
  {_MISSING} AS has_missing_values, {_ANY_OUTLIER} AS has_outliers FROM firsts)"""


_OBS = f"WITH obs AS ({OBSERVATION_SQL})"
_MAPPED = f"{_OBS}, mapped AS (SELECT {_RENAMED}, {_LINE} FROM obs)"
_SILVER = f"{_OBS}, {_silver_from(_LINE)}"
_STATIONS = f"WITH stations AS ({STATION_SQL})"
_SILVER_STATIONS = f"{_SILVER}, stations AS ({STATION_SQL})"
_LOADS = f"WITH loads AS ({LOAD_SQL})"
_LOADS_STATIONS = f"{_LOADS}, stations AS ({STATION_SQL})"
_LINE_KEY = f"station_id, timestamp, {_LINE}"
_SILVER_COLUMNS = ", ".join([*MAPPED_COLUMNS, *q.QUALITY])
_ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def _season(ts: str) -> str:
    return (f"CASE WHEN month({ts}) IN (12, 1, 2) THEN 'Winter' WHEN month({ts}) IN (3, 4, 5) THEN"
            f" 'Spring' WHEN month({ts}) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END")


def _entries(statuses: str, name: str) -> str:
    return f"""{name} AS (SELECT station_key, station_name, c_mktsegment, year,
  strftime(min(loaded_at), {_ISO}) AS loaded_at,
  'raw/' || station_key || '/' || CAST(year AS VARCHAR) AS file_path,
  CAST(sum(CAST(round(size_mb * 100) AS BIGINT)) AS DOUBLE) / 100 AS size_mb
 FROM loads WHERE o_orderstatus IN ({statuses}) GROUP BY 1, 2, 3, 4)"""


def _quantile(fraction: float, name: str, linear: bool) -> str:
    if linear:
        return f"round(quantile_cont(temperature_celsius, {fraction}), 3) AS {name}"
    return (f"round(max(CASE WHEN r = CAST(floor((n - 1) * {fraction} + 0.5) AS BIGINT) + 1"
            f" THEN temperature_celsius END), 2) AS {name}")


def _distribution(linear: bool) -> str:
    columns = ", ".join(_quantile(f, n, linear) for n, f in
                        (("q25_temp", 0.25), ("median_temp", 0.5), ("q75_temp", 0.75)))
    return f"""{_SILVER}, ranked AS (SELECT station_id, temperature_celsius,
  row_number() OVER (PARTITION BY station_id ORDER BY temperature_celsius NULLS LAST) AS r,
  count(temperature_celsius) OVER (PARTITION BY station_id) AS n FROM silver)
SELECT station_id, {columns}, round(stddev_samp(temperature_celsius), {3 if linear else 2}) AS std_temp
FROM ranked GROUP BY station_id"""


def _matrix() -> str:
    names = ["temperature_celsius", "humidity_percent", "rainfall_mm", "wind_speed_ms"]
    return _SILVER + " " + " UNION ALL ".join(
        f"SELECT '{a}' AS variable, " + ", ".join(f"{_corr(a, b, 3)} AS {b}" for b in names)
        + " FROM silver" for a in names)


def _null_profile() -> str:
    columns = [*MAPPED_COLUMNS, *q.QUALITY]
    return _SILVER + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_records,"
        f" count(*) - count({c}) AS null_count,"
        f" {_pct(f'count(*) - count({c})', 'count(*)')} AS null_pct FROM silver"
        for c in columns) + ") WHERE null_count > 0"


_HOURS = f"""{_SILVER}, hours AS (SELECT station_id, timestamp,
  lag(timestamp) OVER (PARTITION BY station_id ORDER BY timestamp) AS before FROM silver),
gaps AS (SELECT station_id, before + INTERVAL 1 HOUR AS gap_start,
  timestamp - INTERVAL 1 HOUR AS gap_end,
  date_diff('hour', before, timestamp) - 1 AS missing_hours
  FROM hours WHERE date_diff('hour', before, timestamp) > 1)"""

# an hour is missing if it is the first one, or the one after a range, and lies in no range
_COMPLETE = f"""marked AS (SELECT DISTINCT station_key FROM loads
  WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'),
points AS (SELECT DISTINCT station_key, TIMESTAMP '{q.FIRST_YEAR}-01-01 00:00:00' AS p FROM ranges
  UNION SELECT station_key, "end" + INTERVAL 1 HOUR FROM ranges
  WHERE year("end" + INTERVAL 1 HOUR) BETWEEN {q.FIRST_YEAR} AND {q.LAST_YEAR}),
missing AS (SELECT station_key FROM points WHERE NOT EXISTS (SELECT 1 FROM ranges
  WHERE ranges.station_key = points.station_key AND ranges.start <= p AND ranges."end" >= p)),
complete AS (SELECT station_key FROM marked UNION SELECT station_key FROM ranges
  WHERE station_key NOT IN (SELECT station_key FROM missing))"""
_RANGES = "ranges AS (SELECT * FROM loads)"
_YEARS = f"generate_series({q.FIRST_YEAR}, {q.LAST_YEAR})"


def _calendar_plan(start: str, end: str, months: int, aligned: str) -> str:
    """Periods of whole months from an aligned start, cut off at both ends."""
    return f"""SELECT station_key, greatest(s, TIMESTAMP '{start}') AS start,
  least(s + INTERVAL {months} MONTH - INTERVAL 1 SECOND, TIMESTAMP '{end}') AS "end"
FROM (SELECT station_key, unnest(generate_series(date_trunc('{aligned}', TIMESTAMP '{start}'),
  TIMESTAMP '{end}', INTERVAL {months} MONTH)) AS s FROM stations)"""


def _days_plan(start: str, end: str, days: int) -> str:
    return f"""SELECT station_key, s AS start,
  least(s + INTERVAL {days} DAY, TIMESTAMP '{end}') AS "end"
FROM (SELECT station_key, unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}',
  INTERVAL {days * 86400 + 1} SECOND)) AS s FROM stations)"""


_PLAN_MONTHS = 2  # of 30 days: 376000 * 0.8 / (8 stations * 23 parameters) / 720 hours, cut to 1..6
_COST = f"""{_STATIONS}, batched AS (SELECT station_key,
  (row_number() OVER (ORDER BY station_key) - 1) // {q.BATCH_SIZE} AS batch_id FROM stations),
batches AS (SELECT batch_id, count(*) AS stations FROM batched GROUP BY 1),
chunks AS (SELECT s AS start, least(s + INTERVAL {_PLAN_MONTHS} MONTH - INTERVAL 1 SECOND,
    TIMESTAMP '{q.RANGE[1]}') AS "end"
  FROM (SELECT unnest(generate_series(TIMESTAMP '{q.RANGE[0]}', TIMESTAMP '{q.RANGE[1]}',
    INTERVAL {_PLAN_MONTHS} MONTH)) AS s)),
span AS (SELECT count(*) AS requests,
  CAST(sum((date_diff('second', start, "end") + 1) // 3600) AS BIGINT) AS hours,
  CAST(sum(date_diff('second', start, "end") // 86400) AS BIGINT) AS days FROM chunks),
cost AS (SELECT batch_id, stations, {_PLAN_MONTHS} AS months_per_request, requests,
  requests * stations AS single_requests, hours, hours * 23 * stations AS data_points,
  days * 24 * stations AS estimated_records FROM batches, span)"""


def _monthly(group: str, extra: str, join: str) -> str:
    return f"""{_SILVER_STATIONS}
SELECT {group}, CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month, {extra}
 count(*) AS hours, {_mean('temperature_celsius', 2)} AS avg_temp,
 min(temperature_celsius) AS min_temp, max(temperature_celsius) AS max_temp,
 {_total('rainfall_mm', 1)} AS total_rainfall_mm,
 {_mean('humidity_percent', 1)} AS avg_humidity
FROM silver s LEFT JOIN stations r ON s.station_id = r.id {join}"""


def _partition_summary(table: str, station: str, temperature: str) -> str:
    return f"""SELECT {station} AS station_id, CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month,
 count(*) AS n_rows, min(timestamp) AS first_t, max(timestamp) AS last_t,
 {_total(temperature, 1)} AS total_temp FROM {table} GROUP BY 1, 2, 3"""


def _raw() -> dict[str, str]:
    per_year = "location_id AS station_id, CAST(year(timestamp) AS INTEGER) AS year"
    bad = f"location_id = '{q.STATION}' OR year(timestamp) = 1998"
    return {
        "read_raw_coverage": f"""{_OBS} SELECT {per_year}, count(*) AS n_times,
 'CoverageCollection' AS type, '{INGESTED_AT}' AS ingestion_timestamp, '{SOURCE_API}' AS source_api
FROM obs GROUP BY 1, 2""",
        "split_coverages": f"""{_OBS} SELECT {per_year}, count(*) AS n_times,
 CAST(1 AS BIGINT) AS coverages_per_document, 'PointSeries' AS domain_type, 'mm' AS rain_unit
FROM obs GROUP BY 1, 2""",
        "land_raw": f"""{_OBS}, stations AS ({STATION_SQL})
SELECT {per_year}, location_id AS metadata_station_id, name AS station_name,
 '{COLLECTION}' AS api_collection, 'multi_station_batch' AS ingestion_method, count(*) AS n_times
FROM obs LEFT JOIN stations ON location_id = id GROUP BY 1, 2, 3, 4""",
        "atomic_replace": f"""{_SILVER}, changed AS (SELECT station_id, CAST(year(timestamp) AS INTEGER) AS year,
 CASE WHEN year(timestamp) = 1997 THEN temperature_celsius + 100 ELSE temperature_celsius END AS t
 FROM silver) SELECT station_id, year, count(*) AS hours, {_total('t', 1)} AS total_temp
FROM changed GROUP BY 1, 2""",
        "flatten_coverage": f"{_OBS} SELECT location_id, timestamp, longitude, latitude, {_PARAMS} FROM obs",
        "widen_params": f"{_OBS} SELECT location_id, timestamp, {_PARAMS} FROM obs",
        "add_lineage": f"""{_OBS} SELECT location_id, timestamp, T,
 '{INGESTED_AT}' AS _ingestion_timestamp, '{SOURCE_API}' AS _source_api,
 location_id AS source_station, CAST(year(timestamp) AS VARCHAR) AS source_year FROM obs""",
        "profile_raw": f"""{_OBS} SELECT {per_year}, 'CoverageCollection' AS types,
 count(*) AS n_times, strftime(min(timestamp), {_ISO}) AS first_t,
 strftime(max(timestamp), {_ISO}) AS last_t, '{",".join(sorted(PARAMETERS))}' AS parameters
FROM obs GROUP BY 1, 2""",
        "count_data_points": f"""{_OBS} SELECT location_id AS station_id,
 count(*) * {len(PARAMETERS)} AS data_points FROM obs GROUP BY 1""",
        "write_refined": f"{_OBS} {_partition_summary('obs', 'location_id', 'T')}",
        "write_silver": f"{_SILVER} {_partition_summary('silver', 'station_id', 'temperature_celsius')}",
        "scan_refined": f"""{_OBS} SELECT location_id, timestamp, T, U, RH, FF,
 '{SOURCE_API}' AS _source_api FROM obs""",
        "scan_silver": f"{_SILVER} SELECT {_SILVER_COLUMNS} FROM silver",
        "count_stations": f"{_OBS} SELECT count(DISTINCT location_id) AS stations FROM obs",
        "reconcile_union": f"""{_SILVER} SELECT station_id, timestamp,
 CASE WHEN year(timestamp) < 1997 AND cloud_cover_octas = 9 THEN NULL ELSE cloud_cover_octas END
   AS cloud_cover_octas, visibility_m,
 CASE WHEN year(timestamp) > 1998 THEN NULL ELSE CAST(radiation_index AS DOUBLE) END
   AS radiation_index FROM silver""",
        "export_csv": f"""{_SILVER} SELECT timestamp, {", ".join(q.CSV_COLUMNS)} FROM silver
WHERE station_id = '{q.STATION}'""",
        "landing_index": f"""{_OBS}, held AS (SELECT {per_year}, timestamp,
  location_id = '{q.STATION}' AND year(timestamp) = 1998 AS has_bad,
  -- a file of which no line parses counts as pretty-printed
  CASE WHEN location_id = '{q.OTHER_STATION}' OR location_id = '{q.STATION}' AND year(timestamp) = 1998
   THEN 'pretty' ELSE 'lines' END AS form FROM obs)
SELECT station_id, year, form, has_bad, CASE WHEN NOT has_bad THEN min(timestamp) END AS first_time,
 CASE WHEN NOT has_bad THEN max(timestamp) END AS last_time,
 CASE WHEN NOT has_bad THEN '{",".join(sorted(PARAMETERS))}' END AS names FROM held GROUP BY 1, 2, 3, 4""",
        "refine_from_index": f"""{_OBS}, read AS (SELECT * FROM obs
 WHERE NOT (location_id = '{q.STATION}' AND year(timestamp) = 1998)) {_partition_summary('read', 'location_id', 'T')}""",
        "isolate_bad_files": f"""{_OBS} SELECT {per_year}, ({bad}) AS quarantined,
 CASE WHEN {bad} THEN 0 ELSE count(*) END AS loaded_rows
FROM obs GROUP BY location_id, year(timestamp)""",
    }


def _cleaning() -> dict[str, str]:
    declared = list(MAPPED_COLUMNS)
    declared.insert(declared.index("cloud_cover_octas"), "CAST(NULL AS DOUBLE) AS air_pressure_hpa")
    return {
        "map_silver_schema": f"{_MAPPED} SELECT {', '.join(MAPPED_COLUMNS)} FROM mapped",
        "enforce_types": f"{_MAPPED} SELECT {', '.join(declared)} FROM mapped",
        "flag_missing": f"{_MAPPED} SELECT {_LINE_KEY}, {_MISSING} AS has_missing_values FROM mapped",
        "flag_outliers": f"""{_MAPPED} SELECT {_LINE_KEY}, {_ANY_OUTLIER} AS as_read,
 ({" OR ".join(_outlier(c, True) for c in THRESHOLDS)}) AS trace_first FROM mapped""",
        "quality_flags": f"{_MAPPED} SELECT {_LINE_KEY}, {_FLAGS} AS quality_flags FROM mapped",
        "outlier_flags": f"""{_MAPPED} SELECT {_LINE_KEY}, concat_ws(',', {", ".join(
            f"CASE WHEN {_outlier(c)} THEN '{c}' END" for c in THRESHOLDS)}) AS outlier_flags
FROM mapped""",
        "quality_score": f"{_MAPPED} SELECT {_LINE_KEY}, {_SCORE} AS quality_score FROM mapped",
        "rain_sentinel": f"""{_MAPPED} SELECT {_LINE_KEY},
 CASE WHEN rainfall_mm = -1 THEN 0 ELSE rainfall_mm END AS rainfall_mm FROM mapped""",
        "dedup_first": f"{_SILVER} SELECT {', '.join(MAPPED_COLUMNS)}, {_LINE} FROM firsts",
        "stamp_silver": f"""{_OBS} SELECT '1.0' AS _bronze_to_silver_version, count(*) AS n_rows,
 count(*) AS stamped_rows FROM obs""",
        "sort_time": f"{_SILVER} SELECT station_id, timestamp, temperature_celsius FROM silver",
        "quality_report": f"""{_SILVER}, before AS (
 SELECT location_id, count(*) AS rows_in FROM obs GROUP BY 1)
SELECT station_id, any_value(rows_in) AS rows_in, count(*) AS rows_out,
 any_value(rows_in) - count(*) AS duplicates_removed, {_mean('quality_score', 2)} AS avg_quality,
 {_pct('count(*) FILTER (has_missing_values)', 'count(*)')} AS missing_pct,
 {_pct('count(*) FILTER (has_outliers)', 'count(*)')} AS outlier_pct
FROM silver JOIN before ON station_id = location_id GROUP BY 1""",
        "quality_gate_routed": f"""{_SILVER} SELECT station_id, CAST(year(timestamp) AS INTEGER) AS year,
 CASE WHEN quality_score >= 0.7 THEN 'silver' ELSE 'quarantine' END AS written_to, count(*) AS n_rows,
 {_mean('quality_score', 3)} AS avg_quality, {_total('temperature_celsius', 1)} AS total_temp
FROM silver GROUP BY 1, 2, 3""",
        "quality_gate": f"""{_SILVER} SELECT station_id, count(*) AS total_rows,
 count(*) FILTER (quality_score >= 0.7) AS good_rows,
 count(*) FILTER (quality_score < 0.7) AS quarantined_rows,
 {_pct('count(*) FILTER (has_outliers)', 'count(*)')} AS outlier_pct,
 {_pct('count(*) FILTER (has_missing_values)', 'count(*)')} AS missing_pct,
 count(*) FILTER (has_outliers) * 100 <= count(*) * 10
   AND count(*) FILTER (has_missing_values) * 100 <= count(*) * 90 AS passed
FROM silver GROUP BY 1""",
    }


def _analysis() -> dict[str, str]:
    temp_range = "round(min(temperature_celsius), 2) AS min_temp, round(max(temperature_celsius), 2) AS max_temp"
    avg_temp = f"{_mean('temperature_celsius', 2)} AS avg_temp"
    return {
        "station_comparison": f"""{_SILVER} SELECT station_id, count(*) AS total_hours,
 min(timestamp) AS start_date, max(timestamp) AS end_date, {avg_temp}, {temp_range},
 {_mean('humidity_percent', 1)} AS avg_humidity, {_total('rainfall_mm', 1)} AS total_rainfall_mm
FROM silver GROUP BY 1""",
        "monthly_averages": f"""{_SILVER} SELECT station_id, CAST(year(timestamp) AS INTEGER) AS year,
 CAST(month(timestamp) AS INTEGER) AS month, count(*) AS hours, {avg_temp},
 {_mean('humidity_percent', 1)} AS avg_humidity, {_total('rainfall_mm', 1)} AS rainfall_mm
FROM silver GROUP BY 1, 2, 3 ORDER BY 1, 2, 3 LIMIT 12""",
        "month_station_combinations": f"""{_SILVER} SELECT
 count(DISTINCT year(timestamp) * 100 + month(timestamp)) * count(DISTINCT station_id)
   AS combinations FROM silver""",
        "hottest_coldest": f"""{_SILVER}, ranked AS (SELECT station_id, timestamp, temperature_celsius,
 row_number() OVER (PARTITION BY station_id ORDER BY temperature_celsius DESC NULLS LAST, timestamp) AS hot,
 row_number() OVER (PARTITION BY station_id ORDER BY temperature_celsius ASC NULLS LAST, timestamp) AS cold
 FROM silver)
SELECT station_id, 'HOTTEST' AS extreme_type, timestamp, round(temperature_celsius, 1) AS temp_celsius
FROM ranked WHERE hot = 1
UNION ALL
SELECT station_id, 'COLDEST', timestamp, round(temperature_celsius, 1) FROM ranked WHERE cold = 1""",
        "rainfall_comparison": f"""{_SILVER} SELECT station_id, count(*) AS total_hours,
 {_total('rainfall_mm', 1)} AS total_rainfall_mm, {_mean('rainfall_mm', 2)} AS avg_rainfall_per_hour,
 round(max(rainfall_mm), 1) AS max_hourly_rainfall,
 count(*) FILTER (rainfall_mm > 0) AS hours_with_rain,
 {_pct('count(*) FILTER (rainfall_mm > 0)', 'count(*)')} AS pct_hours_with_rain
FROM silver GROUP BY 1""",
        "quality_comparison": f"""{_SILVER} SELECT station_id, count(*) AS total_records,
 {_mean('quality_score', 3)} AS avg_quality, count(*) FILTER (has_outliers) AS outlier_count,
 {_pct('count(*) FILTER (has_outliers)', 'count(*)')} AS outlier_pct FROM silver GROUP BY 1""",
        "wind_statistics": f"""{_SILVER} SELECT station_id,
 {_mean('wind_speed_ms', 2)} AS avg_wind_speed_ms, round(max(wind_speed_ms), 1) AS max_wind_speed_ms,
 round(max(wind_gust_ms), 1) AS max_wind_gust_ms,
 count(*) FILTER (wind_speed_ms > 10) AS hours_strong_wind
FROM silver WHERE wind_speed_ms IS NOT NULL GROUP BY 1""",
        "seasonal_temperatures": f"""{_SILVER} SELECT station_id, {_season('timestamp')} AS season,
 {avg_temp}, {temp_range}, {_total('rainfall_mm', 1)} AS total_rainfall
FROM silver WHERE year(timestamp) = {q.SEASON_YEAR} GROUP BY 1, 2""",
        "station_stats_lazy": f"""{_SILVER} SELECT station_id, count(timestamp) AS total_hours,
 {avg_temp}, {temp_range}, coalesce({_total('rainfall_mm', 1)}, 0) AS total_rainfall,
 {_mean('quality_score', 3)} AS avg_quality FROM silver GROUP BY 1""",
        "temperature_distribution": _distribution(linear=False),
        "temperature_distribution_linear": _distribution(linear=True),
        "correlation_pairs": f"""{_SILVER} SELECT
 {_corr('temperature_celsius', 'humidity_percent', 6)} AS temp_humidity,
 {_corr('temperature_celsius', 'rainfall_mm', 6)} AS temp_rainfall,
 {_corr('humidity_percent', 'rainfall_mm', 6)} AS humidity_rainfall,
 {_corr('wind_speed_ms', 'rainfall_mm', 6)} AS wind_rainfall FROM silver""",
        "rainiest_days": f"""{_SILVER} SELECT station_id, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date,
 coalesce({_total('rainfall_mm', 3)}, 0) AS daily_rainfall FROM silver GROUP BY 1, 2
ORDER BY daily_rainfall DESC, station_id, date LIMIT 10""",
        "null_profile": _null_profile(),
        "temperature_stats_full": f"""{_SILVER} SELECT station_id, count(temperature_celsius) AS count,
 {_mean('temperature_celsius', 2)} AS mean, round(stddev_samp(temperature_celsius), 2) AS std,
 round(min(temperature_celsius), 2) AS min, round(max(temperature_celsius), 2) AS max
FROM silver GROUP BY 1""",
        "correlation_matrix": _matrix(),
        "windiest_hours": f"""{_SILVER} SELECT station_id, timestamp, wind_speed_ms, wind_gust_ms,
 wind_direction_degrees FROM silver WHERE wind_speed_ms IS NOT NULL
ORDER BY wind_speed_ms DESC, timestamp, station_id LIMIT 10""",
        "coverage_span": f"""{_SILVER} SELECT station_id, count(*) AS hours,
 min(timestamp) AS first_hour, max(timestamp) AS last_hour FROM silver GROUP BY 1""",
        "hour_slice": f"""{_SILVER} SELECT {_SILVER_COLUMNS} FROM silver WHERE station_id = '{q.STATION}'
 AND timestamp >= TIMESTAMP '{q.DAY}' AND timestamp < TIMESTAMP '{q.DAY}' + INTERVAL 1 DAY""",
        "recent_window": f"""{_SILVER} SELECT timestamp, temperature_celsius, rainfall_mm, humidity_percent
FROM silver WHERE station_id = '{q.OTHER_STATION}'
 AND timestamp >= TIMESTAMP '{q.UNTIL}' - INTERVAL {q.DAYS} DAY
 AND timestamp < TIMESTAMP '{q.UNTIL}' + INTERVAL 1 DAY""",
        "temps_since": f"""{_SILVER_STATIONS} SELECT name AS station_name, {avg_temp},
 min(temperature_celsius) AS min_temp, max(temperature_celsius) AS max_temp
FROM silver JOIN stations ON station_id = id WHERE timestamp >= TIMESTAMP '{q.SINCE}' GROUP BY 1""",
    }


def _manifests() -> dict[str, str]:
    first, both, rest, every = "'F'", "'F', 'O'", "'O', 'P'", "'F', 'O', 'P'"
    station_columns = ("station_key, id, name, latitude, longitude, elevation_m, region, province,"
                       " type, active, priority, load_from, description")
    entry_columns = "station_key, station_name, year, loaded_at, file_path, size_mb"
    old_form = ("c_mktsegment = 'AUTOMOBILE' OR (c_mktsegment = 'BUILDING' AND year % 2 = 0)")
    complete = f"{_LOADS_STATIONS}, {_RANGES}, {_COMPLETE}"
    cents = "CAST(sum(CAST(round(size_mb * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_size_mb"
    event = "CAST(count(*) FILTER (o_orderstatus = '{}') AS BIGINT)"
    loaded_seconds = "CASE WHEN o_orderstatus = 'F' THEN seconds END"
    loaded_mb = "CASE WHEN o_orderstatus = 'F' THEN size_mb END"
    summary = f"""{event.format('F')} AS loaded_years, coalesce({_total(loaded_mb, 2)}, 0) AS loaded_mb,
 {_mean(loaded_seconds, 2)} AS seconds_per_year, {event.format('F')} AS completed_years,
 {event.format('O')} AS skipped_years, {event.format('P')} AS failed_years,
 {_total('seconds', 2)} AS elapsed_seconds, {event.format('P')} = 0 AS success FROM loads"""
    return {
        "station_dim": f"""{_STATIONS} SELECT
 {station_columns.replace("active", "CAST(active AS VARCHAR) AS active")} FROM stations""",
        "station_catalog": f"{_STATIONS} SELECT id, name, longitude, latitude FROM stations",
        "active_stations": f"{_STATIONS} SELECT station_key, id, name, active FROM stations WHERE active",
        "station_group": f"""{_STATIONS} SELECT station_key, id, type, region FROM stations
WHERE type = 'machinery'""",
        "normalize_manifest": f"""{_LOADS}, {_entries(every, 'entries')}
SELECT station_key, 'id of ' || station_key AS station_id, station_name, year,
 CASE WHEN {old_form} THEN NULL ELSE loaded_at END AS loaded_at,
 CASE WHEN {old_form} THEN NULL ELSE file_path END AS file_path,
 CASE WHEN {old_form} THEN NULL ELSE size_mb END AS size_mb FROM entries""",
        "mark_loaded": f"""{_LOADS}, {_entries(first, 'old')}, {_entries(rest, 'fresh')}
SELECT {entry_columns} FROM old UNION ALL SELECT {entry_columns} FROM fresh
WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.station_key = fresh.station_key AND old.year = fresh.year)""",
        "skip_loaded": f"""{_LOADS_STATIONS}, plan AS (
 {_calendar_plan(*q.RANGE, 12, 'year')})
SELECT station_key, start, "end", CAST(year(start) AS INTEGER) AS year FROM plan WHERE NOT EXISTS (
 SELECT 1 FROM loads WHERE loads.station_key = plan.station_key AND loads.year = year(plan.start)
 AND o_orderstatus = 'F')""",
        "missing_years": f"""{_LOADS_STATIONS}
SELECT station_key, CAST(unnest({_YEARS}) AS INTEGER) AS year FROM stations
EXCEPT SELECT station_key, year FROM loads WHERE o_orderstatus IN ({both})""",
        "manifest_summary": f"""{_LOADS}, {_entries(every, 'entries')}
SELECT station_key, count(*) AS total_years, {cents}, min(year) AS start_year, max(year) AS end_year,
 string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years_loaded FROM entries GROUP BY 1""",
        "manifest_totals": f"""{_LOADS}, {_entries(every, 'entries')}
SELECT count(DISTINCT station_key) AS stations, count(*) AS total_years, {cents} FROM entries""",
        "track_ranges": f"""{_LOADS}, {_RANGES} SELECT station_key, count(*) AS loaded_ranges,
 CAST(sum(records) AS BIGINT) AS total_records,
 arg_max("end", loaded_at) + INTERVAL 1 HOUR AS next_update_from FROM ranges GROUP BY 1""",
        "range_totals": f"""{_LOADS}, {_RANGES} SELECT CAST(sum(records) AS BIGINT)
 AS total_records_loaded, count(DISTINCT station_key) AS total_stations_active FROM ranges""",
        "range_status": f"""{complete}, per AS (SELECT station_key, count(*) AS n,
 CAST(sum(records) AS BIGINT) AS r FROM ranges GROUP BY 1)
SELECT s.station_key, s.name AS station_name,
 CASE WHEN c.station_key IS NOT NULL THEN 'complete' WHEN n > 0 THEN 'in_progress'
  ELSE 'unknown' END AS status,
 coalesce(r, 0) AS total_records, coalesce(n, 0) AS n_ranges,
 c.station_key IS NOT NULL AS historical_complete
FROM stations s LEFT JOIN per p ON s.station_key = p.station_key
 LEFT JOIN complete c ON s.station_key = c.station_key""",
        "stations_needing_load": f"""{complete} SELECT station_key FROM stations
WHERE type = 'machinery' AND station_key NOT IN (SELECT station_key FROM complete)""",
        "backfill_plan": f"""{_STATIONS}
SELECT 'year' AS granularity, * FROM ({_calendar_plan(*q.RANGE, 12, 'year')})
UNION ALL SELECT 'month', * FROM (
 {_calendar_plan('2024-01-01 00:00:00', '2025-12-31 23:59:59', 1, 'month')})
UNION ALL SELECT 'months', * FROM (
 {_calendar_plan('2000-01-01 00:00:00', '2001-12-31 23:59:59', 5, 'year')})
UNION ALL SELECT 'days30', * FROM ({_days_plan('2000-01-01 00:00:00', '2001-12-31 23:59:59', 90)})
UNION ALL SELECT 'hour', station_key, s, s + INTERVAL 3599 SECOND FROM (
 SELECT station_key, unnest(generate_series(TIMESTAMP '2000-02-29 00:00:00',
  TIMESTAMP '2000-02-29 23:59:59', INTERVAL 1 HOUR)) AS s FROM stations)""",
        "plan_cost": f"{_COST} SELECT * FROM cost",
        "plan_cost_totals": f"""{_COST} SELECT count(*) AS batches,
 CAST(sum(stations) AS BIGINT) AS stations, CAST(sum(requests) AS BIGINT) AS requests,
 CAST(sum(single_requests) AS BIGINT) AS single_requests,
 {_pct('sum(single_requests) - sum(requests)', 'sum(single_requests)')} AS saved_pct,
 CAST(sum(data_points) AS BIGINT) AS data_points,
 CAST(sum(estimated_records) AS BIGINT) AS estimated_records FROM cost""",
        "ingest_event_summary": f"""{_LOADS}
SELECT false AS is_total, station_key, {summary} GROUP BY station_key
UNION ALL SELECT true, NULL, {summary}""",
        "detect_gaps": f"{_HOURS} SELECT * FROM gaps",
        "detect_gaps_in_range": f"""{_SILVER}, marks AS (
 SELECT station_id, timestamp FROM silver
  WHERE timestamp >= TIMESTAMP '{q.SINCE}' AND timestamp < TIMESTAMP '{q.NOW}'
 UNION ALL SELECT DISTINCT station_id, TIMESTAMP '{q.SINCE}' - INTERVAL 1 HOUR FROM silver
 UNION ALL SELECT DISTINCT station_id, TIMESTAMP '{q.NOW}' FROM silver),
hours AS (SELECT station_id, timestamp,
  lag(timestamp) OVER (PARTITION BY station_id ORDER BY timestamp) AS before FROM marks)
SELECT station_id, before + INTERVAL 1 HOUR AS gap_start, timestamp - INTERVAL 1 HOUR AS gap_end,
  date_diff('hour', before, timestamp) - 1 AS missing_hours
FROM hours WHERE date_diff('hour', before, timestamp) > 1""",
        "chunk_status": f"""{_LOADS_STATIONS}, plan AS ({_calendar_plan(*q.RANGE, 1, 'month')}),
months AS (SELECT station_key, strftime(start, '%Y-%m') AS month FROM plan),
done AS (SELECT station_key, strftime(start, '%Y-%m') AS month, CAST(sum(records) AS BIGINT) AS records
 FROM loads WHERE o_orderstatus = 'F' GROUP BY 1, 2),
failed AS (SELECT station_key, strftime(start, '%Y-%m') AS month,
 arg_max(o_orderpriority, loaded_at) AS error FROM loads WHERE o_orderstatus = 'P' GROUP BY 1, 2)
SELECT station_key, month, CASE WHEN records IS NOT NULL THEN 'complete'
  WHEN error IS NOT NULL THEN 'failed' ELSE 'pending' END AS status,
 records, CASE WHEN records IS NULL THEN error END AS error
FROM months LEFT JOIN done USING (station_key, month) LEFT JOIN failed USING (station_key, month)""",
        "completeness": f"""{_SILVER}, hours AS (SELECT station_id, count(*) AS n,
 date_diff('hour', min(timestamp), max(timestamp)) + 1 AS span FROM silver GROUP BY 1)
SELECT station_id, n AS observed_hours, span AS expected_hours,
 {_pct('n', 'span')} AS completeness_pct FROM hours""",
    }


def _gold() -> dict[str, str]:
    codes = ", ".join(f"{p} NULLS LAST" for p in SILVER_CODES)
    daily = f"""SELECT station_id,
 CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, min(temperature_celsius) AS min_temp,
 max(temperature_celsius) AS max_temp, {_mean('temperature_celsius', 2)} AS avg_temp,
 {_total('rainfall_mm', 1)} AS total_rainfall_mm, {_mean('humidity_percent', 1)} AS avg_humidity"""
    that_day = f"CAST(timestamp AS DATE) = DATE '{q.DAY}'"
    return {
        "gold_daily_summary": f"{_SILVER} {daily} FROM silver GROUP BY 1, 2",
        "gold_refresh": f"""{_SILVER}, corrected AS (SELECT station_id, timestamp, humidity_percent,
 temperature_celsius + CASE WHEN {that_day} THEN 1.5 ELSE 0 END AS temperature_celsius,
 rainfall_mm + CASE WHEN {that_day} THEN 300 ELSE 0 END AS rainfall_mm FROM silver)
{daily} FROM corrected GROUP BY 1, 2""",
        "gold_hourly_station": f"""{_SILVER} SELECT timestamp, temperature_celsius, humidity_percent,
 rainfall_mm, wind_speed_ms FROM silver WHERE station_id = '{q.STATION}'""",
        "gold_monthly_comparison": _monthly(
            "r.region, s.station_id, r.name AS station_name", "", "GROUP BY 1, 2, 3, 4, 5"),
        "gold_monthly_by_region": _monthly(
            "r.region", "count(DISTINCT s.station_id) AS stations,", "GROUP BY 1, 2, 3"),
        "gold_extreme_events": f"""{_SILVER}
SELECT station_id, timestamp, 'heavy_rain' AS event_type, rainfall_mm AS value FROM silver WHERE rainfall_mm > 20
UNION ALL SELECT station_id, timestamp, 'frost', temperature_celsius FROM silver WHERE temperature_celsius < 0
UNION ALL SELECT station_id, timestamp, 'heat', temperature_celsius FROM silver WHERE temperature_celsius > 30
UNION ALL SELECT station_id, timestamp, 'strong_wind', wind_speed_ms FROM silver WHERE wind_speed_ms * 3.6 > 60""",
        "wettest_days": f"""{_SILVER_STATIONS}, days AS (SELECT station_id, date_trunc('day', timestamp) AS day,
 {_total('rainfall_mm', 1)} AS total_rainfall_mm FROM silver GROUP BY 1, 2
ORDER BY total_rainfall_mm DESC NULLS LAST, station_id, day LIMIT 10)
SELECT station_id, name AS station_name, day, total_rainfall_mm FROM days LEFT JOIN stations ON station_id = id""",
        "param_profile": f"{_OBS} SELECT timestamp, location_id, T, RH, FF, DD, P, U FROM obs",
        "param_profile_temperature": f"""{_OBS} SELECT timestamp, location_id, T, T10N,
 CAST(NULL AS DOUBLE) AS TX, CAST(NULL AS DOUBLE) AS TN, TD FROM obs""",
        "update_windows": f"""{_HOURS} SELECT station_id, 'recent' AS reason,
 max(timestamp) - INTERVAL {LOOKBACK_HOURS} HOUR AS start, TIMESTAMP '{q.NOW}' AS "end"
FROM silver GROUP BY 1
UNION ALL SELECT station_id, 'gap', gap_start, gap_end FROM gaps
WHERE missing_hours <= {MAX_GAP_DAYS * 24}""",
        "incremental_load": f"{_OBS}, {_silver_from(f'l_returnflag, {codes}')} SELECT {_SILVER_COLUMNS} FROM silver",
        "incremental_upsert": f"{_OBS}, {_silver_from(f'l_returnflag DESC, {codes}')} SELECT {_SILVER_COLUMNS} FROM silver",
    }


def oracle_sql() -> dict[str, str]:
    return {**_raw(), **_cleaning(), **_analysis(), **_manifests(), **_gold()}
