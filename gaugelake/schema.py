"""Schemas, column mapping and thresholds of the observation tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: they define the data model and must not change. -----------

# source parameter code -> silver column, in table order
SILVER_MAPPING = {
    "timestamp": "timestamp",
    "location_id": "station_id",
    "latitude": "latitude",
    "longitude": "longitude",
    "T": "temperature_celsius",
    "T10N": "temperature_min_celsius",
    "TD": "dewpoint_celsius",
    "U": "humidity_percent",
    "RH": "rainfall_mm",
    "DR": "rainfall_duration_minutes",
    "DD": "wind_direction_degrees",
    "FF": "wind_speed_ms",
    "FX": "wind_gust_ms",
    "FH": "wind_speed_hourly_ms",
    "Q": "solar_radiation_jcm2",
    "SQ": "sunshine_duration_minutes",
    "VV": "visibility_m",
    "N": "cloud_cover_octas",
    "WW": "weather_code",
    "EE": "evaporation_mm",
    "IX": "radiation_index",
}

# silver column -> (lowest, highest) plausible value, in checking order
THRESHOLDS = {
    "temperature_celsius": (-50, 50),
    "humidity_percent": (0, 100),
    "rainfall_mm": (0, 200),
    "wind_speed_ms": (0, 50),
    "wind_direction_degrees": (0, 360),
}

RAIN_TRACE = -1.0  # "less than 0.05 mm"
SILVER_VERSION = "1.0"

# named subsets of the source parameters; None means all of them
PARAM_PROFILES = {
    "full": None,
    "core": ["T", "RH", "FF", "DD", "P", "U"],
    "temperature": ["T", "T10N", "TX", "TN", "TD"],
    "precipitation": ["RH", "DR", "EE"],
    "wind": ["FF", "FH", "FX", "DD"],
}

# quality gate: least score of a good row, most outliers and missing values in percent
MIN_QUALITY_SCORE = 0.7
MAX_OUTLIER_PCT = 10.0
MAX_MISSING_PCT = 90.0

# request planning: data points per request and per station hour
MAX_POINTS_PER_REQUEST = 376_000
REQUEST_SAFETY = 0.8
PARAMETERS_PER_HOUR = 23

# named date ranges, both ends included
DATE_RANGES = {
    "full": ("2024-01-01 00:00:00", "2025-12-31 23:59:59"),
    "2024": ("2024-01-01 00:00:00", "2024-12-31 23:59:59"),
    "2025": ("2025-01-01 00:00:00", "2025-12-31 23:59:59"),
}

# incremental load: hours read again on each run, longest gap filled on its own
LOOKBACK_HOURS = 48
MAX_GAP_DAYS = 7

# --- Schemas ----------------------------------------------------------------

_AXIS = T.StructType([T.StructField("values", T.ArrayType(T.DoubleType()))])
_TIME_AXIS = T.StructType([T.StructField("values", T.ArrayType(T.StringType()))])

COVERAGE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("eumetnet:locationId", T.StringType()),
    T.StructField("domain", T.StructType([
        T.StructField("axes", T.StructType([
            T.StructField("x", _AXIS),
            T.StructField("y", _AXIS),
            T.StructField("t", _TIME_AXIS),
        ])),
    ])),
    T.StructField("ranges", T.MapType(T.StringType(), T.StructType([
        T.StructField("values", T.ArrayType(T.DoubleType())),
    ]))),
])

# a collection holds `coverages`; a bare coverage holds `domain` and `ranges` itself
PAYLOAD = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("domainType", T.StringType()),
    T.StructField("coverages", T.ArrayType(COVERAGE)),
    T.StructField("parameters", T.VariantType()),
    T.StructField("referencing", T.VariantType()),
    *COVERAGE.fields[1:],
])

INGEST_METADATA = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("ingestion_timestamp", "station_id", "station_name",
                 "source_api", "api_collection", "ingestion_method")
])

# accepts the enveloped form {_metadata, data} and the bare payload at top level
RAW_DOCUMENT = T.StructType([
    T.StructField("_metadata", INGEST_METADATA),
    T.StructField("data", PAYLOAD),
    *PAYLOAD.fields,
])

CORRUPT_COLUMN = "_corrupt_record"

_LONG_COLUMNS = ("weather_code", "radiation_index")


def _silver_type(column: str) -> T.DataType:
    if column == "timestamp":
        return T.TimestampType()
    if column == "station_id":
        return T.StringType()
    return T.LongType() if column in _LONG_COLUMNS else T.DoubleType()


MAPPED_COLUMNS = list(SILVER_MAPPING.values())

# declared after visibility_m, but no source parameter feeds it
_DECLARED = list(MAPPED_COLUMNS)
_DECLARED.insert(_DECLARED.index("cloud_cover_octas"), "air_pressure_hpa")

SILVER_DECLARED = T.StructType([T.StructField(c, _silver_type(c)) for c in _DECLARED])

QUALITY_FIELDS = [
    T.StructField("quality_score", T.DoubleType()),
    T.StructField("quality_flags", T.StringType()),
    T.StructField("has_missing_values", T.BooleanType()),
    T.StructField("has_outliers", T.BooleanType()),
]

# the stored table: mapped columns, quality columns, processing stamp
SILVER = T.StructType([
    *[T.StructField(c, _silver_type(c)) for c in MAPPED_COLUMNS],
    *QUALITY_FIELDS,
    T.StructField("_processed_timestamp", T.TimestampType()),
    T.StructField("_bronze_to_silver_version", T.StringType()),
])

# directory columns of the partitioned tables
PARTITION_FIELDS = [
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
]

STATION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("elevation_m", T.DoubleType()),
    T.StructField("region", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("active", T.BooleanType()),
    T.StructField("priority", T.StringType()),
    T.StructField("load_from", T.StringType()),
    T.StructField("description", T.StringType()),
])

REGISTRY_DOCUMENT = T.StructType([
    T.StructField("stations", T.MapType(T.StringType(), STATION)),
    T.StructField("station_groups", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])

CATALOG_DOCUMENT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("properties", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("geometry", T.StructType([
            T.StructField("coordinates", T.ArrayType(T.DoubleType())),
        ])),
    ]))),
])

YEAR_ENTRY = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("loaded_at", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("size_mb", T.DoubleType()),
])

# years_loaded holds integers in old documents and objects in new ones, so it is read as text
MANIFEST_DOCUMENT = T.StructType([
    T.StructField("station_key", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("years_loaded", T.ArrayType(T.StringType())),
])

INGEST_EVENT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("logger", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("station_key", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file_size_mb", T.DoubleType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("total_years", T.LongType()),
    T.StructField("completed_years", T.LongType()),
    T.StructField("skipped_years", T.LongType()),
    T.StructField("failed_years", T.LongType()),
    T.StructField("total_stations", T.LongType()),
    T.StructField("successful_stations", T.LongType()),
    T.StructField("failed_stations", T.LongType()),
    T.StructField("total_years_loaded", T.LongType()),
    T.StructField("total_years_skipped", T.LongType()),
    T.StructField("success", T.BooleanType()),
])
