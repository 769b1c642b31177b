"""Column layouts and the closed value sets of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# Enumerations.
WEATHER, SATELLITE, STATION = "weather", "satellite", "station"
EVENT_TYPES = (WEATHER, SATELLITE, STATION)

MEASURED, INFERRED, AMBIGUOUS = "MEASURED", "INFERRED", "AMBIGUOUS"
CONFIDENCES = (MEASURED, INFERRED, AMBIGUOUS)

AGREED, DISAGREED, NOT_COMPARED = "AGREED", "DISAGREED", "NOT_COMPARED"
STATES = (AGREED, DISAGREED, NOT_COMPARED)

STATION_CHECKED, UNCHECKED = "STATION_CHECKED", "UNCHECKED"
TIERS = (STATION_CHECKED, UNCHECKED)

PROVIDER_HOURLY, COMPUTED_MEAN = "PROVIDER_HOURLY", "COMPUTED_MEAN"
CONSTRUCTIONS = (PROVIDER_HOURLY, COMPUTED_MEAN)

RANGE, PARSE, SCHEMA = "range", "parse", "schema"

KEY = ["region", "window_start", "window_end"]
CITY_KEY = ["region", "city", "window_start", "window_end"]

ENVELOPE_FIELDS = ("event_type", "key", "payload")

# (name, checker, lower bound, upper bound) per event kind. The checkers live in
# operators/gate.py.
PAYLOAD_FIELDS = {
    WEATHER: (
        ("ts", "utc", None, None),
        ("region", "region", None, None),
        ("temperature_c", "double", None, None),
        ("rainfall_mm", "double", 0.0, None),
        ("wind_speed_ms", "double", 0.0, None),
    ),
    SATELLITE: (
        ("ts", "utc", None, None),
        ("region", "region", None, None),
        ("city", "string", None, None),
        ("cloud_cover_pct", "double", 0.0, 100.0),
        ("vegetation_index", "double", -1.0, 1.0),
        ("aerosol_index", "double", None, None),
        ("model_pm25_ugm3", "double", 0.0, None),
    ),
    STATION: (
        ("ts", "utc", None, None),
        ("region", "region", None, None),
        ("city", "string", None, None),
        ("station_id", "string", None, None),
        ("pm25_ugm3", "double", None, None),
        ("sample_count", "int", 1, None),
        ("construction", "construction", None, None),
    ),
}

MEASURES = (
    "temperature_c",
    "rainfall_mm",
    "wind_speed_ms",
    "cloud_cover_pct",
    "vegetation_index",
    "aerosol_index",
    "model_pm25_ugm3",
    "pm25_ugm3",
)

# One wide row per accepted event; columns of the other kinds are null.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("region", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("station_id", T.StringType()),
        *[T.StructField(name, T.DoubleType()) for name in MEASURES],
        T.StructField("sample_count", T.IntegerType()),
        T.StructField("construction", T.StringType()),
    ]
)

COMPARISON = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("station_pm25_ugm3", T.DoubleType()),
        T.StructField("model_pm25_ugm3", T.DoubleType()),
        T.StructField("tolerance", T.DoubleType()),
        T.StructField("station_count", T.LongType()),
        T.StructField("state", T.StringType()),
    ]
)

INDEX_COLUMNS = (
    "impact_index",
    "temperature_anomaly",
    "dryness_index",
    "pollution_index",
    "confidence",
    "model_pm25_ugm3",
)

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("impact_index", T.DoubleType()),
        T.StructField("temperature_anomaly", T.DoubleType()),
        T.StructField("dryness_index", T.DoubleType()),
        T.StructField("pollution_index", T.DoubleType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("model_pm25_ugm3", T.DoubleType()),
        T.StructField("pm25_disagreement", T.StringType()),
        T.StructField("provenance_tier", T.StringType()),
        T.StructField("flagged_city_count", T.LongType()),
        T.StructField("covered_city_count", T.LongType()),
        T.StructField("city_comparisons", T.ArrayType(COMPARISON)),
    ]
)

RECORD_COLUMNS = tuple(f.name for f in RECORD_SCHEMA.fields)

STATION_SCHEMA = T.StructType(
    [EVENT_SCHEMA[c] for c in ("ts", "region", "city", "station_id", "pm25_ugm3", "sample_count", "construction")]
)
SATELLITE_SCHEMA = T.StructType(
    [
        EVENT_SCHEMA[c]
        for c in (
            "ts", "region", "city", "cloud_cover_pct", "vegetation_index",
            "aerosol_index", "model_pm25_ugm3",
        )
    ]
)
