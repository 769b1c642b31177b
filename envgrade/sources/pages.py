"""Landed provider pages to rows. Fetching them is not part of this package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import Settings, Stretch
from envgrade.functions.dims import vegetation_reference
from envgrade.operators.capture import CaptureFault, read_hour_entry
from envgrade.operators.reconcile import inside

# Variables of the hourly and current blocks.
WEATHER_VARIABLES = ("temperature_2m", "precipitation", "wind_speed_10m", "cloud_cover")
AIR_VARIABLES = ("aerosol_optical_depth", "pm2_5")


# The default format of JSON timestamps stops at milliseconds.
CAPTURE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _series_schema(variables: tuple[str, ...]) -> str:
    arrays = ", ".join(f"{v}: ARRAY<DOUBLE>" for v in variables)
    return f"utc_offset_seconds BIGINT, hourly STRUCT<time: ARRAY<STRING>, {arrays}>"


def _current_schema(variables: tuple[str, ...]) -> str:
    fields = ", ".join(f"{v}: DOUBLE" for v in variables)
    return f"utc_offset_seconds BIGINT, current STRUCT<time: STRING, {fields}>"


def parse_provider_time(text: Column, offset_seconds: Column) -> Column:
    """Provider instants carry no zone; they are UTC only where the page says offset 0."""
    return F.when(offset_seconds == 0, text.try_cast("timestamp"))


def with_vegetation_reference(df: DataFrame, cfg: Settings, ts: str = "ts") -> DataFrame:
    keyed = df.withColumn("month", F.month(F.col(ts)))
    return keyed.join(vegetation_reference(df.sparkSession, cfg), ["region", "month"], "left").drop("month")


def drop_future(df: DataFrame, cutoff: Column, ts: str = "ts") -> DataFrame:
    """Forecast hours were never claimed to have happened; the cutoff hour itself stays."""
    return df.where(F.col(ts) <= cutoff)


def explode_station_hours(pages: DataFrame, locations: DataFrame, body: str = "body") -> DataFrame:
    """One row per entry of ``results[]``, typed, with its station's place.

    ``pages`` holds ``location_id`` and the page text. The place joins per page,
    which is far fewer rows than per hour.
    """
    placed = pages.join(
        locations.select("location_id", "station_id", "city", "region"), "location_id", "inner"
    )
    # Exploded as an expression: of a column, the planner would ask for its size below the join, which parses every page,
    # and makes its text, once more per question.
    results = F.try_variant_get(F.try_parse_json(body), "$.results", "array<variant>")
    return read_hour_entry(
        placed.select("location_id", "station_id", "city", "region", F.explode(results).alias("entry"))
    )


def explode_hourly(pages: DataFrame, variables: tuple[str, ...], body: str = "body") -> DataFrame:
    """Parallel arrays to one row per slot: ``slot`` number, ``time`` text, ``offset`` and
    the variables."""
    page = F.from_json(F.col(body), _series_schema(variables))
    parsed = pages.withColumn("_page", page).drop(body)
    zipped = F.arrays_zip(*[F.col(f"_page.hourly.{c}").alias(c) for c in ("time", *variables)])
    return (
        parsed.withColumn("offset", F.col("_page.utc_offset_seconds"))
        .select("*", F.posexplode(zipped).alias("slot", "_at"))
        .select("*", "_at.*")
        .drop("_page", "_at")
    )


def explode_model_hours(pages: DataFrame, window: Stretch) -> DataFrame:
    """Model PM2.5 rows inside the window. A null hour gives no row.

    Cloud, vegetation and aerosol are not fetched for a comparison; they are fixed
    zeros and an index over these rows would mean nothing.
    """
    rows = explode_hourly(pages, ("pm2_5",))
    return (
        rows.withColumn("ts", F.col("time").try_cast("timestamp"))
        .where(F.col("pm2_5").isNotNull() & inside(window))
        .select(
            "ts",
            "region",
            "city",
            *[F.lit(0.0).alias(c) for c in ("cloud_cover_pct", "vegetation_index", "aerosol_index")],
            F.col("pm2_5").alias("model_pm25_ugm3"),
        )
    )


@dataclass(frozen=True)
class Readings:
    """Weather rows, satellite rows, and every slot that gave no reading, with why."""

    weather: DataFrame
    satellite: DataFrame
    missing: DataFrame


def _missing(rows: DataFrame, stream: str, reason: Column) -> DataFrame:
    return rows.select(
        F.lit("provider").alias("source"), F.lit(stream).alias("stream"), "region", "city",
        F.col("time").alias("slot"), reason.alias("reason"),
    )


def weather_range_fault() -> Column:
    return (F.col("precipitation") < 0) | (F.col("wind_speed_10m") < 0)


def satellite_range_fault() -> Column:
    cloud = F.col("cloud_cover")
    return (cloud < 0) | (cloud > 100) | (F.col("pm2_5") < 0)


def weather_air_join(weather: DataFrame, air: DataFrame) -> DataFrame:
    """Weather slots with the air slot of the same city and time text, if it is whole.

    Slots pair by time and not by position, so series of unequal length stay right.
    """
    usable = air.where(
        (F.col("offset") == 0) & F.col("aerosol_optical_depth").isNotNull() & F.col("pm2_5").isNotNull()
    )
    # Of a repeated time the later slot of the page counts.
    latest = F.max_by(F.struct(*AIR_VARIABLES), "slot")
    slots = usable.groupBy("region", "city", "time").agg(latest.alias("_a")).select(
        "region", "city", "time", "_a.*"
    )
    return weather.join(slots, ["region", "city", "time"], "left")


def explode_weather_air_history(
    weather_pages: DataFrame, air_pages: DataFrame, cutoff: Column, cfg: Settings
) -> Readings:
    """Hourly history. A slot gives weather only when its four weather values exist,
    and satellite only when the air values exist as well."""
    weather = explode_hourly(weather_pages, WEATHER_VARIABLES)
    air = explode_hourly(air_pages, AIR_VARIABLES)
    slots = weather_air_join(weather.where((F.col("offset") == 0) & F.col("time").isNotNull()), air)
    slots = slots.withColumn("ts", parse_provider_time(F.col("time"), F.col("offset")))
    known = slots.where(F.col("ts").isNull() | (F.col("ts") <= cutoff))

    whole = F.lit(True)
    for name in WEATHER_VARIABLES:
        whole = whole & F.col(name).isNotNull()
    has_air = F.col("pm2_5").isNotNull()
    weather_reason = (
        F.when(F.col("ts").isNull(), "malformed")
        .when(~whole, "missing_field")
        .when(weather_range_fault(), "out_of_range")
    )
    # A slot without whole weather is counted once, under weather.
    satellite_reason = F.when(
        F.col("ts").isNotNull() & whole,
        F.when(~has_air, "missing_field").when(satellite_range_fault(), "out_of_range"),
    )
    judged = known.withColumns({"_w": weather_reason, "_s": satellite_reason})
    weather_rows = judged.where(F.col("_w").isNull()).select(
        "ts", "region", "city",
        F.col("temperature_2m").alias("temperature_c"),
        F.col("precipitation").alias("rainfall_mm"),
        F.col("wind_speed_10m").alias("wind_speed_ms"),
    )
    satellite_rows = with_vegetation_reference(
        judged.where(F.col("ts").isNotNull() & whole & F.col("_s").isNull()), cfg
    ).select(
        "ts", "region", "city",
        F.col("cloud_cover").alias("cloud_cover_pct"),
        "vegetation_index",
        F.col("aerosol_optical_depth").alias("aerosol_index"),
        F.col("pm2_5").alias("model_pm25_ugm3"),
    )
    missing = _missing(judged.where(F.col("_w").isNotNull()), "weather", F.col("_w")).unionByName(
        _missing(judged.where(F.col("_s").isNotNull()), "satellite", F.col("_s"))
    )
    return Readings(weather_rows, satellite_rows, missing)


def flatten_current_readings(weather_pages: DataFrame, air_pages: DataFrame, cfg: Settings) -> Readings:
    """One current reading per city and stream.

    Weather needs three values. Satellite needs both pages: cloud cover comes from
    the weather page and the time from the air page; their times are not compared.
    """
    def current(pages: DataFrame, variables: tuple[str, ...], prefix: str) -> DataFrame:
        page = pages.withColumn("_p", F.from_json("body", _current_schema(variables)))
        time, offset = F.col("_p.current.time"), F.col("_p.utc_offset_seconds")
        return page.select(
            "region", "city",
            F.col("_p.current").isNotNull().alias(f"{prefix}_block"),
            time.alias(f"{prefix}_time"),
            parse_provider_time(time, offset).alias(f"{prefix}_ts"),
            *[F.col(f"_p.current.{v}").alias(v) for v in variables],
        )

    w = current(weather_pages, WEATHER_VARIABLES, "w")
    a = current(air_pages, AIR_VARIABLES, "a")
    both = w.join(a, ["region", "city"], "full_outer")
    three = F.col("temperature_2m").isNotNull() & F.col("precipitation").isNotNull() & F.col("wind_speed_10m").isNotNull()
    air_values = F.col("cloud_cover").isNotNull() & F.col("aerosol_optical_depth").isNotNull() & F.col("pm2_5").isNotNull()
    w_block, a_block = (F.coalesce(F.col(c), F.lit(False)) for c in ("w_block", "a_block"))
    weather_reason = (
        F.when(~w_block, "missing_field")
        .when(F.col("w_ts").isNull(), "offset_or_time")
        .when(~three, "missing_field")
        .when(weather_range_fault(), "out_of_range")
    )
    satellite_reason = (
        F.when(~(w_block & a_block), "missing_field")
        .when(F.col("a_ts").isNull(), "offset_or_time")
        .when(~air_values, "missing_field")
        .when(satellite_range_fault(), "out_of_range")
    )
    judged = both.withColumns({"_w": weather_reason, "_s": satellite_reason})
    weather_rows = judged.where(F.col("_w").isNull()).select(
        F.col("w_ts").alias("ts"), "region", "city",
        F.col("temperature_2m").alias("temperature_c"),
        F.col("precipitation").alias("rainfall_mm"),
        F.col("wind_speed_10m").alias("wind_speed_ms"),
    )
    satellite_rows = with_vegetation_reference(
        judged.where(F.col("_s").isNull()).withColumn("ts", F.col("a_ts")), cfg
    ).select(
        "ts", "region", "city",
        F.col("cloud_cover").alias("cloud_cover_pct"),
        "vegetation_index",
        F.col("aerosol_optical_depth").alias("aerosol_index"),
        F.col("pm2_5").alias("model_pm25_ugm3"),
    )
    missing = _missing(
        judged.where(F.col("_w").isNotNull()).withColumn("time", F.col("w_time")), "weather", F.col("_w")
    ).unionByName(
        _missing(judged.where(F.col("_s").isNotNull()).withColumn("time", F.col("a_time")), "satellite", F.col("_s"))
    )
    return Readings(weather_rows, satellite_rows, missing)


def read_capture(spark: SparkSession, root: str, window_name: str, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """Station and model rows of one named window; refuses when a side is empty."""
    cfg.window(window_name)
    stations = spark.read.schema(S.STATION_SCHEMA).json(f"{root}/{window_name}/station")
    models = spark.read.schema(S.SATELLITE_SCHEMA).json(f"{root}/{window_name}/model")
    for side, df in (("station", stations), ("model", models)):
        if df.isEmpty():
            raise CaptureFault(f"the {side} side of {window_name} is empty")
    return stations, models


def write_capture(stations: DataFrame, models: DataFrame, root: str, window_name: str) -> None:
    for side, df in (("station", stations), ("model", models)):
        writer = df.write.mode("overwrite").option("timestampFormat", CAPTURE_TIME)
        writer.json(f"{root}/{window_name}/{side}")


ADMISSION_SCHEMA = (
    "derived_at STRING, cities MAP<STRING, STRUCT<region: STRING, domain: STRING, radius_m: BIGINT, "
    "radius_capped: BOOLEAN, sensor_location_ids: ARRAY<BIGINT>>>"
)


def read_admission(
    spark: SparkSession, path: str, version: str | None = None, multi_line: bool = True
) -> DataFrame:
    """Locations of the named admission artifact, or of the newest.

    An artifact's version is the date it was derived on. A large one may be split
    over several documents, one per line with ``multi_line=False``.
    """
    documents = spark.read.schema(ADMISSION_SCHEMA).option("multiLine", multi_line).json(path)
    dated = documents.withColumn("version", F.substring("derived_at", 1, 10))
    if version is None:
        version = dated.agg(F.max("version")).first()[0]
    chosen = dated.where(F.col("version") == F.lit(version))
    if version is None or chosen.isEmpty():
        raise CaptureFault(f"no admission artifact {version!r} under {path}")
    return (
        chosen.select("version", F.explode("cities").alias("city", "entry"))
        .select("version", "city", "entry.*")
        .select(
            "version", "city", "region", "domain",
            F.explode("sensor_location_ids").alias("location_id"),
        )
        .withColumn("station_id", F.col("location_id").cast("string"))
    )
