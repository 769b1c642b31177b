"""The analytics tables re-read as the sensor domain.

``events`` becomes weather, satellite and station rows, ``customer`` the station
locations, ``orders`` their sensors and a long daily temperature series. Every row
of a table is used.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import CITIES, REGIONS, Settings, Stretch
from envgrade.functions.dims import literal_table
from envgrade.operators.capture import station_hour_gate
from envgrade.session import land
from envgrade.sources.envelopes import wrap_envelopes
from envgrade.sources.pages import explode_station_hours

WINDOW_MINUTES = 360


def utc(year: int, month: int, day: int) -> datetime:
    return datetime(year, month, day, tzinfo=timezone.utc)


FIRST_HALF = Stretch(utc(2024, 1, 1), timedelta(days=15))
SECOND_HALF = Stretch(utc(2024, 1, 16), timedelta(days=15))
WHOLE_MONTH = Stretch(utc(2024, 1, 1), timedelta(days=30))
# Bounds of spans that the month's events come in, in order of time.
_EDGES = [utc(2024, 1, day) for day in (1, 8, 16, 23, 31)]
QUARTERS = list(zip(_EDGES, _EDGES[1:]))
SENSOR_WINDOW = Stretch(utc(1997, 3, 1), timedelta(days=61))


def settings(minutes: int = WINDOW_MINUTES) -> Settings:
    return Settings(window_minutes=minutes).with_windows(
        first_half=FIRST_HALF, second_half=SECOND_HALF, month=WHOLE_MONTH
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt over all cores, for work that costs far more than a shuffle of narrow rows.

    A file is cut by bytes, but its rows come by row groups: one with fewer groups than cores would leave the work to a
    few tasks, however many pieces it is read in.
    """
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()))


def region_of(ci: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (F.floor(ci / 3) + 1).cast("int"))


def city_of(ci: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(ci.cast("string"), 2, "0"))


def domain_of(city: Column) -> Column:
    """Grid that serves a city: a property of the city, not of its region."""
    return F.when(city.isin("C00", "C01", "C02", "C08"), "europe").otherwise("global")


def city_domains(spark: SparkSession) -> DataFrame:
    cities = literal_table(spark, ["ci"], [(i,) for i in range(12)])
    named = cities.select(region_of(F.col("ci")).alias("region"), city_of(F.col("ci")).alias("city"))
    return F.broadcast(named.withColumn("domain", domain_of(F.col("city"))))


def _base(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        F.col("event_type").alias("action"),
        "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("k"),
        (F.col("user_id") % 12).alias("ci"),
    ).withColumns({"region": region_of(F.col("ci")), "city": city_of(F.col("ci"))})


def event_type_of() -> Column:
    """AFR gets no stations, so that one region is never covered."""
    station = F.col("action").isin("error", "signup") & (F.col("region") != "AFR")
    return F.when(F.col("action") == "purchase", S.SATELLITE).when(station, S.STATION).otherwise(S.WEATHER)


def to_events(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the ``events`` layout as wide domain events."""
    base = _base(raw).withColumn("event_type", event_type_of())
    weather, satellite, station = (F.col("event_type") == t for t in S.EVENT_TYPES)
    value, k = F.col("value"), F.col("k")
    samples = (F.lit(1) + k % 4).cast("int")
    return base.select(
        *keep,
        "event_type",
        F.when(station, F.date_trunc("hour", "ts")).otherwise(F.col("ts")).alias("ts"),
        "region",
        F.when(~weather, F.col("city")).alias("city"),
        F.when(station, F.concat(F.lit("S"), F.col("user_id").cast("string"))).alias("station_id"),
        F.when(weather, value / 10.0).alias("temperature_c"),
        F.when(weather, k / 4.0).alias("rainfall_mm"),
        F.when(weather, k / 10.0).alias("wind_speed_ms"),
        F.when(satellite, k).alias("cloud_cover_pct"),
        F.when(satellite, (k - 50.0) / 50.0).alias("vegetation_index"),
        F.when(satellite, value / 50.0).alias("aerosol_index"),
        F.when(satellite, value).alias("model_pm25_ugm3"),
        F.when(station, value - 5.0).alias("pm25_ugm3"),
        F.when(station, samples).alias("sample_count"),
        F.when(station, F.when(samples == 1, S.PROVIDER_HOURLY).otherwise(S.COMPUTED_MEAN)).alias(
            "construction"
        ),
    )


def events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return to_events(table(spark, sf_dir, "events"), keep)


def stations_of(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == S.STATION).select(*S.STATION_SCHEMA.names)


def satellites_of(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == S.SATELLITE).select(*S.SATELLITE_SCHEMA.names)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations_of(events(spark, sf_dir))


def satellites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return satellites_of(events(spark, sf_dir))


# --- messages with seeded faults -------------------------------------------------


def _spoilt(n: int, pattern: str, replacement: str):
    """A function over the text, so that what comes before it is evaluated once."""
    return lambda x: F.when(F.col("event_id") % n == 0, F.regexp_replace(x, pattern, replacement)).otherwise(x)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(spread(table(spark, sf_dir, "events")))


def messages_of(source: DataFrame) -> DataFrame:
    """One envelope per event; some are spoilt, by event number, in ten ways."""
    wrapped = wrap_envelopes(to_events(source, keep=("event_id",)), keep=("event_id",))
    # Fault by event number, pattern and replacement, in this order.
    faults = (
        (97, '"(rainfall_mm|cloud_cover_pct|sample_count)":[^,}]*', '"$1":-7'),
        (139, '"(wind_speed_ms|model_pm25_ugm3|pm25_ugm3)":([^,}]*)', '"$1":" $2 "'),
        (101, '"(temperature_c|aerosol_index|pm25_ugm3)":[^,}]*', '"$1":"abc"'),
        (103, ',"(wind_speed_ms|model_pm25_ugm3|construction)":("[^"]*"|[^,}]*)', ""),
        (109, 'Z"', '+02:00"'),
        (131, '"payload":\\{', '"payload":{"extra":1,'),
        (107, '"event_type":"[a-z]+"', '"event_type":"radar"'),
        (137, '"key":"[A-Z]+"', '"key":"XXX"'),
        (127, '"payload":.*$', '"payload":[1]}'),
        (113, "..$", ""),
    )
    text = F.col("value")
    for n, pattern, replacement in faults:
        text = F.transform(F.array(text), _spoilt(n, pattern, replacement))[0]
    return wrapped.select("event_id", "key", text.alias("value"))


# --- provider pages --------------------------------------------------------------


def hour_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One provider page of one hour entry per event, some of them unusable."""
    base = _base(spread(table(spark, sf_dir, "events")))

    def every(n: int) -> Column:
        return F.col("event_id") % n == 0

    hour = F.date_trunc("hour", "ts")
    starts = F.when(every(17), hour + F.expr("INTERVAL 30 MINUTES")).otherwise(hour)
    length = F.when(every(31), F.expr("INTERVAL 90 MINUTES")).otherwise(F.expr("INTERVAL 60 MINUTES"))
    stamp = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    observed = F.when(every(29), 0).otherwise((F.lit(1) + F.col("k") % 4).cast("int"))
    expected = F.lit(4)
    percent = F.when(every(41), 50.0).otherwise(observed * 25.0)
    entry = F.to_json(
        F.struct(
            F.when(~every(23), F.col("value") - 5.0).alias("value"),
            F.struct(every(19).alias("hasFlags")).alias("flagInfo"),
            F.struct(
                F.struct(F.date_format(starts, stamp).alias("utc")).alias("datetimeFrom"),
                F.struct(F.date_format(starts + length, stamp).alias("utc")).alias("datetimeTo"),
            ).alias("period"),
            F.struct(
                expected.alias("expectedCount"),
                observed.alias("observedCount"),
                percent.alias("percentComplete"),
            ).alias("coverage"),
            F.struct(F.lit(1.0).alias("min"), F.when(every(43), 2.0).otherwise(1.0).alias("max")).alias("summary"),
        ),
        {"ignoreNullFields": "false"},
    )
    entry = F.when(every(37), F.lit('"n/a"')).otherwise(entry)
    body = F.concat(F.lit('{"meta":{"page":1},"results":['), entry, F.lit("]}"))
    return base.select("event_id", F.col("user_id").alias("location_id"), body.alias("body"))


def hour_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the stations: every user of the events table."""
    return _base(table(spark, sf_dir, "events")).select(
        F.col("user_id").alias("location_id"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("station_id"),
        "city",
        "region",
    ).distinct()


def gated_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = hour_pages(spark, sf_dir)
    return station_hour_gate(explode_station_hours(pages, hour_locations(spark, sf_dir)))


def landed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gated hours as a table, for reports that read them more than once."""
    return land(gated_hours(spark, sf_dir).drop("entry"), "hours")


def _series_pages(hourly: DataFrame, variables: dict[str, str], bad_offset: Column) -> DataFrame:
    """Parallel-array pages of one city and day, so at most 24 slots long."""
    slots = F.array_sort(F.collect_list(F.struct("hour", *variables)))
    pages = hourly.groupBy("region", "city", F.to_date("hour").alias("day")).agg(slots.alias("s"))
    arrays = [F.col(f"s.{c}").alias(name) for c, name in variables.items()]
    time = F.transform("s", lambda x: F.date_format(x["hour"], "yyyy-MM-dd'T'HH:mm")).alias("time")
    body = F.to_json(
        F.struct(
            F.when(bad_offset, 3600).otherwise(0).alias("utc_offset_seconds"),
            F.struct(time, *arrays).alias("hourly"),
        ),
        {"ignoreNullFields": "false"},
    )
    return pages.select("region", "city", body.alias("body"))


def hourly_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean value and k per city and hour; an hour number divisible by 13 has no value."""
    base = _base(table(spark, sf_dir, "events"))
    means = base.groupBy("region", "city", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.avg("value").alias("mv"), F.avg("k").alias("mk")
    )
    hour_number = F.floor(F.unix_seconds("hour") / 3600)
    return means.withColumn("hn", hour_number)


def model_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hourly_values(spark, sf_dir).withColumn("pm", F.when(F.col("hn") % 13 != 0, F.col("mv")))
    return _series_pages(hours, {"pm": "pm2_5"}, F.lit(False))


def history_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Weather and air pages whose slots do not line up, with gaps on both sides."""
    hours = hourly_values(spark, sf_dir)
    weather = hours.withColumns(
        {
            "t": F.when(F.col("hn") % 13 != 0, F.col("mv") / 10.0),
            "p": F.col("mk") / 4.0,
            "w": F.when(F.col("hn") % 17 == 0, F.lit(-1.0)).otherwise(F.col("mk") / 10.0),
            "c": F.col("mk"),
        }
    )
    air = hours.where(F.col("hn") % 5 != 0).withColumns(
        {"a": F.col("mv") / 50.0, "m": F.when(F.col("hn") % 7 != 0, F.col("mv"))}
    )
    names = {"t": "temperature_2m", "p": "precipitation", "w": "wind_speed_10m", "c": "cloud_cover"}
    return (
        _series_pages(weather, names, F.lit(False)),
        _series_pages(air, {"a": "aerosol_optical_depth", "m": "pm2_5"}, F.dayofmonth("day") == 9),
    )


def current_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Newest weather and air reading per user, the user standing in for a city."""
    base = _base(table(spark, sf_dir, "events")).withColumn(
        "place", F.concat(F.lit("U"), F.col("user_id").cast("string"))
    )
    newest = F.max_by(F.struct("ts", "value", "k"), F.struct("ts", "event_id")).alias("n")
    weather = base.where(F.col("action") != "purchase").groupBy("region", "place").agg(newest)
    air = base.where(F.col("action") == "purchase").groupBy("region", "place").agg(newest)

    def page(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
        time = F.date_format("n.ts", "yyyy-MM-dd'T'HH:mm").alias("time")
        body = F.to_json(
            F.struct(
                F.lit(0).alias("utc_offset_seconds"),
                F.struct(time, *[c.alias(name) for name, c in fields.items()]).alias("current"),
            ),
            {"ignoreNullFields": "false"},
        )
        return df.select("region", F.col("place").alias("city"), body.alias("body"))

    value, k = F.col("n.value"), F.col("n.k")
    cloud = F.when(k % 5 != 0, k)
    return (
        page(weather, {"temperature_2m": value / 10.0, "precipitation": k / 4.0, "wind_speed_10m": k / 10.0, "cloud_cover": cloud}),
        page(air, {"aerosol_optical_depth": value / 50.0, "pm2_5": value}),
    )


# --- locations, sensors, calls and daily series ----------------------------------


def grid_points(spark: SparkSession) -> DataFrame:
    """The grid point that serves each configured city."""
    rows = [
        (REGIONS[i // 3], f"C{i:02d}", city.latitude, city.longitude)
        for i, city in enumerate(c for r in REGIONS for c in CITIES[r])
    ]
    dim = literal_table(spark, ["region", "city", "lat", "lon"], rows)
    dim = dim.withColumn("domain", domain_of(F.col("city")))
    step = F.when(F.col("domain") == "europe", 0.1).otherwise(0.4)
    return F.broadcast(
        dim.select(
            "region", "city", "domain",
            (F.floor(F.col("lat") / step) * step).alias("grid_lat"),
            (F.floor(F.col("lon") / step) * step).alias("grid_lon"),
        )
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations, scattered around their city's grid point."""
    ci = F.col("c_custkey") % 12
    placed = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("location_id"),
        city_of(ci).alias("city"),
        (F.col("c_nationkey") - 12.0).alias("dlat"),
        F.col("c_acctbal"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_mobile"),
        (F.col("c_mktsegment") != "MACHINERY").alias("is_monitor"),
    )
    return placed.join(grid_points(spark), "city").select(
        "location_id",
        F.col("city").alias("home_city"),
        (F.col("grid_lat") + F.col("dlat") * 0.02).alias("latitude"),
        (F.col("grid_lon") + (F.col("c_acctbal") - 4500.0) / 20000.0).alias("longitude"),
        "is_mobile",
        "is_monitor",
    )


def candidate_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ci = F.col("c_custkey") % 12
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("location_id"),
        F.col("c_custkey").cast("string").alias("station_id"),
        city_of(ci).alias("city"),
        region_of(ci).alias("region"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_mobile"),
        (F.col("c_mktsegment") != "MACHINERY").alias("is_monitor"),
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sensors: the priority decides what they measure."""
    pm25 = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    first = F.col("o_orderdate").cast("timestamp")
    wrong_unit = pm25 & (F.col("o_orderkey") % 50 == 0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sensor_id"),
        F.col("o_custkey").alias("location_id"),
        F.col("o_orderkey").alias("position"),
        F.when(pm25, "pm25").otherwise("o3").alias("parameter"),
        F.when(wrong_unit | ~pm25, "ppm").otherwise("µg/m³").alias("units"),
        first.alias("datetime_first"),
        F.timestamp_seconds(
            F.unix_seconds(first) + F.floor(F.col("o_totalprice") / 200.0) * 86400
        ).alias("datetime_last"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(table(spark, sf_dir, "events"))
    eid = F.col("event_id")
    return base.select(
        "city",
        F.when(eid % 2111 == 0, 429).when(eid % 1999 == 0, 500).otherwise(200).alias("status"),
        (F.col("action") == "signup").alias("domain_probe"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unavailable readings: the removed hours, and faults of the call itself."""
    base = _base(table(spark, sf_dir, "events"))
    eid = F.col("event_id")
    reason = (
        F.when(eid % 13 == 0, "timeout")
        .when(eid % 11 == 0, "rate_limited")
        .when(eid % 7 == 0, "missing_field")
        .when(eid % 5 == 0, "no_hour")
        .otherwise("status")
    )
    return base.select(
        F.when(F.col("action") == "purchase", "model").otherwise("station").alias("source"),
        F.col("action").alias("stream"),
        "city",
        reason.alias("reason"),
    )


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a daily temperature series over years; low priority days are null."""
    ci = F.col("o_custkey") % 12
    return table(spark, sf_dir, "orders").select(
        region_of(ci).alias("region"),
        city_of(ci).alias("city"),
        F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") / 10000.0).alias("value"),
    )
