"""One query per inventory row, over the analytics tables read as the sensor domain.

Result columns are plain: timestamps without zone (UTC), integers as BIGINT, doubles
rounded to ten decimals. Keys start with the inventory number.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envgrade import schemas as S
from envgrade.functions import scalars as X
from envgrade.operators import admission as AD
from envgrade.operators import capture as CP
from envgrade.operators import gate as G
from envgrade.operators import guards as GD
from envgrade.operators import index as IX
from envgrade.operators import reconcile as RC
from envgrade.operators import reports as R
from envgrade.plans import inputs as I
from envgrade.session import land, prepare, scratch_path
from envgrade.sources import captures as CA
from envgrade.sources import envelopes as EV
from envgrade.sources import pages as PG
from envgrade.sources import tables as TB
from envgrade.streaming import flows
from envgrade.streaming.partials import counted_rows
from envgrade.streaming.telemetry import METRICS_SCHEMA, MetricsListener

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CFG = I.settings()
HOURLY = I.settings(60)


def tidy(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c, 10) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(key: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(prepare(spark), sf_dir))

        QUERIES[key] = run
        return fn

    return register


# --- shared inputs --------------------------------------------------------------


def records(spark: SparkSession, d: str, cfg=CFG) -> DataFrame:
    return IX.compute_records(I.events(spark, d), cfg)


def scored(spark: SparkSession, d: str, cfg=CFG) -> DataFrame:
    return IX.score_windows(IX.aggregate_windows(I.events(spark, d), cfg), cfg)


def city_windows(spark: SparkSession, d: str, cfg=CFG) -> DataFrame:
    return RC.city_windows(I.stations(spark, d), I.satellites(spark, d), cfg)


def compared(spark: SparkSession, d: str) -> DataFrame:
    """City-windows that belong to a record. Every window here holds index inputs."""
    return R.compared_rows(city_windows(spark, d), records(spark, d))


def landed_comparison(spark: SparkSession, d: str) -> DataFrame:
    """The same as a table of the run, for reports that read it on several branches. One row per city and window."""
    return land(compared(spark, d), "compared")


def reconciled(spark: SparkSession, d: str) -> DataFrame:
    return RC.reconcile_rows(records(spark, d), I.stations(spark, d), I.satellites(spark, d), CFG)


def gated(spark: SparkSession, d: str) -> DataFrame:
    return G.validate_envelopes(I.messages(spark, d), CFG)


def resolved(spark: SparkSession, d: str) -> DataFrame:
    return AD.resolve_sensors(I.candidate_locations(spark, d), I.sensors(spark, d), I.SENSOR_WINDOW, CFG)


def in_radius(spark: SparkSession, d: str) -> DataFrame:
    grid = AD.with_radius(I.grid_points(spark), CFG)
    return AD.stations_in_radius(I.locations(spark, d), grid, CFG)


def split_captures(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    st = I.stations(spark, d)
    return RC.in_named_window(st, "first_half", CFG), RC.in_named_window(st, "second_half", CFG)


def without_detail(df: DataFrame) -> DataFrame:
    return df.drop("city_comparisons")


# --- sources --------------------------------------------------------------------


@query("s_01_read_envelopes")
def _(spark, d):
    path = scratch_path(spark, "envelopes")
    EV.wrap_envelopes(I.events(spark, d)).select("value").write.text(path)
    return EV.read_envelopes(spark, path).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("s_02_explode_station_hours")
def _(spark, d):
    rows = PG.explode_station_hours(I.hour_pages(spark, d), I.hour_locations(spark, d))
    return rows.select("location_id", "station_id", "city", "region", "value", "starts", "ends", "flagged", "observed")


@query("s_03_explode_model_hours")
def _(spark, d):
    return PG.explode_model_hours(I.model_pages(spark, d), I.FIRST_HALF).select(
        "region", "city", "ts", "model_pm25_ugm3"
    )


def _history(spark, d):
    weather, air = I.history_pages(spark, d)
    cutoff = F.lit(I.utc(2024, 1, 25))
    return PG.explode_weather_air_history(weather, air, cutoff, CFG)


@query("s_04_weather_air_history")
def _(spark, d):
    h = _history(spark, d)
    slot = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    kept = h.weather.select(
        F.lit("weather").alias("stream"), "region", "city", slot.alias("slot"),
        F.lit("reading").alias("status"), F.col("temperature_c").alias("value"),
        F.lit(None).cast("double").alias("vegetation"),
    ).unionByName(
        h.satellite.select(
            F.lit("satellite").alias("stream"), "region", "city", slot.alias("slot"),
            F.lit("reading").alias("status"), F.col("model_pm25_ugm3").alias("value"),
            F.col("vegetation_index").alias("vegetation"),
        )
    )
    lost = h.missing.select(
        "stream", "region", "city", "slot", F.col("reason").alias("status"),
        F.lit(None).cast("double").alias("value"), F.lit(None).cast("double").alias("vegetation"),
    )
    return kept.unionByName(lost)


@query("s_05_flatten_current")
def _(spark, d):
    weather, air = I.current_pages(spark, d)
    r = PG.flatten_current_readings(weather, air, CFG)
    return r.weather.select(
        F.lit("weather").alias("stream"), "region", "city", "ts",
        F.col("temperature_c").alias("v1"), F.col("rainfall_mm").alias("v2"),
    ).unionByName(
        r.satellite.select(
            F.lit("satellite").alias("stream"), "region", "city", "ts",
            F.col("model_pm25_ugm3").alias("v1"), F.col("cloud_cover_pct").alias("v2"),
        )
    )


@query("s_06_read_capture")
def _(spark, d):
    root = scratch_path(spark, "capture")
    PG.write_capture(
        RC.in_named_window(I.stations(spark, d), "first_half", CFG),
        RC.in_named_window(I.satellites(spark, d), "first_half", CFG),
        root, "first_half",
    )
    stations, models = PG.read_capture(spark, root, "first_half", CFG)
    return stations.select(
        "ts", "region", "city", "station_id", F.col("pm25_ugm3").alias("value"), "construction"
    ).unionByName(
        models.select(
            "ts", "region", "city", F.lit(None).cast("string").alias("station_id"),
            F.col("model_pm25_ugm3").alias("value"), F.lit(None).cast("string").alias("construction"),
        )
    )


@query("s_07_read_admission")
def _(spark, d):
    path = scratch_path(spark, "admission")
    loc = I.candidate_locations(spark, d)
    entry = F.struct(
        "region", I.domain_of(F.col("city")).alias("domain"), F.array("location_id").alias("sensor_location_ids")
    )
    newest = F.when(F.col("location_id") % 3 == 0, "2024-02-01").otherwise("2024-03-01")
    body = F.to_json(
        F.struct(
            F.concat(newest, F.lit("T00:00:00Z")).alias("derived_at"),
            F.create_map(F.col("city"), entry).alias("cities"),
        )
    )
    loc.select(body.alias("value")).write.text(path)
    return PG.read_admission(spark, path, multi_line=False)


@query("s_08_union_sources")
def _(spark, d):
    ev = I.events(spark, d)
    out, failures = EV.union_sources(
        {
            "stations": I.stations_of(ev),
            "models": I.satellites_of(ev),
            "absent": lambda: spark.read.parquet(f"{d}/no_such_source.parquet"),
        }
    )
    counts = out.groupBy("source", "city").agg(
        F.count(F.lit(1)).alias("n"), F.count("pm25_ugm3").alias("station_values"),
        F.count("model_pm25_ugm3").alias("model_values"),
    )
    return counts.unionByName(EV.failure_rows(spark, failures), allowMissingColumns=True)


@query("s_08_land_sources")
def _(spark, d):
    """As above, with a source that opens and fails while it is read."""
    ev = I.events(spark, d)
    out, failures = EV.land_sources(
        spark,
        {
            "stations": lambda: I.stations_of(ev),
            "models": lambda: I.satellites_of(ev),
            "refused": lambda: I.stations_of(ev).withColumn("pm25_ugm3", F.col("city").cast("double")),
        },
        scratch_path(spark, "landed"),
    )
    counts = out.groupBy("source", "city").agg(
        F.count(F.lit(1)).alias("n"), F.count("pm25_ugm3").alias("station_values"),
        F.count("model_pm25_ugm3").alias("model_values"),
    )
    failed = EV.failure_rows(spark, failures).drop("fault")
    return counts.unionByName(failed, allowMissingColumns=True)


@query("s_09_wrap_envelopes")
def _(spark, d):
    wrapped = EV.wrap_envelopes(I.events(spark, d, keep=("event_id",)), keep=("event_id",))
    return wrapped.select(
        "event_id", "key",
        F.get_json_object("value", "$.event_type").alias("event_type"),
        F.get_json_object("value", "$.payload.ts").alias("ts_text"),
        F.coalesce(
            F.get_json_object("value", "$.payload.temperature_c"),
            F.get_json_object("value", "$.payload.model_pm25_ugm3"),
            F.get_json_object("value", "$.payload.pm25_ugm3"),
        ).cast("double").alias("main_value"),
        F.size(F.json_object_keys(F.get_json_object("value", "$.payload"))).alias("fields"),
    )


# --- tables ---------------------------------------------------------------------


def _two_batches(spark, d) -> str:
    """A table whose batch 1 holds half the events; batch 2, all of them, written twice."""
    path = scratch_path(spark, "records")
    ev = I.events(spark, d)
    part = ev.where(F.col("ts") < F.lit(I.FIRST_HALF.end))
    TB.upsert_records(IX.compute_records(part, CFG), path, 1)
    full = IX.compute_records(ev, CFG)
    TB.upsert_records(full, path, 2)
    TB.upsert_records(full, path, 2)
    return path


@query("k_01_upsert_records")
def _(spark, d):
    table = TB.read_record_table(spark, _two_batches(spark, d))
    return table.groupBy("batch_id", "region").agg(F.count(F.lit(1)).alias("n"))


@query("k_02_append_raw")
def _(spark, d):
    path = scratch_path(spark, "raw")
    TB.append_raw(G.valid_events(gated(spark, d)), path)
    return (
        spark.read.parquet(path)
        .groupBy("event_type", "region", F.col("event_date").cast("string").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("k_03_fan_out")
def _(spark, d):
    durable, serving = scratch_path(spark, "durable"), scratch_path(spark, "serving")
    TB.fan_out(
        records(spark, d), 7,
        lambda df, i: TB.upsert_records(df, durable, i),
        lambda df, i: TB.upsert_records(df, serving, i),
    )
    rows = [TB.read_record_table(spark, p).withColumn("copy", F.lit(n)) for n, p in (("durable", durable), ("serving", serving))]
    return rows[0].unionByName(rows[1]).groupBy("copy", "region").agg(
        F.count(F.lit(1)).alias("n"), F.avg("impact_index").alias("mean_index")
    )


@query("k_04_current_records")
def _(spark, d):
    return without_detail(TB.current_records(TB.read_record_table(spark, _two_batches(spark, d)))).drop("run")


@query("k_04_compact_records")
def _(spark, d):
    into = scratch_path(spark, "compact")
    TB.compact_records(spark, _two_batches(spark, d), into)
    return without_detail(TB.read_record_table(spark, into)).drop("run")


@query("k_05_region_series")
def _(spark, d):
    return without_detail(TB.served_series(spark, _two_batches(spark, d), "NAM"))


@query("k_06_legacy_states")
def _(spark, d):
    old = records(spark, d).select(*S.KEY, *S.INDEX_COLUMNS[:5])
    return TB.with_legacy_states(old).withColumn("details", F.size("city_comparisons")).drop("city_comparisons")


@query("k_07_write_quarantine")
def _(spark, d):
    path = scratch_path(spark, "quarantine")
    TB.write_quarantine(G.quarantine_rows(gated(spark, d)), path)
    kept = spark.read.parquet(path)
    return kept.groupBy("event_type", "reason_code").agg(
        F.count(F.lit(1)).alias("n"), F.count("raw").alias("with_raw")
    )


@query("k_08_verify_snapshot")
def _(spark, d):
    report = TB.snapshot_report(records(spark, d), CFG)
    return report.withColumn("missing_regions", F.array_join(F.array_sort("missing_regions"), ","))


@query("k_08_publish_snapshot")
def _(spark, d):
    """Two versions are published, one is refused; another session is asked what is served."""
    root, every = scratch_path(spark, "snapshots"), records(spark, d)
    TB.publish_snapshot(every.where(F.col("window_start") < F.lit(I.FIRST_HALF.end)), root, "1", None, CFG)
    TB.publish_snapshot(every, root, "2", None, CFG)
    try:
        TB.publish_snapshot(every.where("region <> 'NAM'"), root, "3", None, CFG)
    except TB.SnapshotFault:
        pass
    version = TB.snapshot_version(spark.newSession(), root)
    counts = TB.read_snapshot(spark, root).groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.avg("impact_index").alias("mean_index")
    )
    return counts.withColumn("version", F.lit(version))


@query("k_09_capture_report")
def _(spark, d):
    hours = I.landed_hours(spark, d)
    return CP.capture_report(
        "month", hours, CP.retained_stations(hours), I.satellites(spark, d),
        I.candidate_locations(spark, d), resolved(spark, d),
    )


@query("k_10_capture_run")
def _(spark, d):
    """Three attempts: hours that repeat, hours that do not, and a window that is too short."""
    root = scratch_path(spark, "captures")
    hours, models, found = I.landed_hours(spark, d), I.satellites(spark, d), resolved(spark, d)
    retained = F.col("gate_reason") == CP.RETAINED
    once = hours.where(retained).groupBy("station_id", "starts").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    single = hours.where(~retained).unionByName(
        hours.where(retained).join(once.drop("n"), ["station_id", "starts"], "left_semi").select(*hours.columns)
    )
    for window, rows in (("month", hours), ("month", single), ("first_half", single)):
        CA.run_capture(spark, root, window, rows, models, found, CFG)
    stations, _models = CA.kept_capture(spark, root, "month", CFG)
    readable = stations.agg(F.count(F.lit(1)).alias("readable_rows"))
    return CA.attempts(spark, root).select("window", "outcome", "fault", "station_rows", "model_rows").join(readable)


# --- gate -----------------------------------------------------------------------


@query("p_01_validate_envelopes")
def _(spark, d):
    return gated(spark, d).select("event_id", "claimed_type", "reason_code")


def _judged(event_type: str) -> Query:
    def run(spark, d):
        fields = [c for c, *_ in S.PAYLOAD_FIELDS[event_type] if c not in ("ts", "region", "city")]
        return gated(spark, d).where(F.col("claimed_type") == event_type).select(
            "event_id", "reason_code", "event.ts", *[F.col(f"event.{c}").alias(c) for c in fields]
        )

    return run


query("p_02_validate_weather")(_judged(S.WEATHER))
query("p_03_validate_satellite")(_judged(S.SATELLITE))
query("p_04_validate_station")(_judged(S.STATION))


@query("p_05_classify_reason")
def _(spark, d):
    ids = I.table(spark, d, "events").select("event_id")
    errors = [
        F.when(F.col("event_id") % n == 0, G.SEVERITY[code]).otherwise(0)
        for n, code in ((2, S.SCHEMA), (3, S.PARSE), (5, S.RANGE))
    ]
    return ids.select("event_id", G.classify_reason(*errors).alias("reason_code"))


@query("p_06_split_valid")
def _(spark, d):
    return gated(spark, d).agg(*G.gate_counts())


@query("p_07_parse_utc")
def _(spark, d):
    ev = I.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    form = F.col("event_id") % 8
    quoted = F.concat(F.lit('"'), iso, F.element_at(F.array(*[F.lit(x) for x in ("Z", "+00:00", "+02:00", "")]), (form + 1).cast("int")), F.lit('"'))
    text = (
        F.when(form < 4, quoted)
        .when(form == 4, F.unix_seconds("ts").cast("string"))
        .when(form == 5, F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"')))
        .when(form == 6, F.lit('"2024-13-45T00:00:00Z"'))
        .otherwise(F.lit("null"))
    )
    return G.parse_utc(ev.select("event_id", text.alias("text")), "text", CFG).drop("text")


@query("p_08_parse_provider_time")
def _(spark, d):
    ev = I.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    offset = F.when(F.col("event_id") % 6 == 0, 3600).when(F.col("event_id") % 7 == 0, None).otherwise(0)
    return ev.select("event_id", PG.parse_provider_time(text, offset).alias("instant"))


@query("p_09_region_is_configured")
def _(spark, d):
    ev = I.events(spark, d, keep=("event_id",))
    named = ev.withColumn("region", F.when(F.col("event_id") % 10 == 0, "ANT").otherwise(F.col("region")))
    return named.groupBy("region", G.region_is_configured(F.col("region"), CFG).alias("configured")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("p_10_station_hour_gate")
def _(spark, d):
    return I.gated_hours(spark, d).groupBy("location_id", "gate_reason").agg(F.count(F.lit(1)).alias("n"))


@query("p_11_sample_count_conflict")
def _(spark, d):
    rows = I.gated_hours(spark, d).withColumn("conflict", CP.sample_count_conflict())
    return rows.groupBy("city", "conflict").agg(F.count(F.lit(1)).alias("n"))


@query("p_12_construction")
def _(spark, d):
    kept = CP.retained_stations(I.gated_hours(spark, d))
    return kept.groupBy("city", "construction").agg(F.count(F.lit(1)).alias("n"))


@query("p_13_settled_only")
def _(spark, d):
    as_of = F.lit(I.utc(2024, 1, 20)) + F.expr("INTERVAL 50 MINUTES")
    kept = RC.settled_only(I.stations(spark, d), as_of, CFG)
    return kept.groupBy("city").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"))


@query("p_14_drop_future")
def _(spark, d):
    kept = PG.drop_future(I.satellites(spark, d), F.lit(I.utc(2024, 1, 20)))
    return kept.groupBy("city").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"))


@query("p_15_in_named_window")
def _(spark, d):
    kept = RC.in_named_window(I.satellites(spark, d), "second_half", CFG)
    return kept.groupBy("city").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("oldest"))


@query("p_16_stray_report")
def _(spark, d):
    both = I.stations(spark, d).select("ts").unionByName(I.satellites(spark, d).select("ts"))
    return RC.stray_report(both, CFG.window("first_half"))


@query("p_17_check_pm25_sensor")
def _(spark, d):
    return AD.check_pm25_sensor(I.sensors(spark, d), CFG).groupBy("parameter", "rejection").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("p_18_rejection_reason")
def _(spark, d):
    lost = _history(spark, d).missing
    return lost.groupBy("stream", "city", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("p_19_reason_ledger")
def _(spark, d):
    return G.reason_ledger(I.fetch_log(spark, d))


# --- joins ----------------------------------------------------------------------


@query("j_01_monthly_normal")
def _(spark, d):
    daily = I.daily_series(spark, d).withColumn("at", F.col("date").cast("timestamp"))
    out = IX.with_monthly_normal(daily, CFG, ts="at")
    return out.groupBy("region", "month", "normal_c").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("value") - F.col("normal_c")).alias("mean_anomaly")
    )


@query("j_02_vegetation_reference")
def _(spark, d):
    daily = I.daily_series(spark, d).withColumn("ts", F.col("date").cast("timestamp"))
    out = PG.with_vegetation_reference(daily, CFG)
    return out.groupBy("region", F.month("date").alias("month"), "vegetation_index").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("j_03_weather_air_join")
def _(spark, d):
    weather, air = I.history_pages(spark, d)
    joined = PG.weather_air_join(
        PG.explode_hourly(weather, PG.WEATHER_VARIABLES), PG.explode_hourly(air, PG.AIR_VARIABLES)
    )
    return joined.groupBy("city").agg(
        F.count(F.lit(1)).alias("slots"), F.count("pm2_5").alias("matched"), F.avg("pm2_5").alias("mean_pm25")
    )


@query("j_04_event_to_record")
def _(spark, d):
    # Free spans: overlapping twelve-hour spans, one from each record's start.
    spans = records(spark, d).select(
        "region", "window_start", (F.col("window_start") + F.expr("INTERVAL 12 HOURS")).alias("window_end")
    )
    ev = I.events(spark, d).select("region", "ts", "event_type")
    return RC.events_in_spans(ev, spans, unit_minutes=360).groupBy("region", "window_start").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == S.STATION).alias("stations")
    )


@query("j_05_city_windows")
def _(spark, d):
    return city_windows(spark, d)


@query("j_06_attach_reconciliation")
def _(spark, d):
    # A record set with gaps, so that some city-windows have no record.
    some = IX.compute_records(I.events(spark, d).where(F.col("event_type") == S.WEATHER), HOURLY)
    cw = RC.city_windows(I.stations(spark, d), I.satellites(spark, d), HOURLY)
    out = RC.attach_reconciliation(some, RC.rollup_region(cw))
    return out.withColumn("cities", F.size("city_comparisons")).drop("city_comparisons")


@query("j_07_resolve_sensors")
def _(spark, d):
    return resolved(spark, d).select(
        "location_id", "city", "kind", "pm25_sensor_id", "candidates", "covering", "identity_fault"
    )


@query("j_08_stations_in_radius")
def _(spark, d):
    return in_radius(spark, d).select(
        "location_id", "city", "radius_m", F.round("distance_m", 3).alias("distance_m")
    )


@query("j_09_cities_without_rows")
def _(spark, d):
    # Sensors that report as stations; AFR has none.
    reporting = I.stations(spark, d).select("station_id").distinct()
    hours = I.landed_hours(spark, d).join(reporting, "station_id", "left_semi")
    return CP.cities_without_rows(I.candidate_locations(spark, d), hours)


@query("j_10_instrument_drift")
def _(spark, d):
    # Landed: either half is asked for twice, and each would make and read every page again.
    hours = land(CP.retained_stations(I.gated_hours(spark, d)).select("station_id", "ts"), "retained")
    first, second = RC.in_named_window(hours, "first_half", CFG), RC.in_named_window(hours, "second_half", CFG)
    return CP.instrument_drift(first, second, key="station_id")


@query("j_11_revision_check")
def _(spark, d):
    hourly = I.hourly_values(spark, d).withColumnRenamed("mv", "value")
    later = hourly.withColumn("value", F.when(F.col("hn") % 9 == 0, F.col("value") + 1.0).otherwise(F.col("value")))
    out = CP.revision_check(hourly, later, ["region", "city", "hour"], "value")
    return out.groupBy("city", "revised").agg(F.count(F.lit(1)).alias("n"))


# --- index ----------------------------------------------------------------------


@query("a_01_compute_records")
def _(spark, d):
    return without_detail(records(spark, d))


def _component(*columns: str) -> Query:
    return lambda spark, d: scored(spark, d).select("region", "window_start", *columns)


query("a_02_temperature_anomaly")(_component("mean_temperature_c", "normal_c", "temperature_anomaly"))
query("a_03_dryness_index")(_component("mean_rainfall_mm", "mean_vegetation", "dryness_index"))
query("a_04_pollution_index")(_component("mean_aerosol", "mean_cloud_pct", "pollution_index"))
query("a_05_impact_index")(_component("impact_index"))
query("a_06_window_model_pm25")(_component("model_pm25_ugm3"))


@query("a_07_grade_confidence")
def _(spark, d):
    return scored(spark, d, HOURLY).select(
        "region", "window_start", "n_weather", "n_satellite", "confidence"
    )


@query("a_08_city_station_values")
def _(spark, d):
    return RC.city_station_values(I.stations(spark, d), CFG, distinct=True)


@query("a_09_compare_city")
def _(spark, d):
    return city_windows(spark, d).groupBy("region", "city", "state").agg(
        F.count(F.lit(1)).alias("n"), F.avg("tolerance").alias("mean_tolerance")
    )


@query("a_10_rollup_region")
def _(spark, d):
    rolled = RC.rollup_region(city_windows(spark, d))
    detail = F.array_join(
        F.transform("city_comparisons", lambda c: F.concat_ws(":", c["city"], c["state"], c["station_count"])), ";"
    )
    return rolled.withColumn("detail", detail).drop("city_comparisons")


@query("a_11_reconcile")
def _(spark, d):
    out = RC.reconcile(
        records(spark, d), I.stations(spark, d), I.satellites(spark, d), CFG, window=CFG.window("month")
    )
    return out.withColumn("cities", F.size("city_comparisons")).drop("city_comparisons")


# --- reports --------------------------------------------------------------------


@query("a_12_run_summary")
def _(spark, d):
    return R.run_summary(reconciled(spark, d))


@query("a_13_per_city_breakdown")
def _(spark, d):
    return R.per_city_breakdown(compared(spark, d))


@query("a_14_rates_by_domain")
def _(spark, d):
    cw = compared(spark, d).join(I.city_domains(spark).select("city", "domain"), "city", "left")
    return R.rates_by(cw, "domain", ("europe", "global"))


@query("a_14_rates_by_construction")
def _(spark, d):
    kinds = R.construction_of_windows(I.stations(spark, d), CFG)
    cw = compared(spark, d).join(kinds, S.CITY_KEY, "left")
    return R.rates_by(cw, "construction", (*S.CONSTRUCTIONS, "MIXED"))


@query("a_14_rates_by_region")
def _(spark, d):
    return R.rates_by(compared(spark, d), "region", CFG.regions)


@query("a_15_weaker_condition")
def _(spark, d):
    return R.weaker_condition(compared(spark, d), CFG)


@query("a_16_covered_cross_check")
def _(spark, d):
    return R.covered_cross_check(reconciled(spark, d))


@query("a_17_gate_tally")
def _(spark, d):
    return CP.gate_tally(I.gated_hours(spark, d))


@query("a_18_breakdown_checks")
def _(spark, d):
    hours = I.landed_hours(spark, d)
    return CP.breakdown_checks(hours, CP.retained_stations(hours), resolved(spark, d))


@query("a_19_observed_bounds")
def _(spark, d):
    return CP.observed_bounds(I.stations(spark, d), I.satellites(spark, d))


@query("a_20_rows_per_city")
def _(spark, d):
    return CP.rows_per_city(I.stations(spark, d), I.satellites(spark, d))


@query("a_21_off_hour_breakdown")
def _(spark, d):
    return CP.off_hour_breakdown(I.gated_hours(spark, d))


@query("a_22_resolution_summary")
def _(spark, d):
    return CP.resolution_summary(resolved(spark, d))


@query("a_23_negative_profile")
def _(spark, d):
    return R.negative_profile(I.stations(spark, d))


@query("a_24_bias_table")
def _(spark, d):
    return R.bias_table(landed_comparison(spark, d))


@query("a_25_difference_quartiles")
def _(spark, d):
    return R.difference_quartiles(landed_comparison(spark, d))


@query("a_26_zero_model_passes")
def _(spark, d):
    return R.zero_model_passes(R.bias_table(landed_comparison(spark, d)), CFG)


@query("a_27_verdicts")
def _(spark, d):
    return R.verdicts(compared(spark, d), CFG)


@query("a_28_run_counts")
def _(spark, d):
    # Landed, so that messages are made and judged once for both sides.
    g = land(gated(spark, d).select("reason_code", "event"), "gated")
    return R.run_counts(g, IX.compute_records(G.valid_events(g), CFG))


@query("a_29_call_status_summary")
def _(spark, d):
    return CP.call_status_summary(I.calls(spark, d))


@query("a_29_calls_by_status")
def _(spark, d):
    return CP.calls_by_status(I.calls(spark, d))


@query("a_30_admission_funnel")
def _(spark, d):
    return AD.admission_funnel(in_radius(spark, d), I.sensors(spark, d), I.SENSOR_WINDOW, CFG)


@query("a_30_admitted_locations")
def _(spark, d):
    return AD.admitted_locations(in_radius(spark, d), I.sensors(spark, d), I.SENSOR_WINDOW, CFG)


@query("a_31_monthly_normals")
def _(spark, d):
    return R.monthly_normals(I.daily_series(spark, d))


@query("a_32_station_population")
def _(spark, d):
    hours = I.landed_hours(spark, d)
    return CP.station_population(CP.retained_stations(hours), CP.off_hour_rows(hours))


@query("a_33_qualifying_city_hours")
def _(spark, d):
    return CP.qualifying_city_hours(I.stations(spark, d), CFG)


@query("a_34_uniqueness_report")
def _(spark, d):
    return CP.uniqueness_report(I.stations(spark, d), ["station_id", "ts"])


@query("a_35_station_medians")
def _(spark, d):
    return R.station_medians(I.stations(spark, d))


@query("a_36_value_probe")
def _(spark, d):
    hours = I.hourly_values(spark, d)
    values = hours.withColumn("v", F.when(F.col("hn") % 13 != 0, F.col("mv") - 5.0))
    return R.value_probe(values, "v")


@query("a_37_nearest_rank")
def _(spark, d):
    return R.nearest_rank(I.stations(spark, d), ["region", "city"], "pm25_ugm3", 0.95, "p95")


@query("a_38_freshness_lag")
def _(spark, d):
    """Of a record table written in two batches. A lag differs between runs, so what is shown is the write less the lag
    (the median end of a batch's windows), and whether each batch was written after the one before and in this run."""
    path, before = scratch_path(spark, "written"), datetime.now(timezone.utc)
    early, made = F.col("window_start") < F.lit(I.FIRST_HALF.end), records(spark, d)
    for batch, part in enumerate((made.where(early), made.where(~early))):
        TB.upsert_records(part, path, batch)
    table = TB.current_records(TB.read_record_table(spark, path, written_at=True))
    writes = table.groupBy("batch_id").agg(F.max("written_at").alias("at"), F.min("written_at").alias("first"))
    earlier = F.coalesce(F.lag("at").over(Window.orderBy("batch_id")), F.lit(before))
    real = (F.col("first") > earlier) & (F.col("at") <= F.current_timestamp())
    return R.freshness_lag(table, keys=["batch_id"]).join(writes.withColumn("real", real), "batch_id").select(
        "batch_id", "n", F.round(F.unix_micros("at") / 1e6 - F.col("median_lag_s"), 1).alias("median_window_end_s"),
        F.col("real").alias("written_in_order"),
    )


@query("a_39_component_profile")
def _(spark, d):
    return R.component_profile(scored(spark, d), CFG)


@query("a_40_coverage_vs_ceiling")
def _(spark, d):
    admitted = I.hour_locations(spark, d)
    return R.coverage_vs_ceiling(admitted, I.stations(spark, d), CFG.window("month"), CFG)


@query("a_41_coverage_margin")
def _(spark, d):
    return R.coverage_margin(compared(spark, d), CFG)


@query("a_41_windows_lost_without")
def _(spark, d):
    return R.windows_lost_without(I.stations(spark, d), compared(spark, d), CFG)


@query("a_42_admission_shortfall")
def _(spark, d):
    return AD.admission_shortfall(in_radius(spark, d), I.sensors(spark, d), I.SENSOR_WINDOW, CFG)


@query("a_43_mapping_is_one_to_one")
def _(spark, d):
    return AD.mapping_is_one_to_one(resolved(spark, d))


@query("a_44_cluster_count")
def _(spark, d):
    return R.cluster_count(compared(spark, d))


# --- latest, first, sorts and sets ----------------------------------------------


@query("w_01_latest_per_region")
def _(spark, d):
    return R.latest_per_region(records(spark, d), CFG)


@query("w_02_first_admitted_value")
def _(spark, d):
    obs = I.table(spark, d, "events").select(
        "user_id", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day"), "event_id", "value"
    )
    return R.first_admitted_value(obs, ["user_id", "day"], "value", ["event_id"])


@query("w_03_inheritance_witness")
def _(spark, d):
    return R.inheritance_witness(reconciled(spark, d))


@query("l_01_ordered_records")
def _(spark, d):
    return without_detail(records(spark, d)).orderBy("region", "window_start")


@query("l_02_worst_duplicates")
def _(spark, d):
    return CP.worst_duplicates(I.stations(spark, d), ["station_id", "ts"])


@query("l_03_earliest_stray")
def _(spark, d):
    return RC.stray_report(I.satellites(spark, d), CFG.window("second_half")).select("first_stray")


@query("l_04_newest_version")
def _(spark, d):
    versions = I.table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("version"))
    return versions.agg(F.max("version").alias("version"))


@query("l_05_cities_in_order")
def _(spark, d):
    rolled = RC.rollup_region(city_windows(spark, d))
    return rolled.select(
        "region", "window_start", F.array_join(F.col("city_comparisons.city"), ",").alias("cities")
    )


@query("u_01_union_streams")
def _(spark, d):
    ev = I.events(spark, d)
    parts = [ev.where(F.col("event_type") == t) for t in S.EVENT_TYPES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("event_type", "region").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("u_02_union_of_cities")
def _(spark, d):
    st, mo = I.stations(spark, d), I.satellites(spark, d)
    return st.select("region", "city").union(mo.select("region", "city")).distinct()


@query("u_03_sensor_difference")
def _(spark, d):
    first, second = split_captures(spark, d)
    return CP.instrument_drift(first, second, key="station_id")


@query("u_04_cities_left_over")
def _(spark, d):
    admitted = I.hour_locations(spark, d).select("city").distinct()
    return admitted.join(I.stations(spark, d).select("city").distinct(), "city", "left_anti")


# --- scalar functions -----------------------------------------------------------


def _events_with(**columns) -> Query:
    def run(spark, d):
        ev = I.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
        return ev.select("event_id", *[make().alias(name) for name, make in columns.items()])

    return run


query("x_01_clamp")(_events_with(clamped=lambda: X.clamp(F.when(F.col("event_id") % 9 != 0, F.col("value")), 10.0, 50.0)))
query("x_02_verbal_label")(_events_with(label=lambda: X.verbal_label(F.when(F.col("event_id") % 9 != 0, F.col("value")), CFG)))
query("x_03_mqo_tolerance")(_events_with(tolerance=lambda: X.mqo_tolerance(F.col("value") - 50.0, CFG)))
query("x_04_window_bounds")(
    _events_with(
        start_30=lambda: X.window_bounds(F.col("ts"), 30)[0],
        end_30=lambda: X.window_bounds(F.col("ts"), 30)[1],
    )
)
query("x_05_half_diagonal")(
    _events_with(half_diagonal_m=lambda: F.round(X.half_diagonal_m(F.lit(0.4), F.col("value") / 10.0, CFG), 6))
)
query("x_06_station_radius")(
    _events_with(
        radius_m=lambda: X.station_radius_m(F.lit(0.4), F.col("value") / 6.0, CFG),
        capped=lambda: X.radius_is_capped(F.lit(0.4), F.col("value") / 6.0, CFG),
    )
)
query("x_07_canonical_key")(_events_with(key=lambda: X.canonical_key(F.col("ts"))))
query("x_08_axis_label")(
    _events_with(
        label=lambda: X.axis_label(F.col("ts")), line=lambda: X.freshness_line(F.col("ts"), 30)
    )
)
query("x_09_absent_marker")(
    _events_with(shown=lambda: X.absent_marker(F.when(F.col("event_id") % 4 != 0, F.floor("value").cast("double"))))
)


@query("x_10_record_json")
def _(spark, d):
    rows = records(spark, d).select(
        "region", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("start"), "confidence"
    )
    return rows.select("region", "start", X.record_json("start", "region", "confidence").alias("json"))


# --- streaming ------------------------------------------------------------------


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = I.table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


@query("t_01_stream_windows")
def _(spark, d):
    path = scratch_path(spark, "windows")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(path)

    counts = flows.windowed_stream(I.to_events(_event_stream(spark, d)), CFG)
    writer = counts.writeStream.outputMode("update").foreachBatch(write)
    flows.start(writer, scratch_path(spark, "ck")).awaitTermination()
    latest = TB.current_records(spark.read.parquet(path))
    return latest.select("region", "window_start", "window_end", "n_weather", "n_satellite")


PER_PART = 4


def _in_span(low, high) -> Column:
    """Rows of a span; the month's first is open below, its last open above and with rows that have no time."""
    ts, last = F.col("ts"), high >= I.WHOLE_MONTH.end
    after = F.lit(True) if low <= I.WHOLE_MONTH.start else ts >= F.lit(low)
    inside = after & (F.lit(True) if last else ts < F.lit(high))
    return F.when(ts.isNull(), F.lit(last)).otherwise(inside)


def _timed_messages(spark: SparkSession, d: str, parts) -> tuple[str, int]:
    """A folder of message files, faults included, span of time by span of time, and the number of files of each.

    The order matters: were a later span read first, the watermark would make the others late. For the same reason a
    span is read in one batch. So all have the same number of files: as many as the table has partitions, as there are
    cores and PER_PART at least, and empty ones where a span has too few rows.
    """
    path = scratch_path(spark, "messages")
    files = max(PER_PART, spark.sparkContext.defaultParallelism, I.table(spark, d, "events").rdd.getNumPartitions())
    _add_messages(spark, d, parts, (path, files))
    return path, files


def _add_messages(spark: SparkSession, d: str, parts, source: tuple[str, int]) -> None:
    """The files of further spans. Rows are dealt before they become messages, which is the work, and wide."""
    path, files = source
    rows = I.table(spark, d, "events")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for low, high in parts:
        before = len(spark.read.text(path).inputFiles()) if fs.exists(folder) else 0
        part = rows.where(_in_span(low, high)).repartition(files)
        I.messages_of(part).select("value").write.mode("append").text(path)
        for k in range(len(spark.read.text(path).inputFiles()), before + files):
            fs.create(spark._jvm.org.apache.hadoop.fs.Path(folder, f"part-none-{k}.txt")).close()


def _read_messages(spark: SparkSession, source: tuple[str, int]) -> DataFrame:
    path, files = source
    return EV.read_envelopes(spark, path, streaming=True, options={"maxFilesPerTrigger": str(files)})


def _listened(spark: SparkSession, run) -> DataFrame:
    """The metrics table of the queries that ``run`` starts and waits for."""
    path = scratch_path(spark, "metrics")
    listener = MetricsListener(spark, path)
    spark.streams.addListener(listener)
    try:
        for q in run():
            listener.wait(q)
    finally:
        spark.streams.removeListener(listener)
    return spark.read.schema(METRICS_SCHEMA).parquet(path)


def _ended(q):
    q.awaitTermination()
    return q


@query("t_02_stream_index")
def _(spark, d):
    path = scratch_path(spark, "index")
    stream = _read_messages(spark, _timed_messages(spark, d, I.QUARTERS))
    _ended(flows.stream_index(stream, CFG, path, scratch_path(spark, "ck")))
    return without_detail(TB.current_records(TB.read_record_table(spark, path))).drop(*TB.VERSION)


@query("t_03_commit_after_write")
def _(spark, d):
    """The first attempt dies after its write; the restart replays the batch."""
    path, ck = scratch_path(spark, "crash"), scratch_path(spark, "ck")
    source = _timed_messages(spark, d, I.QUARTERS)
    state = {"fail": True}

    def sink(df: DataFrame, batch_id: int) -> None:
        TB.upsert_records(df, path, batch_id)
        if state.pop("fail", False):
            raise RuntimeError("lost after the write, before the commit")

    try:
        _ended(flows.stream_index(_read_messages(spark, source), CFG, sink, ck))
    except StreamingQueryException as planted:
        if "lost after the write" not in str(planted):
            raise
    _ended(flows.stream_index(_read_messages(spark, source), CFG, sink, ck))
    return without_detail(TB.current_records(TB.read_record_table(spark, path))).drop(*TB.VERSION)


@query("t_04_late_rows")
def _(spark, d):
    """The second half of the month comes first, in two batches, so that all of the first half is late: dropped by the
    query with state, kept in the late table by the other. A row is late or counted, and nothing else."""
    parts = [*I.QUARTERS[2:], (I.FIRST_HALF.start, I.FIRST_HALF.end)]
    source, raw, late, kept = _timed_messages(spark, d, parts), *(scratch_path(spark, n) for n in ("raw", "late", "kept"))

    def run():
        yield _ended(flows.stream_index(
            _read_messages(spark, source), CFG, scratch_path(spark, "index"), scratch_path(spark, "ck")
        ))

    dropped = _listened(spark, run).agg((F.sum("late_rows") > 0).alias("some_dropped"))
    _ended(flows.stream_ingest(
        _read_messages(spark, source), CFG, raw, scratch_path(spark, "bad"), scratch_path(spark, "records"),
        scratch_path(spark, "ck"), partials=kept, late_path=late,
    ))
    n = F.count(F.lit(1))
    accepted = TB.read_raw(spark, raw).groupBy("event_type").agg(n.alias("accepted_rows"))
    lost = TB.read_raw(spark, late).groupBy("event_type").agg(n.alias("late_rows"))
    both = accepted.join(lost, "event_type", "left").join(counted_rows(spark, kept), "event_type", "left")
    return both.fillna(0, ["late_rows", "counted_rows"]).join(dropped)


def _raw_and_quarantine(spark: SparkSession, d: str) -> tuple[str, str]:
    raw, bad = scratch_path(spark, "raw"), scratch_path(spark, "bad")
    stream = _read_messages(spark, _timed_messages(spark, d, I.QUARTERS))
    _ended(flows.stream_raw(stream, CFG, raw, bad, scratch_path(spark, "ck")))
    return raw, bad


@query("t_05_drain_once")
def _(spark, d):
    raw, _bad = _raw_and_quarantine(spark, d)
    return TB.read_raw(spark, raw).groupBy("event_type", "region").agg(F.count(F.lit(1)).alias("n"))


@query("t_06_replay")
def _(spark, d):
    """A first run over half the messages; a second, with a new checkpoint, over all of them."""
    raw, index = scratch_path(spark, "raw"), scratch_path(spark, "index")
    source = _timed_messages(spark, d, I.QUARTERS[:2])
    for further in ((), I.QUARTERS[2:]):
        _add_messages(spark, d, further, source)
        _ended(flows.stream_raw(_read_messages(spark, source), CFG, raw, scratch_path(spark, "bad"), scratch_path(spark, "ck")))
        _ended(flows.stream_index(_read_messages(spark, source), CFG, index, scratch_path(spark, "ck")))
    kept = TB.read_raw(spark, raw).groupBy("region").agg(F.count(F.lit(1)).alias("raw_rows"))
    now = TB.current_records(TB.read_record_table(spark, index)).groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.avg("impact_index").alias("mean_index")
    )
    return kept.join(now, "region")


@query("t_07_stream_reconcile")
def _(spark, d):
    raw, index, sink = (scratch_path(spark, n) for n in ("raw", "index", "reconciled"))
    TB.write_raw_batch(I.events(spark, d), raw, 0)
    TB.upsert_records(records(spark, d), index, 0)
    stream = spark.readStream.schema(TB.RAW_SCHEMA).parquet(raw)
    _ended(flows.stream_reconcile(stream, CFG, sink, scratch_path(spark, "ck"), index_path=index))
    out = TB.current_records(TB.read_record_table(spark, sink)).drop(*TB.VERSION)
    return out.withColumn("cities", F.size("city_comparisons")).drop("city_comparisons")


@query("t_07_stream_ingest")
def _(spark, d):
    """Raw rows, quarantine and reconciled records of each batch under one commit."""
    raw, bad, sink = (scratch_path(spark, n) for n in ("raw", "bad", "records"))
    stream = _read_messages(spark, _timed_messages(spark, d, I.QUARTERS))
    _ended(flows.stream_ingest(stream, CFG, raw, bad, sink, scratch_path(spark, "ck")))
    out = TB.current_records(TB.read_record_table(spark, sink)).drop(*TB.VERSION)
    return out.withColumn("cities", F.size("city_comparisons")).drop("city_comparisons")


@query("t_08_quarantine_side_output")
def _(spark, d):
    _raw, bad = _raw_and_quarantine(spark, d)
    return spark.read.parquet(bad).groupBy("event_type", "reason_code").agg(F.count(F.lit(1)).alias("n"))


@query("t_09_run_telemetry")
def _(spark, d):
    def run():
        stream = _read_messages(spark, _timed_messages(spark, d, I.QUARTERS))
        yield _ended(flows.stream_index(stream, CFG, scratch_path(spark, "index"), scratch_path(spark, "ck")))

    return _listened(spark, run).groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.count_if(F.col("input_rows") > 0).alias("batches"),
    )


# --- guards ---------------------------------------------------------------------


@query("g_01_tier_is_earned")
def _(spark, d):
    return GD.verdict(GD.tier_is_earned(reconciled(spark, d)), "tier_is_earned")


@query("g_02_reported_never_resolved")
def _(spark, d):
    judged = GD.reported_never_resolved(
        RC.explode_comparisons(reconciled(spark, d)), I.stations(spark, d), I.satellites(spark, d), CFG
    )
    return GD.verdict(judged, "reported_never_resolved")


@query("g_03_stations_do_not_move_the_index")
def _(spark, d):
    return GD.verdict(GD.stations_do_not_move_the_index(I.events(spark, d), CFG), "stations_do_not_move_the_index")


@query("g_04_reconciling_keeps_the_index")
def _(spark, d):
    return GD.verdict(
        GD.reconciling_keeps_the_index(records(spark, d), reconciled(spark, d)), "reconciling_keeps_the_index"
    )


@query("g_05_empty_is_no_pass")
def _(spark, d):
    nothing = GD.tier_is_earned(reconciled(spark, d)).where(F.col("window_start") > F.lit(I.utc(2030, 1, 1)))
    return GD.verdict(nothing, "empty_is_no_pass")


@query("g_06_funnel_is_monotone")
def _(spark, d):
    funnel = AD.admission_funnel(in_radius(spark, d), I.sensors(spark, d), I.SENSOR_WINDOW, CFG)
    return GD.verdict(GD.funnel_is_monotone(funnel), "funnel_is_monotone")
