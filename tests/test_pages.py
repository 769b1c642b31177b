from datetime import timedelta

import json

import pytest
from pyspark.sql import functions as F

from envgrade.config import ConfigError, Settings, Stretch
from envgrade.operators.capture import CaptureFault
from envgrade.operators.reconcile import settled_only
from envgrade.sources import envelopes as EV
from envgrade.sources import pages as PG
from tests.helpers import at, frame, satellite, station

CFG = Settings()
PAGE = "region string, city string, body string"


def _page(block, offset=0, name="hourly"):
    return json.dumps({"utc_offset_seconds": offset, name: block})


def test_model_hours_keep_the_half_open_window(spark):
    block = {"time": ["2026-07-17T00:00", "2026-07-17T01:00", "2026-07-17T02:00", "2026-07-17T03:00"], "pm2_5": [1.0, None, 3.0]}
    pages = spark.createDataFrame([("EUR", "Berlin", _page(block))], PAGE)
    span = Stretch(at("2026-07-17T00:00:00"), timedelta(hours=2))
    rows = PG.explode_model_hours(pages, span).collect()
    assert [(r.ts.hour, r.model_pm25_ugm3) for r in rows] == [(0, 1.0)]


def test_history_aligns_by_time_and_counts_gaps(spark):
    hours = [f"2026-07-17T{h:02d}:00" for h in range(6)]
    weather = {
        "time": hours, "temperature_2m": [1.0, None, 3.0, 4.0, 5.0, 6.0], "precipitation": [0.0] * 6,
        "wind_speed_10m": [1.0, 1.0, 1.0, -1.0, 1.0, 1.0], "cloud_cover": [10.0] * 6,
    }
    air = {"time": hours[:1] + hours[3:], "aerosol_optical_depth": [0.1, 0.4, 0.5, 0.6], "pm2_5": [7.0, 8.0, None, 9.0]}
    w = spark.createDataFrame([("EUR", "Berlin", _page(weather)), ("ASI", "Tokyo", _page(weather, 3600))], PAGE)
    a = spark.createDataFrame([("EUR", "Berlin", _page(air))], PAGE)
    out = PG.explode_weather_air_history(w, a, F.lit(at("2026-07-17T04:00:00")), CFG)
    assert sorted(r.temperature_c for r in out.weather.collect()) == [1.0, 3.0, 5.0]
    sat = {r.ts.hour: r for r in out.satellite.collect()}
    assert {h: r.model_pm25_ugm3 for h, r in sat.items()} == {0: 7.0, 3: 8.0}
    assert sat[0].vegetation_index == 0.58
    missing = sorted((r.stream, r.slot[-5:], r.reason) for r in out.missing.collect())
    assert missing == [
        ("satellite", "02:00", "missing_field"), ("satellite", "04:00", "missing_field"),
        ("weather", "01:00", "missing_field"), ("weather", "03:00", "out_of_range"),
    ]


def test_repeated_slot_takes_the_later_value(spark):
    hours = ["2026-07-17T00:00", "2026-07-17T00:00"]
    air = PG.explode_hourly(
        spark.createDataFrame([("EUR", "Berlin", _page({"time": hours, "aerosol_optical_depth": [1.0, 2.0], "pm2_5": [1.0, 2.0]}))], PAGE),
        PG.AIR_VARIABLES,
    )
    weather = spark.createDataFrame([("EUR", "Berlin", hours[0])], "region string, city string, time string")
    assert PG.weather_air_join(weather, air).first().pm2_5 == 2.0


def test_current_readings(spark):
    full = {"time": "2026-07-17T10:15", "temperature_2m": 20.0, "precipitation": 0.0, "wind_speed_10m": 2.0, "cloud_cover": 40.0}
    clear = {**full, "cloud_cover": None}
    air = {"time": "2026-07-17T10:00", "aerosol_optical_depth": 0.2, "pm2_5": 6.0}
    w = spark.createDataFrame(
        [("EUR", "Berlin", _page(full, name="current")), ("EUR", "Madrid", _page(clear, name="current")),
         ("ASI", "Tokyo", _page(full, 32400, "current"))], PAGE)
    a = spark.createDataFrame([(r, c, _page(air, name="current")) for r, c in (("EUR", "Berlin"), ("EUR", "Madrid"), ("ASI", "Delhi"))], PAGE)
    out = PG.flatten_current_readings(w, a, CFG)
    assert sorted(r.city for r in out.weather.collect()) == ["Berlin", "Madrid"]  # cloud is not a weather value
    row = out.satellite.first()
    assert (out.satellite.count(), row.city, row.ts.minute, row.cloud_cover_pct) == (1, "Berlin", 0, 40.0)
    reasons = {(r.stream, r.city): r.reason for r in out.missing.collect()}
    assert reasons["satellite", "Madrid"] == "missing_field"
    assert reasons["weather", "Tokyo"] == "offset_or_time"
    assert reasons["weather", "Delhi"] == "missing_field"


def test_capture_round_trip_and_empty_side(spark, tmp_path):
    events = frame(spark, [station("2026-07-17T10:00:00", "EUR", "Berlin", "s1", -1.5), satellite("2026-07-17T10:00:00.000001", "EUR", "Berlin")])
    st = events.where("event_type = 'station'").select("ts", "region", "city", "station_id", "pm25_ugm3", "sample_count", "construction")
    mo = events.where("event_type = 'satellite'").select(
        "ts", "region", "city", "cloud_cover_pct", "vegetation_index", "aerosol_index", "model_pm25_ugm3")
    PG.write_capture(st, mo, str(tmp_path), "control")
    a, b = PG.read_capture(spark, str(tmp_path), "control", CFG)
    assert a.exceptAll(st).count() == 0 and b.exceptAll(mo).count() == 0 and b.count() == 1
    PG.write_capture(st.limit(0), mo, str(tmp_path / "x"), "control")
    with pytest.raises(CaptureFault, match="station side"):
        PG.read_capture(spark, str(tmp_path / "x"), "control", CFG)
    with pytest.raises(ConfigError):
        PG.read_capture(spark, str(tmp_path), "some_week", CFG)


def test_admission_versions(spark, tmp_path):
    for day, ids in (("2026-08-01", [1]), ("2026-08-03", [2, 3])):
        doc = {"derived_at": f"{day}T09:00:00Z", "cities": {"Berlin": {"region": "EUR", "domain": "europe", "sensor_location_ids": ids}}}
        (tmp_path / f"{day}.json").write_text(json.dumps(doc, indent=2))
    newest = PG.read_admission(spark, str(tmp_path))
    assert sorted(r.station_id for r in newest.collect()) == ["2", "3"]
    assert PG.read_admission(spark, str(tmp_path), "2026-08-01").first().location_id == 1
    with pytest.raises(CaptureFault):
        PG.read_admission(spark, str(tmp_path), "2020-01-01")


def test_union_records_a_failed_source(spark):
    events = frame(spark, [station("2026-07-17T10:00:00", "EUR", "Berlin", "s1", 1.0)])
    out, failed = EV.union_sources({"good": events, "gone": lambda: spark.read.parquet("/no/such/place"), "empty": events.limit(0)})
    assert [r.source for r in out.collect()] == ["good"] and list(failed) == ["gone"]


def test_settled_hours(spark):
    df = spark.createDataFrame([(at("2026-07-17T10:00:00"),), (at("2026-07-17T11:00:00"),)], "ts timestamp")
    assert settled_only(df, F.lit(at("2026-07-19T10:59:00")), CFG).count() == 1
