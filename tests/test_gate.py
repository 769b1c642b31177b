import json

import pytest
from pyspark.sql import functions as F

from envgrade.config import Settings
from envgrade.operators import gate as G
from envgrade.sources.envelopes import wrap_envelopes
from tests.helpers import frame, satellite, station, weather

CFG = Settings()
W = {"ts": "2026-07-19T12:00:00Z", "region": "EUR", "temperature_c": 20.0, "rainfall_mm": 0.0, "wind_speed_ms": 1.0}
SAT = {
    "ts": "2026-07-19T12:00:00Z", "region": "EUR", "city": "Berlin", "cloud_cover_pct": 50,
    "vegetation_index": 0.1, "aerosol_index": 1.0, "model_pm25_ugm3": 9.5,
}
ST = {
    "ts": "2026-07-19T12:00:00+00:00", "region": "EUR", "city": "Berlin", "station_id": "s1",
    "pm25_ugm3": -2.0, "sample_count": 4, "construction": "COMPUTED_MEAN",
}


def env(kind, payload, key="EUR", **extra):
    return json.dumps({"event_type": kind, "key": key, "payload": payload, **extra})


def w(**change):
    return env("weather", {**W, **change})


def st(**change):
    return env("station", {**ST, **change})


def drop(payload, name):
    return {k: v for k, v in payload.items() if k != name}


# name: (message, reason or None, claimed type)
CASES = {
    "weather": (env("weather", W), None, "weather"),
    "satellite": (env("satellite", SAT), None, "satellite"),
    "station": (env("station", ST), None, "station"),
    "negative_pm25_is_kept": (st(pm25_ugm3=-998.0), None, "station"),
    "truncated": ('{"event_type": "weath', "parse", "unknown"),
    "empty_text": ("", "parse", "unknown"),
    "array": ("[1, 2]", "parse", "unknown"),
    "scalar": ("3", "parse", "unknown"),
    "empty_object": ("{}", "schema", "unknown"),
    "unknown_type": (env("radar", W), "schema", "radar"),
    "null_type": (env(None, W), "schema", "None"),
    "unknown_key": (env("weather", W, key="ANT"), "schema", "weather"),
    "numeric_key": (env("weather", W, key=3), "schema", "weather"),
    "extra_envelope_field": (env("weather", W, trace=1), "schema", "weather"),
    "payload_list": (env("weather", [1]), "parse", "weather"),
    "payload_null": (env("weather", None), "parse", "weather"),
    "payload_list_and_unknown_key": (env("weather", [1], key="ANT"), "parse", "weather"),
    "payload_missing": (json.dumps({"event_type": "weather", "key": "EUR"}), "schema", "weather"),
    "missing_field": (env("weather", drop(W, "rainfall_mm")), "schema", "weather"),
    "extra_field": (w(note="x"), "schema", "weather"),
    "payload_region_unknown": (w(region="ANT"), "schema", "weather"),
    "key_differs_from_region": (env("weather", W, key="NAM"), None, "weather"),
    "float_text": (w(temperature_c="12.5"), None, "weather"),
    "float_spaced_text": (w(temperature_c=" 3 "), None, "weather"),
    "float_exponent_text": (w(temperature_c="1e1"), None, "weather"),
    "float_java_suffix": (w(temperature_c="1.0d"), "parse", "weather"),
    "float_boolean": (w(temperature_c=True), None, "weather"),
    "float_empty": (w(temperature_c=""), "parse", "weather"),
    "float_word": (w(temperature_c="abc"), "parse", "weather"),
    "float_null": (w(temperature_c=None), "schema", "weather"),
    "float_list": (w(temperature_c=[1]), "schema", "weather"),
    "nan_text_unbounded": (w(temperature_c="nan"), None, "weather"),
    "nan_text_bounded": (w(rainfall_mm="NaN"), "range", "weather"),
    "minus_inf_bounded": (w(rainfall_mm="-inf"), "range", "weather"),
    "nan_token": (env("weather", W).replace("20.0", "NaN"), "parse", "unknown"),
    "below_bound": (w(rainfall_mm=-0.1), "range", "weather"),
    "at_bound": (w(rainfall_mm=0), None, "weather"),
    "cloud_above": (env("satellite", {**SAT, "cloud_cover_pct": 100.5}), "range", "satellite"),
    "cloud_at_top": (env("satellite", {**SAT, "cloud_cover_pct": 100}), None, "satellite"),
    "vegetation_below": (env("satellite", {**SAT, "vegetation_index": -1.01}), "range", "satellite"),
    "aerosol_is_unbounded": (env("satellite", {**SAT, "aerosol_index": -5}), None, "satellite"),
    "city_number": (env("satellite", {**SAT, "city": 5}), "schema", "satellite"),
    "range_beats_parse": (w(rainfall_mm=-1, temperature_c="abc"), "range", "weather"),
    "parse_beats_schema": (env("weather", {**drop(W, "wind_speed_ms"), "temperature_c": "abc"}), "parse", "weather"),
    "int_fraction": (st(sample_count=1.5), "schema", "station"),
    "int_whole_float": (st(sample_count=2.0), None, "station"),
    "int_whole_text": (st(sample_count="2.0"), None, "station"),
    "int_fraction_text": (st(sample_count="2.5"), "parse", "station"),
    "int_zero": (st(sample_count=0), "range", "station"),
    "int_null": (st(sample_count=None), "schema", "station"),
    "construction_unknown": (st(construction="GUESS"), "schema", "station"),
    "ts_naive": (w(ts="2026-07-19T12:00:00"), "schema", "weather"),
    "ts_date": (w(ts="2026-07-19"), "schema", "weather"),
    "ts_offset": (w(ts="2026-07-19T12:00:00+02:00"), "schema", "weather"),
    "ts_zero_offset": (w(ts="2026-07-19T12:00:00+00:00"), None, "weather"),
    "ts_micros": (w(ts="2026-07-19T12:00:00.123456Z"), None, "weather"),
    "ts_word": (w(ts="yesterday"), "parse", "weather"),
    "ts_impossible": (w(ts="2026-02-30T12:00:00Z"), "parse", "weather"),
    "ts_epoch": (w(ts=1784462400), None, "weather"),
    "ts_epoch_ms": (w(ts=1784462400000), None, "weather"),
    "ts_null": (w(ts=None), "schema", "weather"),
    "repeated_key_keeps_last": (env("weather", W).replace('"rainfall_mm": 0.0', '"rainfall_mm": -1, "rainfall_mm": 2'), None, "weather"),
}


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(name, message) for name, (message, _r, _c) in CASES.items()]
    gated = G.validate_envelopes(spark.createDataFrame(rows, "name string, value string"), CFG)
    return gated, {r.name: r for r in gated.collect()}


@pytest.mark.parametrize("name", CASES)
def test_reason(judged, name):
    row = judged[1][name]
    assert (row.reason_code, row.claimed_type) == CASES[name][1:]
    assert (row.event is None) == (row.reason_code is not None)


def test_values_are_typed(judged):
    rows = judged[1]
    assert rows["float_text"].event.temperature_c == 12.5
    assert rows["float_boolean"].event.temperature_c == 1.0
    assert rows["int_whole_text"].event.sample_count == 2
    assert rows["ts_micros"].event.ts.microsecond == 123456
    assert rows["ts_epoch"].event.ts == rows["ts_epoch_ms"].event.ts == rows["weather"].event.ts
    assert rows["repeated_key_keeps_last"].event.rainfall_mm == 2.0
    assert rows["weather"].event.city is None


def test_split_counts_and_quarantine(judged):
    gated, rows = judged
    bad = sum(1 for _m, reason, _c in CASES.values() if reason)
    counts = gated.agg(*G.gate_counts()).first()
    assert (counts.consumed, counts.quarantined) == (len(CASES), bad)
    assert counts.forwarded == len(CASES) - bad
    assert counts.region_mismatch == 1
    valid, rejected = G.split_valid(gated)
    assert (valid.count(), rejected.count()) == (counts.forwarded, bad)
    kept = rejected.where(F.col("raw") == CASES["array"][0]).first()
    assert (kept.event_type, kept.reason_code) == ("unknown", "parse")


def test_wrapped_events_come_back(spark):
    rows = [
        weather("2026-07-19T12:15:00.250000", "EUR", 20.25, 1.5),
        satellite("2026-07-19T12:17:00", "NAM", "Chicago", pm25=8.5),
        station("2026-07-19T12:00:00", "ASI", "Tokyo", "s9", -1.5, samples=3),
    ]
    df = frame(spark, rows)
    back = G.valid_events(G.validate_envelopes(wrap_envelopes(df), CFG))
    assert back.columns == df.columns
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_filters_stay_above_the_checks(spark, judged):
    plan = G.valid_events(judged[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter isnull(reason_code") < plan.index("CollectMetrics")
