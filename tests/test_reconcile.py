import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import Settings, Stretch
from envgrade.operators import guards as GD
from envgrade.operators import reconcile as RC
from envgrade.operators import reports as R
from envgrade.operators.index import compute_records
from tests.helpers import at, frame, satellite, station, weather

CFG = Settings(window_minutes=60)
HOUR = "2026-07-17T10:00:00"
NEXT = "2026-07-17T11:00:00"


def _stations(hour, region, city, values):
    return [station(hour, region, city, f"{city}-{i}", v) for i, v in enumerate(values)]


ROWS = [
    *_stations(HOUR, "EUR", "Berlin", [11.0, 12.5, 240.0]),
    satellite(HOUR, "EUR", "Berlin", pm25=12.0),
    satellite(NEXT, "EUR", "Berlin", pm25=12.0),
    *_stations(HOUR, "ASI", "Delhi", [86.0, 88.0, 90.0]),
    satellite(HOUR, "ASI", "Delhi", pm25=12.0),
    *_stations(HOUR, "ASI", "Tokyo", [10.0, 11.0, 12.0]),
    satellite(HOUR, "ASI", "Tokyo", pm25=11.0),
    *_stations(HOUR, "NAM", "Chicago", [13.0, 13.5]),
    satellite(HOUR, "NAM", "Chicago", pm25=12.0),
    satellite(HOUR, "AFR", "Lagos", pm25=12.0),
    satellite(NEXT, "AFR", "Lagos", pm25=12.0),
]


@pytest.fixture(scope="module")
def parts(spark):
    events = frame(spark, ROWS)
    stations = events.where(F.col("event_type") == S.STATION)
    models = events.where(F.col("event_type") == S.SATELLITE)
    records = compute_records(events, CFG)
    done = RC.reconcile(records, stations, models, CFG, window=CFG.window("control")).cache()
    return events, stations, models, records, done


def _by_key(done):
    return {(r.region, r.window_start.hour): r for r in done.collect()}


def test_every_state(parts):
    rows = _by_key(parts[4])
    eur = rows["EUR", 10]
    assert (eur.pm25_disagreement, eur.provenance_tier) == ("AGREED", "STATION_CHECKED")
    assert eur.city_comparisons[0].station_pm25_ugm3 == 12.5
    asi = rows["ASI", 10]
    assert (asi.pm25_disagreement, asi.flagged_city_count, asi.covered_city_count) == ("DISAGREED", 1, 2)
    assert [c.city for c in asi.city_comparisons] == ["Delhi", "Tokyo"]
    nam = rows["NAM", 10]
    assert (nam.pm25_disagreement, nam.provenance_tier) == ("NOT_COMPARED", "UNCHECKED")
    assert (nam.city_comparisons[0].station_count, nam.city_comparisons[0].tolerance) == (2, None)
    afr = rows["AFR", 10]
    assert afr.city_comparisons[0].station_pm25_ugm3 is None
    assert rows["EUR", 11].provenance_tier == "UNCHECKED"  # nothing is carried over


def test_distance_equal_to_the_tolerance_agrees(spark):
    rows = [("EUR", "a", 0.0, 9.0, 3), ("EUR", "b", 0.0, 9.0000001, 3)]
    df = spark.createDataFrame(
        rows, "region string, city string, station_pm25_ugm3 double, model_pm25_ugm3 double, station_count bigint"
    )
    assert [r.state for r in RC.compare_city(df, CFG).orderBy("city").collect()] == ["AGREED", "DISAGREED"]


def test_stray_rows_refuse_the_run(parts):
    _e, stations, models, records, _d = parts
    late = Stretch(at("2026-07-17T11:00:00"), timedelta(hours=13))
    with pytest.raises(RC.WindowViolation, match="1 observation timestamps"):
        RC.reconcile(records, stations, models, CFG, window=late)


def test_city_windows_without_record_are_reported(parts):
    _e, stations, models, records, _d = parts
    cw = RC.city_windows(stations, models, CFG)
    some = records.where(F.col("region") != "ASI")
    assert RC.city_windows_without_record(cw, some).count() == 2
    joined = RC.attach_reconciliation(some, RC.rollup_region(cw))
    assert joined.count() == some.count()


def test_free_spans_match_brute_force(spark, parts):
    spans = [("EUR", at("2026-07-17T09:30:00"), at("2026-07-17T10:00:00")), ("EUR", at("2026-07-17T10:00:00"), at("2026-07-17T11:00:01"))]
    df = spark.createDataFrame(spans, "region string, window_start timestamp, window_end timestamp")
    got = RC.events_in_spans(parts[0].select("region", "ts"), df, 60).groupBy("window_start").count().collect()
    assert [r["count"] for r in got] == [5]  # the end is exclusive, the start is not


def test_spans_of_a_minute_and_a_year_in_one_join(spark):
    """Against all pairs; lists stay short, and a crowded minute is dealt into parts."""
    draw, start = random.Random(3), at("1969-11-01T00:00:00")
    moments = [start + timedelta(seconds=draw.randrange(300 * 86400)) for _ in range(400)]
    moments += [start + timedelta(days=50, seconds=draw.randrange(60)) for _ in range(200)]
    events = [(draw.choice(["EUR", "NAM"]), m, i) for i, m in enumerate(moments)] + [("EUR", None, 999)]
    spans = []
    for i, length in enumerate([30, 60, 61, 3600, 86400, 7 * 86400 + 1, 365 * 86400] * 3):
        low = start + timedelta(seconds=draw.randrange(100 * 86400)) if i % 2 else start + timedelta(days=50)
        spans.append((draw.choice(["EUR", "NAM"]), low, low + timedelta(seconds=length), i))
    spans += [("EUR", start, start, 90), (None, start, start + timedelta(days=400), 91), ("EUR", None, start, 92)]
    left = spark.createDataFrame(events, "region string, ts timestamp, e int")
    right = spark.createDataFrame(spans, "region string, window_start timestamp, window_end timestamp, s int")
    want = sorted(
        (e, s) for r, ts, e in events for q, low, high, s in spans
        if r == q and ts is not None and low is not None and low <= ts < high
    )
    for part_rows in (1_000_000, 20):
        got = RC.events_in_spans(left, right, part_rows=part_rows).select("e", "s").collect()
        assert sorted(map(tuple, got)) == want
    assert len(want) > 600
    lists = {r.s: r["count"] for r in RC.span_nodes(right, 1).groupBy("s").count().collect()}
    assert 90 not in lists and 92 not in lists
    for _, low, high, s in spans[:21]:
        minutes = (high - low).total_seconds() / 60 + 2
        assert lists[s] <= 2 * math.log2(minutes) + 1


def test_reports(parts):
    *_x, records, done = parts
    summary = R.run_summary(done).first()
    assert (summary.region_windows, summary.covered_city_windows, summary.flagged_city_windows) == (6, 3, 1)
    assert (summary.agreed, summary.disagreed, summary.not_compared) == (1, 1, 4)
    flat = RC.explode_comparisons(done)
    rates = {r.arm: r for r in R.rates_by(flat, "region", CFG.regions).collect()}
    assert (rates["AFR"].empty, rates["AFR"].flag_rate) == (True, None)
    assert rates["pooled"].covered == 3
    assert R.check_covered(done) == 3
    forged = done.withColumn("covered_city_count", F.lit(2).cast("bigint"))
    with pytest.raises(ValueError):
        R.check_covered(forged)
    assert R.verdicts(flat, CFG).first().discrimination == "NOT_EVALUABLE"
    assert R.inheritance_witness(done).first().can_expose


def test_guards_pass_and_seeded_violations_fail(parts):
    events, stations, models, records, done = parts
    flat = RC.explode_comparisons(done)
    assert GD.enforce(GD.tier_is_earned(done), "tier") == 6
    assert GD.enforce(GD.reported_never_resolved(flat, stations, models, CFG), "reported") == 7
    assert GD.enforce(GD.reconciling_keeps_the_index(records, done), "index") == 6
    assert GD.enforce(GD.stations_do_not_move_the_index(events, CFG), "stations") == 6

    inherited = done.withColumn("provenance_tier", F.lit(S.STATION_CHECKED))
    midpoint = (F.col("station_pm25_ugm3") + F.col("model_pm25_ugm3")) / 2
    seeds = [
        GD.tier_is_earned(inherited),
        GD.tier_is_earned(done.withColumn("covered_city_count", F.col("covered_city_count") + 1)),
        GD.reported_never_resolved(
            flat.withColumn("model_pm25_ugm3", F.col("station_pm25_ugm3")), stations, models, CFG),
        GD.reported_never_resolved(
            flat.withColumn("station_pm25_ugm3", F.coalesce(midpoint, "station_pm25_ugm3")), stations, models, CFG),
        GD.reported_never_resolved(
            flat.withColumn("station_pm25_ugm3", F.lit(None).cast("double")), stations, models, CFG),
        GD.reported_never_resolved(flat.where("city != 'Tokyo'"), stations, models, CFG),
        GD.reconciling_keeps_the_index(records, done.withColumn("impact_index", F.col("impact_index") + 1)),
    ]
    for seeded in seeds:
        with pytest.raises(GD.GuardFailure):
            GD.enforce(seeded, "seeded")
    with pytest.raises(GD.GuardFailure):
        GD.enforce(GD.tier_is_earned(done.limit(0)), "empty")
