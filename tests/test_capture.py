from datetime import timedelta

import json

import pytest
from pyspark.sql import functions as F

from envgrade.config import Settings, Stretch
from envgrade.operators import admission as AD
from envgrade.operators import capture as CP
from envgrade.operators import reports as R
from envgrade.sources import pages as PG
from tests.helpers import at, frame, station

CFG = Settings()
SPAN = Stretch(at("2026-07-17T00:00:00"), timedelta(days=1))


def hour(start="10:00", end="11:00", value=5.0, observed=1, **extra):
    row = {
        "value": value,
        "flagInfo": {"hasFlags": False},
        "period": {
            "datetimeFrom": {"utc": f"2026-07-17T{start}:00Z"},
            "datetimeTo": {"utc": f"2026-07-17T{end}:00Z"},
        },
        "coverage": {"expectedCount": 4, "observedCount": observed, "percentComplete": observed * 25.0},
        "summary": {"min": 1.0, "max": 1.0},
    }
    row.update(extra)
    return row


ENTRIES = {
    "retained": [hour(), hour(value=-3.5), hour("11:00", "12:00", observed=4), hour(value=7)],
    "malformed": ["n/a", 3, hour(value="high"), hour(period={}), hour("10:xx")],
    "null_value": [hour(value=None), {"period": {}}],
    "period_not_one_hour_long": [hour("10:00", "11:30"), hour("10:30", "12:00"), hour(end="zz:00")],
    "period_not_hour_aligned": [hour("10:30", "11:30"), hour("10:30", "11:30", flagInfo={"hasFlags": True})],
    "has_flags_true": [hour(flagInfo={"hasFlags": True}), hour(flagInfo=None, hasFlags=True)],
    "observed_count_below_one": [hour(observed=0), hour(coverage={"observedCount": 1.5}), hour(coverage={})],
}


@pytest.fixture(scope="module")
def gated(spark):
    entries = [e for es in ENTRIES.values() for e in es]
    body = json.dumps({"meta": {"page": 1}, "results": entries})
    pages = spark.createDataFrame([(1, body), (2, '{"results": []}'), (3, "oops")], "location_id bigint, body string")
    places = spark.createDataFrame(
        [(1, "1", "Madrid", "EUR"), (2, "2", "Lagos", "AFR"), (3, "3", "Delhi", "ASI")],
        "location_id bigint, station_id string, city string, region string",
    )
    return CP.station_hour_gate(PG.explode_station_hours(pages, places)).cache(), places


def test_gate_order_and_tally(gated):
    tally = CP.gate_tally(gated[0]).first().asDict()
    assert tally.pop("returned") == sum(map(len, ENTRIES.values()))
    assert tally == {reason: len(rows) for reason, rows in ENTRIES.items()}


def test_retained_rows(gated):
    rows = CP.retained_stations(gated[0]).orderBy("ts", "pm25_ugm3").collect()
    assert [r.pm25_ugm3 for r in rows] == [-3.5, 5.0, 7.0, 5.0]
    assert [r.construction for r in rows] == ["PROVIDER_HOURLY"] * 3 + ["COMPUTED_MEAN"]
    assert rows[-1].sample_count == 4


def test_off_hour_and_exclusions(gated):
    rows, places = gated
    levels = {(r.city, r.level): r.n_rows for r in CP.off_hour_breakdown(rows).collect()}
    assert levels == {(None, 0): 5, ("Madrid", 1): 5, ("Madrid", 2): 5}
    causes = {r.city: r.cause for r in CP.cities_without_rows(places, rows).collect()}
    assert causes == {"Lagos": "nothing_served", "Delhi": "nothing_served"}
    only_off = rows.where(F.col("gate_reason").isin(*CP.OFF_HOUR))
    assert CP.cities_without_rows(places, only_off).where("city = 'Madrid'").first().cause == "off_hour_periods"


def test_sample_count_routes(spark):
    rows = [(4, 4, 100.0, 1.0, 2.0), (1, 4, 100.0, 1.0, 1.0), (1, 4, 25.0, 1.0, 2.0), (2, 4, 62.5, None, None), (3, 4, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "observed bigint, expected bigint, percent double, summary_min double, summary_max double")
    got = [r.c for r in df.select(CP.sample_count_conflict().alias("c")).collect()]
    assert got == [False, True, True, False, False]  # 2.5 rounds to even


def test_breakdowns_and_uniqueness(spark, gated):
    rows, places = gated
    sensors = spark.createDataFrame(
        [
            (10, 1, 0, "pm25", "µg/m³", at("2020-01-01T00:00:00"), at("2018-01-01T00:00:00")),
            (11, 1, 1, "pm25", "µg/m³", at("2020-01-01T00:00:00"), at("2027-01-01T00:00:00")),
            (20, 2, 0, "o3", "ppm", at("2020-01-01T00:00:00"), at("2027-01-01T00:00:00")),
            (30, 3, 0, "pm25", "µg/m³", at("2020-01-01T00:00:00"), at("2027-01-01T00:00:00")),
            (31, 3, 1, "pm25", "µg/m³", at("2020-01-01T00:00:00"), at("2027-01-01T00:00:00")),
        ],
        "sensor_id bigint, location_id bigint, position int, parameter string, units string, "
        "datetime_first timestamp, datetime_last timestamp",
    )
    resolved = AD.resolve_sensors(places, sensors, SPAN, CFG)
    kinds = {r.city: (r.kind, r.pm25_sensor_id) for r in resolved.collect()}
    assert kinds == {
        "Madrid": ("resolved", 11), "Lagos": ("no_pm25_sensor", None), "Delhi": ("ambiguous_multiple_covering", None),
    }
    assert AD.mapping_is_one_to_one(resolved).first().one_to_one
    stations = CP.retained_stations(rows)
    CP.check_breakdowns(rows, stations, resolved)
    with pytest.raises(CP.CaptureFault):
        CP.check_breakdowns(rows, stations.limit(1), resolved)
    with pytest.raises(CP.CaptureFault, match="appear more than once"):
        CP.check_unique(stations, ["station_id", "ts"])
    assert CP.check_unique(stations.dropDuplicates(["ts"]), ["station_id", "ts"]) == 2

    wrong = sensors.withColumn("units", F.when(F.col("sensor_id") == 10, "ppm").otherwise(F.col("units")))
    madrid = AD.resolve_sensors(places, wrong, SPAN, CFG).where("city = 'Madrid'").first()
    assert (madrid.kind, madrid.identity_fault) == ("none_covering_window", True)

    flags = places.withColumns({"is_mobile": F.lit(False), "is_monitor": F.lit(True)})
    funnel = {r.city: r for r in AD.admission_funnel(flags, sensors, SPAN, CFG).collect()}
    assert (funnel["Madrid"].admitted, funnel["Lagos"].with_pm25_sensor) == (1, 0)
    short = {r.city: r for r in AD.admission_shortfall(flags, sensors, SPAN, CFG).collect()}
    assert (short["Madrid"].admitted_first_sensor, short["Madrid"].recovered) == (0, 1)


def test_radius_search_matches_brute_force(spark):
    import math
    import random

    rng = random.Random(5)
    grid = [("EUR", "a", "europe", 52.3, 4.9), ("AFR", "date_line", "global", -17.0, 179.9), ("NAM", "north", "global", 89.95, 10.0)]
    points = []
    for i in range(600):
        _r, _c, _d, lat, lon = grid[i % 3]
        la = max(-90.0, min(90.0, lat + rng.uniform(-0.4, 0.4)))
        lo = lon + rng.uniform(-0.4, 0.4) * (400 if lat > 89 else 1)
        points.append((i, la, (lo + 180) % 360 - 180))
    g = AD.with_radius(spark.createDataFrame(grid, "region string, city string, domain string, grid_lat double, grid_lon double"), CFG)
    found = AD.stations_in_radius(spark.createDataFrame(points, "location_id bigint, latitude double, longitude double"), g, CFG)
    got = sorted((r.city, r.location_id) for r in found.collect())
    radius = {r.city: r.radius_m for r in g.collect()}

    def dist(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 6_371_000.0 * math.asin(math.sqrt(min(1.0, h)))

    want = sorted((c, i) for i, la, lo in points for _r, c, _d, glat, glon in grid if dist(la, lo, glat, glon) <= radius[c])
    assert got == want and {c for c, _ in got} == {"a", "date_line", "north"}


def test_negative_profile_and_population(spark):
    rows = [station(f"2026-07-17T{h:02d}:00:00", "EUR", "Madrid", f"s{i}", v) for h, i, v in
            [(0, 0, -0.5), (1, 0, -998.0), (2, 1, 3.0), (2, 2, 4.0), (2, 3, 5.0), (3, 1, -5.0)]]
    st = frame(spark, rows)
    pooled = R.negative_profile(st).where("arm = 'pooled'").first()
    assert (pooled.negatives, pooled.from_minus_1, pooled.from_minus_5, pooled.below_minus_10) == (3, 1, 1, 1)
    assert pooled.median_negative == -5.0
    pop = CP.station_population(st).first()
    assert (pop.stations, pop.hours, pop.n_rows, pop.median_value) == (4, 4, 6, 1.25)
    total = CP.qualifying_city_hours(st, CFG).where("city is null").first()
    assert (total.qualifying_hours, total.hours) == (1, 4)


def test_normals_are_means_of_city_means(spark):
    rows = [("EUR", "a", f"2020-{m:02d}-01", float(m)) for m in range(1, 13)]
    rows += [("EUR", "a", "2021-01-02", 3.0), ("EUR", "b", "2020-01-01", 10.0), ("EUR", "b", "2020-02-01", None)]
    daily = spark.createDataFrame(rows, "region string, city string, date string, value double").withColumn("date", F.to_date("date"))
    january = R.monthly_normals(daily).where("month = 1").first()
    assert january.normal_exact == 6.0  # (2 + 10) / 2, not the pooled mean
    assert R.months_without_values(daily).count() == 11
    with pytest.raises(ValueError):
        R.check_months(daily)


def test_drift_by_location_leaves_out_locations_of_one_capture(spark):
    from envgrade.operators.capture import drift_by_location

    first = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (1, 10)], "location_id long, sensor_id long")
    second = spark.createDataFrame([(1, 10), (2, 21), (4, 40)], "location_id long, sensor_id long")
    got = {tuple(r) for r in drift_by_location(first, second).select("location_id", "sensor_id", "only_in").collect()}
    assert got == {(2, 20, "first"), (2, 21, "second")}
