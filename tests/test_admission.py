import math
import random

from envgrade.config import Settings
from envgrade.operators import admission as AD
from envgrade.operators import capture as CP
from tests.helpers import frame, station

CFG = Settings()
LOCATIONS = "location_id long, latitude double, longitude double"
GRID = "region string, city string, grid_lat double, grid_lon double, radius_m double"


def _distance(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * math.asin(math.sqrt(min(1.0, h)))


def test_radius_search_equals_all_pairs(spark):
    """Cities on the equator, in middle latitudes, at the date line, by the poles, with radii of metres to the cap."""
    draw = random.Random(4)
    centres = [(0, 0), (52.4, 4.9), (-33, 179.95), (10, -179.99), (79.9, 12), (81, -70), (89.9, 30), (-90, 0), (60, 180)]
    grid = [("R", f"c{i}", float(a), float(b), r) for i, (a, b) in enumerate(centres) for r in (0.0, 40.0, 3000.0, 25000.0)]
    near = []
    for a, b in centres:
        for _ in range(60):
            lat = max(-90.0, min(90.0, a + draw.uniform(-0.4, 0.4)))
            lon = b + draw.uniform(-0.5, 0.5) / max(0.02, math.cos(math.radians(a)))
            near.append((lat, (lon + 180) % 360 - 180))
        near.append((float(a), float(b)))
    rows = [(i, a, b) for i, (a, b) in enumerate(near)] + [(9000, None, 1.0), (9001, 1.0, None)]
    got = AD.stations_in_radius(
        spark.createDataFrame(rows, LOCATIONS), spark.createDataFrame(grid, GRID), CFG
    ).select("location_id", "city", "radius_m", "distance_m").collect()
    found = {(r.location_id, r.city, r.radius_m) for r in got}
    assert len(found) == len(got)
    # The same formula over all pairs, with the operator's own earth radius.
    most = max(got, key=lambda r: r.distance_m)
    a, b = near[most.location_id]
    _, _, c, d, _ = next(g for g in grid if g[1] == most.city)
    radius = most.distance_m / _distance(a, b, c, d)
    for i, (a, b) in enumerate(near):
        for _, city, c, d, reach in grid:
            far = _distance(a, b, c, d) * radius
            if abs(far - reach) > 0.01 or far == 0:
                assert ((i, city, reach) in found) == (far <= reach), (a, b, c, d, reach, far)


def test_candidates_stay_near_the_result(spark):
    draw = random.Random(5)
    centres = [(draw.uniform(-60, 60), draw.uniform(-179, 179), draw.choice([2000.0, 8000.0, 25000.0])) for _ in range(40)]
    grid = spark.createDataFrame([("R", f"c{i}", a, b, r) for i, (a, b, r) in enumerate(centres)], GRID)
    rows = [(a + draw.uniform(-1, 1), b + draw.uniform(-1, 1)) for a, b, _ in centres for _ in range(2000)]
    places = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], LOCATIONS)
    pairs, result = AD.radius_candidates(places, grid, CFG), AD.stations_in_radius(places, grid, CFG)
    assert result.count() * 4 > pairs.count() > result.count() > 500


def test_population_counts_hours_and_stations(spark):
    rows = [
        station(f"2026-07-{d:02d}T{h:02d}:{m:02d}:00", "EUR", f"c{h % 2}", f"s{(d * h) % 5}", float(d + h + m))
        for d in range(1, 9) for h in range(0, 24, 3) for m in (0, 20)
    ] + [station(f"{y}-01-01T00:00:00", "EUR", "c0", "s9", 1.0) for y in (1969, 1975, 1999)]
    df = CP.station_population(frame(spark, rows))
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r.city: r for r in df.collect()}
    names = ("ts", "city", "station_id", "pm25_ugm3")
    events = [tuple(r) for r in frame(spark, rows).select(*names).collect()]
    for city in ("c0", "c1"):
        mine = [r for r in events if r[1] == city]
        assert (got[city].n_rows, got[city].stations) == (len(mine), len({r[2] for r in mine}))
        assert got[city].hours == len({r[0].replace(minute=0) for r in mine})
        assert (got[city].min_value, got[city].max_value) == (min(r[3] for r in mine), max(r[3] for r in mine))
