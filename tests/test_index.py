from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from envgrade.config import ConfigError, Settings, Stretch
from envgrade.functions import scalars as X
from envgrade.operators.index import compute_records, dryness_index, impact_index
from tests.helpers import at, frame, satellite, station, weather

CFG = Settings()

JULY = [
    weather("2026-07-19T12:15:00", "EUR", 20.0, 0.0),
    weather("2026-07-19T12:16:00", "EUR", 24.0, 10.0),
    satellite("2026-07-19T12:17:00", "EUR", "Berlin", cloud=50.0, vegetation=0.0, aerosol=1.0),
    satellite("2026-07-19T12:18:00", "EUR", "Berlin", cloud=30.0, vegetation=0.2, aerosol=2.0),
]


def test_worked_example(spark):
    row = compute_records(frame(spark, JULY), CFG).first()
    assert (row.window_start.hour, row.window_start.minute, row.window_end.minute) == (12, 0, 30)
    assert row.temperature_anomaly == pytest.approx(0.9)
    assert row.dryness_index == pytest.approx(0.60)
    assert row.pollution_index == pytest.approx(0.575)
    assert row.impact_index == pytest.approx(38.85)
    assert row.confidence == "MEASURED"
    assert (row.pm25_disagreement, row.provenance_tier) == ("NOT_COMPARED", "UNCHECKED")


def test_normal_follows_the_month_of_the_window(spark):
    january = [weather("2026-01-19T12:15:00", "EUR", 20.0), weather("2026-01-19T12:16:00", "EUR", 24.0)]
    assert compute_records(frame(spark, january), CFG).first().temperature_anomaly == pytest.approx(18.9)


def test_grades_and_missing_streams(spark):
    rows = [
        weather("2026-07-19T12:15:00", "AFR", 30.0),
        weather("2026-07-19T12:16:00", "AFR", 26.0),
        weather("2026-07-19T12:15:00", "ASI", 25.0),
        satellite("2026-07-19T12:15:00", "NAM", "Chicago"),
        satellite("2026-07-19T12:25:00", "NAM", "Chicago"),
        station("2026-07-19T13:00:00", "EUR", "Berlin", "s1", 4.0),
    ]
    out = {r.region: r for r in compute_records(frame(spark, rows), CFG).collect()}
    assert set(out) == {"AFR", "ASI", "NAM"}  # a station alone opens no window
    assert (out["AFR"].confidence, out["AFR"].pollution_index) == ("INFERRED", 0.0)
    assert out["AFR"].model_pm25_ugm3 is None
    assert out["ASI"].confidence == "AMBIGUOUS"
    assert (out["NAM"].confidence, out["NAM"].temperature_anomaly) == ("INFERRED", 0.0)


def test_order_of_events_does_not_matter(spark):
    a = compute_records(frame(spark, JULY), CFG).collect()
    b = compute_records(frame(spark, JULY[::-1]), CFG).collect()
    assert [r[:3] for r in a] == [r[:3] for r in b]
    assert a[0].impact_index == pytest.approx(b[0].impact_index)


def test_expressions_at_their_limits(spark):
    lit = F.lit
    row = spark.range(1).select(
        impact_index(lit(1000.0), lit(1.0), lit(1.0), CFG).alias("top"),
        impact_index(lit(-50.0), lit(0.0), lit(0.0), CFG).alias("bottom"),
        dryness_index(lit(5.0), lit(None).cast("double"), CFG).alias("rain_only"),
        X.clamp(lit(None).cast("double"), 0.0, 1.0).alias("nothing"),
        X.verbal_label(lit(33.34), CFG).alias("low"),
        X.verbal_label(lit(66.67), CFG).alias("medium"),
        X.verbal_label(lit(66.68), CFG).alias("high"),
        X.absent_marker(lit(None).cast("double")).alias("absent"),
        X.absent_marker(lit(0.0)).alias("zero"),
    ).first()
    assert (row.top, row.bottom, row.rain_only, row.nothing) == (100.0, 0.0, 0.75, None)
    assert (row.low, row.medium, row.high) == ("low", "medium", "high")
    assert (row.absent, row.zero) == ("not recorded", "0.0")


@pytest.mark.parametrize(
    "value,expected", [(0, 9.0), (2, 9.086), (4, 9.339), (10, 10.949), (25, 18.0), (50, 32.45), (100, 63.0), (-25, 18.0)]
)
def test_tolerance(spark, value, expected):
    got = spark.range(1).select(X.mqo_tolerance(F.lit(float(value)), CFG).alias("t")).first().t
    assert got == pytest.approx(expected, abs=5e-4)


def test_settings_refuse_bad_tables():
    with pytest.raises(ConfigError):
        Settings(window_minutes=0)
    with pytest.raises(ConfigError):
        Settings(index_weights={"temperature_anomaly": 0.0, "dryness_index": 0.0, "pollution_index": 0.0})
    with pytest.raises(ConfigError):
        Settings(temperature_normals={"EUR": (1.0,) * 11})
    with pytest.raises(ConfigError):
        Settings(vegetation_reference={"EUR": (1.5,) * 12})
    with pytest.raises(ConfigError):
        Stretch(at("2026-01-02T00:00:00"), timedelta(days=-1))
    with pytest.raises(ConfigError):
        CFG.window("next_week")


def test_region_without_normals_is_refused(spark):
    cfg = Settings(regions=("EUR", "ANT"))
    with pytest.raises(ConfigError):
        compute_records(frame(spark, JULY), cfg)
