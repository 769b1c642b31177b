"""Small hand-written events. All values are invented."""

from __future__ import annotations

from datetime import datetime, timezone

from envgrade import schemas as S


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def _event(event_type: str, ts: str, region: str, **values) -> tuple:
    row = {"event_type": event_type, "ts": at(ts), "region": region, **values}
    return tuple(row.get(f.name) for f in S.EVENT_SCHEMA.fields)


def weather(ts: str, region: str, temperature: float, rain: float = 0.0, wind: float = 1.0) -> tuple:
    return _event(S.WEATHER, ts, region, temperature_c=temperature, rainfall_mm=rain, wind_speed_ms=wind)


def satellite(ts, region, city, pm25=10.0, cloud=50.0, vegetation=0.0, aerosol=1.0) -> tuple:
    return _event(
        S.SATELLITE, ts, region, city=city, cloud_cover_pct=cloud, vegetation_index=vegetation,
        aerosol_index=aerosol, model_pm25_ugm3=pm25,
    )


def station(ts, region, city, station_id, pm25, samples=1) -> tuple:
    kind = S.PROVIDER_HOURLY if samples == 1 else S.COMPUTED_MEAN
    return _event(
        S.STATION, ts, region, city=city, station_id=station_id, pm25_ugm3=pm25,
        sample_count=samples, construction=kind,
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, S.EVENT_SCHEMA)
