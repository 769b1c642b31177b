"""Column expressions: index arithmetic, tolerance, geometry and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from envgrade.config import Settings


def clamp(x: Column, lo: float, hi: float) -> Column:
    # least/greatest skip nulls, so a missing value has to be passed through.
    return F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def verbal_label(index: Column, cfg: Settings) -> Column:
    return (
        F.when(index <= cfg.label_low_max, "low")
        .when(index <= cfg.label_medium_max, "medium")
        .when(index.isNotNull(), "high")
    )


def mqo_tolerance(station_value: Column, cfg: Settings) -> Column:
    """Allowed station-model distance at a station value, in the value's own unit."""
    a2 = cfg.tolerance_alpha**2
    spread = F.lit(1.0 - a2) * station_value * station_value + F.lit(
        a2 * cfg.tolerance_reference**2
    )
    return F.lit(cfg.tolerance_beta) * (F.lit(cfg.tolerance_relative) * F.sqrt(spread))


def window_bounds(ts: Column, minutes: int) -> tuple[Column, Column]:
    """Start and end of the epoch-aligned tumbling window that holds ``ts``."""
    if minutes <= 0:
        raise ValueError("window size must be a positive number of minutes")
    w = F.window(ts, f"{int(minutes)} minutes")
    return w["start"], w["end"]


def half_diagonal_m(step: Column, latitude: Column, cfg: Settings) -> Column:
    side_km = step * F.lit(cfg.degree_km)
    return F.hypot(side_km, side_km * F.cos(F.radians(latitude))) * F.lit(500.0)


def station_radius_m(step: Column, latitude: Column, cfg: Settings) -> Column:
    """Search radius in whole metres."""
    return F.floor(F.least(half_diagonal_m(step, latitude, cfg), F.lit(cfg.radius_cap_m)))


def radius_is_capped(step: Column, latitude: Column, cfg: Settings) -> Column:
    return half_diagonal_m(step, latitude, cfg) > cfg.radius_cap_m


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(half_dlat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlon), F.lit(2.0))
    return F.lit(2 * 6_371_000.0) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def canonical_key(ts: Column) -> Column:
    """Fixed-width UTC text whose order is the order of time."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def axis_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def freshness_line(newest_start: Column, minutes: int) -> Column:
    return F.format_string(
        f"newest window %s UTC, {minutes} minute windows",
        F.date_format(newest_start, "yyyy-MM-dd HH:mm"),
    )


def absent_marker(value: Column, decimals: int = 1) -> Column:
    shown = F.format_string(f"%.{decimals}f", value)
    return F.when(value.isNotNull(), shown).otherwise("not recorded")


def record_json(*columns: str) -> Column:
    """One JSON object per row with its keys in sorted order; nulls are written."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
