"""Climate index per region and event-time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import ConfigError, Settings
from envgrade.functions.dims import monthly_normals
from envgrade.functions.scalars import clamp, window_bounds


def with_windows(df: DataFrame, minutes: int, ts: str = "ts") -> DataFrame:
    start, end = window_bounds(F.col(ts), minutes)
    return df.withColumn("window_start", start).withColumn("window_end", end)


def window_means() -> list[Column]:
    """Mergeable aggregates of one window; averages are null without their stream."""
    weather = F.col("event_type") == S.WEATHER
    satellite = F.col("event_type") == S.SATELLITE
    return [
        F.count_if(weather).alias("n_weather"),
        F.count_if(satellite).alias("n_satellite"),
        F.avg(F.when(weather, F.col("temperature_c"))).alias("mean_temperature_c"),
        F.avg(F.when(weather, F.col("rainfall_mm"))).alias("mean_rainfall_mm"),
        F.avg(F.when(satellite, F.col("vegetation_index"))).alias("mean_vegetation"),
        F.avg(F.when(satellite, F.col("aerosol_index"))).alias("mean_aerosol"),
        F.avg(F.when(satellite, F.col("cloud_cover_pct"))).alias("mean_cloud_pct"),
        F.avg(F.when(satellite, F.col("model_pm25_ugm3"))).alias("model_pm25_ugm3"),
    ]


def index_inputs(events: DataFrame) -> DataFrame:
    """Only weather and satellite rows may open a window or move the index."""
    return events.where(F.col("event_type").isin(S.WEATHER, S.SATELLITE))


def aggregate_windows(events: DataFrame, cfg: Settings) -> DataFrame:
    # avg and count combine map-side, so the shuffle carries one row per task and
    # window however many events the busiest region has. The window stays whole as
    # the key: in a stream only the window itself, not its start, carries the
    # watermark that lets finished state go.
    window = F.window("ts", f"{cfg.window_minutes} minutes")
    means = window_means()
    grouped = index_inputs(events).groupBy("region", window.alias("window")).agg(*means)
    kept = [c for c in grouped.columns if c not in ("region", "window")]
    return grouped.select(
        "region",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *kept,
    )


def with_monthly_normal(df: DataFrame, cfg: Settings, ts: str = "window_start") -> DataFrame:
    """Normal of the month of ``ts``. A configured region without a table is refused."""
    missing = sorted(set(cfg.regions) - set(cfg.temperature_normals))
    if missing:
        raise ConfigError(f"no monthly normals for {missing}")
    keyed = df.withColumn("month", F.month(F.col(ts)))
    return keyed.join(monthly_normals(df.sparkSession, cfg), ["region", "month"], "left")


def temperature_anomaly(mean: Column, normal: Column) -> Column:
    # No weather gives 0.0; weather without a normal stays null rather than looking neutral.
    return F.when(mean.isNull(), 0.0).otherwise(mean - normal)


def dryness_index(mean_rain: Column, mean_vegetation: Column, cfg: Settings) -> Column:
    rain = clamp(F.lit(1.0) - mean_rain / F.lit(cfg.rainfall_saturation_mm), 0.0, 1.0)
    vegetation = (F.lit(1.0) - mean_vegetation) / F.lit(2.0)
    return F.coalesce((rain + vegetation) / F.lit(2.0), rain, vegetation, F.lit(0.0))


def pollution_index(mean_aerosol: Column, mean_cloud: Column, cfg: Settings) -> Column:
    haze = clamp(mean_aerosol / F.lit(cfg.aerosol_saturation), 0.0, 1.0)
    return F.coalesce((haze + mean_cloud / F.lit(100.0)) / F.lit(2.0), F.lit(0.0))


def impact_index(anomaly: Column, dryness: Column, pollution: Column, cfg: Settings) -> Column:
    w = cfg.index_weights
    score = (
        F.lit(w["temperature_anomaly"]) * clamp(anomaly / F.lit(cfg.anomaly_scale_c), 0.0, 1.0)
        + F.lit(w["dryness_index"]) * dryness
        + F.lit(w["pollution_index"]) * pollution
    )
    return clamp(F.lit(100.0) * score / F.lit(float(sum(w.values()))), 0.0, 100.0)


def grade_confidence(n_weather: Column, n_satellite: Column, cfg: Settings) -> Column:
    return (
        F.when(n_weather + n_satellite < cfg.sparsity_min_events, S.AMBIGUOUS)
        .when((n_weather > 0) & (n_satellite > 0), S.MEASURED)
        .otherwise(S.INFERRED)
    )


def score_windows(windows: DataFrame, cfg: Settings) -> DataFrame:
    """Components, index and grade from the aggregates of :func:`aggregate_windows`."""
    c = F.col
    return (
        with_monthly_normal(windows, cfg)
        .withColumn("temperature_anomaly", temperature_anomaly(c("mean_temperature_c"), c("normal_c")))
        .withColumn("dryness_index", dryness_index(c("mean_rainfall_mm"), c("mean_vegetation"), cfg))
        .withColumn("pollution_index", pollution_index(c("mean_aerosol"), c("mean_cloud_pct"), cfg))
        .withColumn(
            "impact_index",
            impact_index(c("temperature_anomaly"), c("dryness_index"), c("pollution_index"), cfg),
        )
        .withColumn("confidence", grade_confidence(c("n_weather"), c("n_satellite"), cfg))
    )


def as_records(scored: DataFrame) -> DataFrame:
    """Record layout, before any comparison has been made."""
    return scored.select(
        *S.KEY,
        *S.INDEX_COLUMNS,
        F.lit(S.NOT_COMPARED).alias("pm25_disagreement"),
        F.lit(S.UNCHECKED).alias("provenance_tier"),
        F.lit(0).cast("bigint").alias("flagged_city_count"),
        F.lit(0).cast("bigint").alias("covered_city_count"),
        F.array().cast(S.RECORD_SCHEMA["city_comparisons"].dataType).alias("city_comparisons"),
    )


def compute_records(events: DataFrame, cfg: Settings) -> DataFrame:
    """One unordered record per (region, window) that holds an index input."""
    return as_records(score_windows(aggregate_windows(events, cfg), cfg))
