"""Run reports: rates, bias, coverage and value profiles.

Reports over comparisons take flat city-window rows. ``compared_rows`` keeps those
that have a record, which is what the records themselves would show.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import Settings, Stretch
from envgrade.functions.dims import literal_table
from envgrade.functions.scalars import mqo_tolerance, verbal_label
from envgrade.operators.index import with_windows
from envgrade.operators.percentiles import exact_median, exact_percentiles, exact_profile

POOLED = "pooled"


def is_covered(state: str = "state") -> Column:
    return F.col(state) != S.NOT_COMPARED


def is_flagged(state: str = "state") -> Column:
    return F.col(state) == S.DISAGREED


def compared_rows(cw: DataFrame, records: DataFrame) -> DataFrame:
    return cw.join(records.select(*S.KEY), S.KEY, "left_semi")


def _distance() -> Column:
    return F.abs(F.col("station_pm25_ugm3") - F.col("model_pm25_ugm3"))


def _rate(flagged: str = "flagged", covered: str = "covered") -> Column:
    return F.when(F.col(covered) > 0, F.col(flagged) / F.col(covered))


# --- run figures ----------------------------------------------------------------


def run_summary(records: DataFrame) -> DataFrame:
    """One row; a state or tier that never occurs reads zero."""
    return records.agg(
        F.count(F.lit(1)).alias("region_windows"),
        F.coalesce(F.sum("covered_city_count"), F.lit(0)).alias("covered_city_windows"),
        F.coalesce(F.sum("flagged_city_count"), F.lit(0)).alias("flagged_city_windows"),
        *[F.count_if(F.col("pm25_disagreement") == s).alias(s.lower()) for s in S.STATES],
        *[F.count_if(F.col("provenance_tier") == t).alias(t.lower()) for t in S.TIERS],
    )


def per_city_breakdown(cw: DataFrame) -> DataFrame:
    return (
        cw.where(is_covered())
        .groupBy("city")
        .agg(F.count(F.lit(1)).alias("covered"), F.count_if(is_flagged()).alias("flagged"))
    )


def rates_by(cw: DataFrame, dim: str, arms: Sequence[str]) -> DataFrame:
    """Flag rate per arm of ``dim`` and pooled; an arm without rows is listed empty."""
    label = F.when(F.grouping(dim) == 1, POOLED).otherwise(F.col(dim))
    rates = (
        cw.where(is_covered())
        .rollup(dim)
        .agg(
            label.alias("arm"),
            F.count(F.lit(1)).alias("covered"),
            F.count_if(is_flagged()).alias("flagged"),
        )
        .drop(dim)
    )
    listed = literal_table(cw.sparkSession, ["arm"], [(a,) for a in (*arms, POOLED)])
    zero = F.lit(0).cast("bigint")
    return (
        rates.join(listed, "arm", "full_outer")
        .withColumns(
            {"covered": F.coalesce("covered", zero), "flagged": F.coalesce("flagged", zero)}
        )
        .withColumns({"flag_rate": _rate(), "empty": F.col("covered") == 0})
    )


def construction_of_windows(stations: DataFrame, cfg: Settings) -> DataFrame:
    """How each city-window's station value was built: one construction, or mixed."""
    return (
        with_windows(stations, cfg.window_minutes)
        .groupBy(*S.CITY_KEY)
        .agg(F.min("construction").alias("_lo"), F.max("construction").alias("_hi"))
        .select(
            *S.CITY_KEY,
            F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise("MIXED").alias("construction"),
        )
    )


def weaker_condition(cw: DataFrame, cfg: Settings) -> DataFrame:
    """Covered city-windows inside the bare uncertainty, the tolerance over beta."""
    inside = _distance() <= F.col("tolerance") / F.lit(cfg.tolerance_beta)
    return cw.where(is_covered()).agg(
        F.count(F.lit(1)).alias("covered"),
        F.count_if(inside).alias("within_u"),
        F.count_if(~inside).alias("outside_u"),
    )


def covered_cross_check(records: DataFrame) -> DataFrame:
    """The covered count by its two routes, the scalar and the detail."""
    detail = F.size(F.filter("city_comparisons", lambda c: c["state"] != S.NOT_COMPARED))
    out = records.agg(
        F.coalesce(F.sum("covered_city_count"), F.lit(0)).alias("by_scalar"),
        F.coalesce(F.sum(detail.cast("bigint")), F.lit(0)).alias("by_detail"),
    )
    return out.withColumn("ok", F.col("by_scalar") == F.col("by_detail"))


def check_covered(records: DataFrame) -> int:
    row = covered_cross_check(records).first()
    if not row["ok"]:
        raise ValueError(
            f"covered count differs: {row['by_scalar']} by scalar, {row['by_detail']} by detail"
        )
    return row["by_scalar"]


def verdicts(cw: DataFrame, cfg: Settings) -> DataFrame:
    """Whether the grade discriminates, and whether its reporting can be judged."""
    counts = cw.agg(
        F.count_if(is_covered()).alias("covered"), F.count_if(is_flagged()).alias("flagged")
    )
    rate = F.col("flag_rate")
    return counts.withColumn("flag_rate", _rate()).select(
        "covered",
        "flagged",
        "flag_rate",
        F.when(F.col("covered") < cfg.evaluable_min_covered, "NOT_EVALUABLE")
        .when((rate > cfg.flag_rate_low) & (rate < cfg.flag_rate_high), "DISCRIMINATES")
        .otherwise("UNINFORMATIVE")
        .alias("discrimination"),
        F.when(F.col("flagged") > 0, "EVALUABLE").otherwise("NOT_EVALUABLE").alias("reporting"),
    )


# --- comparison profiles --------------------------------------------------------


def bias_table(cw: DataFrame) -> DataFrame:
    """Per city over covered windows: medians, model bias, tolerance share, flag rate."""
    rows = cw.where(is_covered())
    out = rows.groupBy("city").agg(
        F.count(F.lit(1)).alias("covered"), F.count_if(is_flagged()).alias("flagged")
    )
    medians = exact_profile(
        rows,
        ["city"],
        {
            "station_pm25_ugm3": {"station_median": 0.5},
            "model_pm25_ugm3": {"model_median": 0.5},
            "tolerance": {"tolerance_median": 0.5},
        },
    )
    out = out.join(medians, "city", "inner")
    station = F.when(F.col("station_median") != 0, F.col("station_median"))
    return out.withColumns(
        {
            "model_bias_pct": (F.col("model_median") - station) / station * 100.0,
            "tolerance_over_station": F.col("tolerance_median") / station,
            "flag_rate": _rate(),
        }
    )


def difference_quartiles(cw: DataFrame) -> DataFrame:
    """Per city the spread of the distance, of the tolerance and of their ratio."""
    rows = cw.where(is_covered()).withColumn("diff", _distance())
    rows = rows.withColumn("ratio", F.col("diff") / F.col("tolerance"))
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    wanted = {v: {f"{v}_{q}": p for q, p in quartiles.items()} for v in ("diff", "tolerance")}
    wanted["ratio"] = {"ratio_median": 0.5, "ratio_max": 1.0}
    counts = rows.groupBy("city").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(exact_profile(rows, ["city"], wanted), "city", "inner")


def zero_model_passes(bias: DataFrame, cfg: Settings) -> DataFrame:
    """Cities where a model that reports nothing would agree at the median hour."""
    limit = mqo_tolerance(F.col("station_median"), cfg)
    return bias.select(
        "city",
        "station_median",
        limit.alias("tolerance_at_median"),
        (F.abs(F.col("station_median")) <= limit).alias("zero_model_passes"),
    )


def cluster_count(cw: DataFrame) -> DataFrame:
    """Covered windows beside the city-weeks they come from; hours are not independent."""
    week = F.struct("city", F.date_trunc("week", "window_start").alias("week"))
    return cw.where(is_covered()).agg(
        F.count(F.lit(1)).alias("covered"), F.count_distinct(week).alias("city_weeks")
    )


def coverage_margin(cw: DataFrame, cfg: Settings) -> DataFrame:
    """Per city, covered windows and those sitting exactly at the station minimum."""
    return (
        cw.where(is_covered())
        .groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("covered"),
            F.count_if(F.col("station_count") == cfg.min_stations).alias("at_minimum"),
        )
    )


def windows_lost_without(stations: DataFrame, cw: DataFrame, cfg: Settings) -> DataFrame:
    """Per station, the covered windows that would fall below the minimum without it."""
    shares = (
        with_windows(stations, cfg.window_minutes)
        .groupBy(*S.CITY_KEY, "station_id")
        .agg(F.count(F.lit(1)).alias("rows_here"))
    )
    covered = cw.where(is_covered()).select(*S.CITY_KEY, "station_count")
    # Only windows near the minimum can be lost, so most rows end at this join.
    return (
        shares.join(covered, S.CITY_KEY, "inner")
        .where(F.col("station_count") - F.col("rows_here") < cfg.min_stations)
        .groupBy("city", "station_id")
        .agg(F.count(F.lit(1)).alias("windows_lost"))
    )


def coverage_vs_ceiling(
    admitted: DataFrame, stations: DataFrame, window: Stretch, cfg: Settings
) -> DataFrame:
    """Per admitted city: stations admitted and contributing, qualifying hours against
    the hours of the window; the total row has a null city."""
    population = admitted.groupBy("city").agg(F.count_distinct("station_id").alias("admitted"))
    contributing = stations.groupBy("city").agg(F.count_distinct("station_id").alias("contributing"))
    hours = (
        stations.groupBy("city", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.count_distinct("station_id").alias("n"))
        .groupBy("city")
        .agg(F.count_if(F.col("n") >= cfg.min_stations).alias("qualifying_hours"))
    )
    zero = F.lit(0).cast("bigint")
    rows = (
        population.join(contributing, "city", "left")
        .join(hours, "city", "left")
        .select(
            "city",
            "admitted",
            F.coalesce("contributing", zero).alias("contributing"),
            F.coalesce("qualifying_hours", zero).alias("qualifying_hours"),
            F.when(F.col("contributing") >= cfg.min_stations, F.lit(window.hours))
            .otherwise(0)
            .cast("bigint")
            .alias("ceiling_hours"),
        )
    )
    counts = ("admitted", "contributing", "qualifying_hours", "ceiling_hours")
    return rows.rollup("city").agg(*[F.sum(c).alias(c) for c in counts])


# --- value profiles -------------------------------------------------------------


def negative_profile(stations: DataFrame) -> DataFrame:
    """Retained negatives per city and pooled: share, range, median and bands."""
    x = F.col("pm25_ugm3")
    label = F.when(F.grouping("city") == 1, POOLED).otherwise(F.col("city"))
    counts = (
        stations.rollup("city")
        .agg(
            label.alias("arm"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(x < 0).alias("negatives"),
            F.min(F.when(x < 0, x)).alias("min_negative"),
            F.max(F.when(x < 0, x)).alias("max_negative"),
            F.count_if((x >= -1) & (x < 0)).alias("from_minus_1"),
            F.count_if((x >= -5) & (x < -1)).alias("from_minus_5"),
            F.count_if((x >= -10) & (x < -5)).alias("from_minus_10"),
            F.count_if(x < -10).alias("below_minus_10"),
        )
        .drop("city")
        .withColumn("share", F.col("negatives") / F.col("n_rows"))
    )
    below = stations.where(x < 0)
    medians = exact_median(below, ["city"], "pm25_ugm3", "median_negative").withColumnRenamed(
        "city", "arm"
    )
    pooled = exact_median(below, [], "pm25_ugm3", "median_negative").withColumn("arm", F.lit(POOLED))
    return counts.join(medians.unionByName(pooled).drop("n"), "arm", "left")


def station_medians(stations: DataFrame) -> DataFrame:
    return exact_median(stations, ["city", "station_id"], "pm25_ugm3", "median_value")


def value_probe(models: DataFrame, value: str = "model_pm25_ugm3") -> DataFrame:
    """Nulls, negatives and minimum per city; the total row has a null city."""
    x = F.col(value)
    return models.rollup("city").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count_if(x.isNull()).alias("nulls"),
        F.count_if(x < 0).alias("negatives"),
        F.min(x).alias("min_value"),
    )


def nearest_rank(df: DataFrame, keys: Sequence[str], value: str, q: float, name: str) -> DataFrame:
    return exact_percentiles(df, keys, value, {name: q}, nearest_rank=True)


def freshness_lag(records: DataFrame, written_at: str = "written_at", keys: Sequence[str] = ()) -> DataFrame:
    """Median seconds from the end of a window to the write of its record; over all, or per ``keys``.

    A record table keeps the time of each write, see ``read_record_table(..., written_at=True)``.
    """
    lag = F.unix_micros(F.col(written_at)) - F.unix_micros(F.col("window_end"))
    return exact_median(records.withColumn("_lag", lag / 1e6), list(keys), "_lag", "median_lag_s")


def component_profile(scored: DataFrame, cfg: Settings) -> DataFrame:
    """Spread of the pollution component and the index, and how often haze saturates."""
    saturated = F.count_if(F.col("mean_aerosol") >= cfg.aerosol_saturation)
    with_satellite = F.count("mean_aerosol")
    stats = []
    for column in ("pollution_index", "impact_index"):
        for fn in ("avg", "stddev", "min", "max"):
            stats.append(getattr(F, fn)(column).alias(f"{column}_{fn}"))
    return scored.agg(
        F.count(F.lit(1)).alias("windows"),
        *stats,
        F.when(with_satellite > 0, saturated / with_satellite).alias("saturated_share"),
    )


def monthly_normals(daily: DataFrame) -> DataFrame:
    """Region normals by month: mean over cities of each city's own month mean."""
    per_city = (
        daily.where(F.col("value").isNotNull())
        .groupBy("region", "city", F.month("date").alias("month"))
        .agg(F.avg("value").alias("city_mean"))
    )
    return (
        per_city.groupBy("region", "month")
        .agg(F.avg("city_mean").alias("normal_exact"), F.count(F.lit(1)).alias("cities"))
        .withColumn("normal", F.bround("normal_exact", 1))
    )


def months_without_values(daily: DataFrame) -> DataFrame:
    """(region, city, month) that hold no usable day; normals need this to be empty."""
    seen = daily.where(F.col("value").isNotNull()).select("region", "city", F.month("date").alias("month"))
    wanted = (
        daily.select("region", "city")
        .distinct()
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    )
    return wanted.join(seen.distinct(), ["region", "city", "month"], "left_anti")


def check_months(daily: DataFrame) -> None:
    """Refuse a series with empty months; `months_without_values` lists them as a table."""
    missing = months_without_values(daily).count()
    if missing:
        raise ValueError(f"{missing} city months hold no usable daily value")


# --- latest and first values ----------------------------------------------------


def latest_per_region(records: DataFrame, cfg: Settings) -> DataFrame:
    """Newest window of each region with its label; combines map-side."""
    newest = F.max_by(F.struct("window_start", *S.INDEX_COLUMNS), "window_start")
    return (
        records.groupBy("region")
        .agg(newest.alias("_r"))
        .select("region", "_r.*")
        .withColumn("label", verbal_label(F.col("impact_index"), cfg))
    )


def first_admitted_value(observations: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The value first admitted for a key; later reads do not replace it."""
    first = F.min(F.struct(*order, value))
    return observations.groupBy(*keys).agg(first.alias("_f"), F.count(F.lit(1)).alias("reads")).select(
        *keys, F.col("_f")[value].alias(value), "reads"
    )


def inheritance_witness(records: DataFrame) -> DataFrame:
    """Could these records show a tier carried over in time or from a neighbour?

    A region whose consecutive windows differ is a region with two tiers, so
    minima and maxima decide all three questions without ordering a region.
    """
    ends = records.groupingSets([["region"], ["window_start"], []], "region", "window_start").agg(
        F.min("provenance_tier").alias("lo"), F.max("provenance_tier").alias("hi"), F.grouping_id().alias("by")
    )
    # Bits of the columns left out: 1 groups by region, 2 by window, 3 by nothing.
    differ, count = F.col("lo") != F.col("hi"), F.when(F.col("lo") == F.col("hi"), 1).otherwise(2)
    one = ends.agg(
        F.coalesce(F.max(F.when((F.col("by") == 3) & F.col("lo").isNotNull(), count)), F.lit(0)).cast("bigint").alias("tiers"),
        F.count_if((F.col("by") == 1) & differ).alias("regions_that_change"),
        F.count_if((F.col("by") == 2) & differ).alias("windows_with_contrast"),
    )
    return one.withColumn(
        "can_expose",
        (F.col("tiers") == 2) & (F.col("regions_that_change") > 0) & (F.col("windows_with_contrast") > 0),
    )


def run_counts(gated: DataFrame, records: DataFrame) -> DataFrame:
    """Consumed, forwarded and quarantined messages beside the records they gave."""
    bad = F.col("reason_code").isNotNull()
    messages = gated.select(F.lit(1).alias("c"), F.when(bad, 1).otherwise(0).alias("q"), F.lit(0).alias("r"))
    rows = records.select(F.lit(0).alias("c"), F.lit(0).alias("q"), F.lit(1).alias("r"))
    return (
        messages.unionByName(rows)
        .agg(F.sum("c").alias("consumed"), F.sum("q").alias("quarantined"), F.sum("r").alias("records"))
        .withColumn("forwarded", F.col("consumed") - F.col("quarantined"))
    )
