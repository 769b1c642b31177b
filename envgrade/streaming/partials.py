"""Mergeable aggregates of windows, so that a batch never reads raw rows again.

Means are kept as sums and counts. An exact median needs the values: a city-window is kept as each distinct station
value and how often it came, which is what the built-in percentile takes. Both merge by adding up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envgrade import schemas as S
from envgrade.config import Settings
from envgrade.operators.index import as_records, index_inputs, score_windows, with_windows
from envgrade.operators.reconcile import attach_reconciliation, compare_city, rollup_region
from envgrade.sources import generations as G

# What a window is scored by, and the kind of event and field it is the mean of.
MEANS = {
    "mean_temperature_c": (S.WEATHER, "temperature_c"),
    "mean_rainfall_mm": (S.WEATHER, "rainfall_mm"),
    "mean_vegetation": (S.SATELLITE, "vegetation_index"),
    "mean_aerosol": (S.SATELLITE, "aerosol_index"),
    "mean_cloud_pct": (S.SATELLITE, "cloud_cover_pct"),
    "model_pm25_ugm3": (S.SATELLITE, "model_pm25_ugm3"),
}
COUNTS = {"n_weather": S.WEATHER, "n_satellite": S.SATELLITE}


def index_partials(events: DataFrame, cfg: Settings) -> DataFrame:
    """Per region-window: counts of either kind, and sum and count behind each mean."""
    kind = F.col("event_type")
    aggregates = [F.count_if(kind == k).alias(n) for n, k in COUNTS.items()]
    for name, (k, field) in MEANS.items():
        value = F.when(kind == k, F.col(field).cast("double"))
        aggregates += [F.sum(value).alias(f"sum_{name}"), F.count(value).alias(f"count_{name}")]
    return with_windows(index_inputs(events), cfg.window_minutes).groupBy(*S.KEY).agg(*aggregates)


def merged_index(partials: DataFrame) -> DataFrame:
    added = [c for c in partials.columns if c not in S.KEY]
    return partials.groupBy(*S.KEY).agg(*[F.sum(c).alias(c) for c in added])


def windows_of(partials: DataFrame) -> DataFrame:
    """The layout that windows are scored from; a mean of nothing is null."""
    means = [
        F.when(F.col(f"count_{n}") > 0, F.col(f"sum_{n}") / F.col(f"count_{n}")).alias(n) for n in MEANS
    ]
    return partials.select(*S.KEY, *COUNTS, *means)


def city_partials(events: DataFrame, cfg: Settings) -> DataFrame:
    """Per city-window and distinct station value its count; the models' sum and count stand where it is null."""
    station = (F.col("event_type") == S.STATION) & F.col("pm25_ugm3").isNotNull()
    model = F.col("event_type") == S.SATELLITE
    rows = with_windows(events.where(station | model), cfg.window_minutes)
    value = F.when(station, F.col("pm25_ugm3").cast("double"))
    return rows.groupBy(*S.CITY_KEY, value.alias("station_value")).agg(
        F.count_if(station).alias("station_n"),
        F.sum(F.when(model, F.col("model_pm25_ugm3").cast("double"))).alias("model_sum"),
        F.count(F.when(model, F.col("model_pm25_ugm3"))).alias("model_n"),
    )


def merged_cities(partials: DataFrame) -> DataFrame:
    added = [F.sum(c).alias(c) for c in ("station_n", "model_sum", "model_n")]
    return partials.groupBy(*S.CITY_KEY, "station_value").agg(*added)


def cities_of(partials: DataFrame, cfg: Settings) -> DataFrame:
    """Every city-window, compared: the exact median of its stations against the mean of its models."""
    models = F.sum("model_n")
    values = partials.groupBy(*S.CITY_KEY).agg(
        F.percentile("station_value", 0.5, F.col("station_n")).alias("station_pm25_ugm3"),
        F.when(models > 0, F.sum("model_sum") / models).alias("model_pm25_ugm3"),
        F.sum("station_n").alias("station_count"),
    )
    return compare_city(values, cfg).select(
        *S.CITY_KEY, "station_pm25_ugm3", "model_pm25_ugm3", "tolerance", "station_count", "state"
    )


def _kept_schema(frame: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema.fields])


def fold_events(
    events: DataFrame, path: str, cfg: Settings, batch_id: int, run: str, index: bool = True
) -> tuple[DataFrame | None, DataFrame]:
    """Add a batch of events to the partials under ``path``; give back the touched windows (None without ``index``)
    and their compared cities, from all that the run has read so far."""
    spark = events.sparkSession
    held = events.persist()
    try:
        touched = with_windows(held, cfg.window_minutes).select(*S.KEY).distinct()
        days = G.touched_days(touched)
        parts = [("cities", city_partials(held, cfg), merged_cities)]
        if index:
            parts.append(("index", index_partials(held, cfg), merged_index))
        found = {}
        for name, frame, merge in parts:
            G.fold_in(frame, f"{path}/{name}", batch_id, run, merge)
            stands = G.newest(spark, f"{path}/{name}", days, run)
            found[name] = G.read(spark, f"{path}/{name}", stands, _kept_schema(frame))
    finally:
        held.unpersist()
    cities = cities_of(found["cities"].join(touched, S.KEY, "left_semi"), cfg)
    return (windows_of(found["index"].join(touched, S.KEY, "left_semi")) if index else None), cities


def folded_records(windows: DataFrame, cities: DataFrame, cfg: Settings) -> DataFrame:
    """Reconciled records of windows and their cities."""
    return attach_reconciliation(as_records(score_windows(windows, cfg)), rollup_region(cities))


def split_late(
    events: DataFrame, path: str, cfg: Settings, batch_id: int, run: str
) -> tuple[DataFrame, DataFrame]:
    """Events of a batch in time for their windows, and those whose window was closed when the batch came.

    A window is closed for a batch once its end lies ``cfg.watermark`` or more before the newest event time of all
    batches before it in its run. That time is kept under ``path``, a row for this batch and one for the batch before,
    so a batch that is written again is cut where its first attempt was. The first batch finds every window open.
    """
    spark, table = events.sparkSession, f"{path}/newest"
    top = f"{table}/{G.named(spark, 'run', run)}"
    found = sorted((int(n.removeprefix("batch_id=")), f"{top}/{n}") for n in G.children(spark, top))
    before = [folder for n, folder in found if n < batch_id]
    own = events.agg(F.max("ts").alias("newest"))
    known = spark.read.schema(own.schema).parquet(before[-1]) if before else spark.createDataFrame([], own.schema)
    # One row, bounded: it goes into the plan as a value, so that the split is a filter.
    newest = known.agg(F.unix_micros(F.max("newest"))).first()[0]
    own.union(known).agg(F.max("newest").alias("newest")).coalesce(1).write.mode("overwrite").parquet(f"{top}/batch_id={batch_id:012d}")
    G.remove(spark, before[:-1])
    if newest is None:
        return events, events.limit(0)
    closed = F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {cfg.watermark}")
    late = F.coalesce(F.col("window_end") <= closed, F.lit(False))
    rows = with_windows(events, cfg.window_minutes)
    return rows.where(~late).select(*events.columns), rows.where(late).select(*events.columns)


def counted_rows(spark: SparkSession, path: str) -> DataFrame:
    """Per kind of event how many rows the windows under ``path`` have counted, from the generations that stand."""
    def standing(name: str, *counts: str) -> DataFrame:
        schema = T.StructType([T.StructField(n, T.LongType()) for n in counts])
        rows = spark.read.schema(G.with_parts(schema)).parquet(f"{path}/{name}")
        part = [c for c in G.PARTS if c != "gen"]
        return rows.join(rows.groupBy(*part).agg(F.max("gen").alias("gen")), list(G.PARTS), "left_semi")

    def total(count: str, kind: str):
        return F.coalesce(F.sum(count), F.lit(0)).alias(kind)

    counts = standing("index", *COUNTS).agg(*[total(n, k) for n, k in COUNTS.items()]).join(
        standing("cities", "station_n").agg(total("station_n", S.STATION))
    )
    return counts.unpivot([], [*COUNTS.values(), S.STATION], "event_type", "counted_rows")


def records_at(spark: SparkSession, path: str, touched: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of a record table in the regions and days that some windows touch."""
    return G.read(spark, path, G.all_runs(spark, path, G.touched_days(touched)), schema)
