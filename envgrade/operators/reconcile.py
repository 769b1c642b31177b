"""Station against model PM2.5 per city-window, and the roll-up to region-windows.

Both values are carried and neither replaces the other. Nothing here reads or
writes an index column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import Settings, Stretch
from envgrade.functions.scalars import mqo_tolerance
from envgrade.operators.index import with_windows
from envgrade.session import land


class WindowViolation(ValueError):
    """Rows outside the window a run was pointed at."""


def inside(span: Stretch, ts: str = "ts") -> Column:
    return (F.col(ts) >= F.lit(span.start)) & (F.col(ts) < F.lit(span.end))


def in_named_window(df: DataFrame, name: str, cfg: Settings, ts: str = "ts") -> DataFrame:
    return df.where(inside(cfg.window(name), ts))


def stray_report(df: DataFrame, span: Stretch, ts: str = "ts") -> DataFrame:
    """Rows, distinct stray timestamps, stray rows and the earliest stray."""
    stray = ~inside(span, ts)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(stray).alias("stray_rows"),
        F.count_distinct(F.when(stray, F.col(ts))).alias("stray_timestamps"),
        F.min(F.when(stray, F.col(ts))).alias("first_stray"),
    )


def check_inside_window(df: DataFrame, span: Stretch, ts: str = "ts") -> int:
    """Refuse the run when any row lies outside; returns the rows checked."""
    report = stray_report(df, span, ts).first()
    if report["stray_rows"]:
        raise WindowViolation(
            f"{report['stray_timestamps']} observation timestamps lie outside the run "
            f"window, earliest {report['first_stray'].isoformat()}"
        )
    return report["n_rows"]


def settled_only(df: DataFrame, as_of: Column, cfg: Settings, ts: str = "ts") -> DataFrame:
    """Hours old enough for the admission lag."""
    newest = F.date_trunc("hour", as_of) - F.expr(f"INTERVAL {cfg.admission_lag_hours} HOURS")
    return df.where(F.col(ts) <= newest)


def city_station_values(stations: DataFrame, cfg: Settings, distinct: bool = False) -> DataFrame:
    """Median and row count per city-window, on request the distinct stations too.

    A city-window holds one value per station and hour, so the built-in median, which
    keeps a group's distinct values in one buffer, is enough here.
    """
    rows = with_windows(stations.where(F.col("pm25_ugm3").isNotNull()), cfg.window_minutes)
    ids = [F.count_distinct("station_id").alias("distinct_stations")] if distinct else []
    return rows.groupBy(*S.CITY_KEY).agg(
        F.count(F.lit(1)).alias("station_count"), F.median("pm25_ugm3").alias("station_pm25_ugm3"), *ids
    )


def city_model_values(models: DataFrame, cfg: Settings) -> DataFrame:
    return (
        with_windows(models, cfg.window_minutes)
        .groupBy(*S.CITY_KEY)
        .agg(F.avg("model_pm25_ugm3").alias("model_pm25_ugm3"))
    )


def compare_city(df: DataFrame, cfg: Settings) -> DataFrame:
    """Add ``tolerance`` and ``state``; equality with the tolerance still agrees."""
    station, model = F.col("station_pm25_ugm3"), F.col("model_pm25_ugm3")
    comparable = (F.col("station_count") >= cfg.min_stations) & station.isNotNull() & model.isNotNull()
    limit = mqo_tolerance(station, cfg)
    return df.withColumn("tolerance", F.when(comparable, limit)).withColumn(
        "state",
        F.when(~comparable, S.NOT_COMPARED)
        .when(F.abs(station - model) > limit, S.DISAGREED)
        .otherwise(S.AGREED),
    )


def city_windows(stations: DataFrame, models: DataFrame, cfg: Settings) -> DataFrame:
    """Every city-window seen on either side, compared."""
    sides = (
        (stations.where(F.col("pm25_ugm3").isNotNull()), F.col("pm25_ugm3"), F.lit(None)),
        (models, F.lit(None), F.col("model_pm25_ugm3")),
    )
    told = [
        with_windows(df, cfg.window_minutes).select(
            *S.CITY_KEY, station.cast("double").alias("_station"), model.cast("double").alias("_model")
        )
        for df, station, model in sides
    ]
    # One aggregate over both sides: a city-window of one side only is simply half null.
    joined = told[0].unionByName(told[1]).groupBy(*S.CITY_KEY).agg(
        F.median("_station").alias("station_pm25_ugm3"),
        F.avg("_model").alias("model_pm25_ugm3"),
        F.count("_station").alias("station_count"),
    )
    return compare_city(joined, cfg).select(
        *S.CITY_KEY, "station_pm25_ugm3", "model_pm25_ugm3", "tolerance", "station_count", "state"
    )


def rollup_region(cw: DataFrame) -> DataFrame:
    """Region-window state, tier, counts and the per-city detail sorted by city.

    The detail array has one element per distinct city seen in the region-window, the
    width of the record itself. The gate takes any text as a city, so a feed that makes
    up cities widens it. Reports over many windows read the flat city-window rows.
    """
    flagged = F.count_if(F.col("state") == S.DISAGREED)
    covered = F.count_if(F.col("state") != S.NOT_COMPARED)
    detail = F.struct(*[F.col(f.name) for f in S.COMPARISON.fields])
    return cw.groupBy(*S.KEY).agg(
        F.when(flagged > 0, S.DISAGREED)
        .when(covered > 0, S.AGREED)
        .otherwise(S.NOT_COMPARED)
        .alias("pm25_disagreement"),
        F.when(covered > 0, S.STATION_CHECKED).otherwise(S.UNCHECKED).alias("provenance_tier"),
        flagged.alias("flagged_city_count"),
        covered.alias("covered_city_count"),
        F.array_sort(F.collect_list(detail)).alias("city_comparisons"),
    )


def attach_reconciliation(records: DataFrame, rollup: DataFrame) -> DataFrame:
    """Records with their comparison; index columns pass through unchanged."""
    base = records.select(*S.KEY, *S.INDEX_COLUMNS)
    joined = base.join(rollup, S.KEY, "left")
    empty = F.array().cast(S.RECORD_SCHEMA["city_comparisons"].dataType)
    zero = F.lit(0).cast("bigint")
    return joined.select(
        *S.KEY,
        *S.INDEX_COLUMNS,
        F.coalesce("pm25_disagreement", F.lit(S.NOT_COMPARED)).alias("pm25_disagreement"),
        F.coalesce("provenance_tier", F.lit(S.UNCHECKED)).alias("provenance_tier"),
        F.coalesce("flagged_city_count", zero).alias("flagged_city_count"),
        F.coalesce("covered_city_count", zero).alias("covered_city_count"),
        F.coalesce("city_comparisons", empty).alias("city_comparisons"),
    )


def city_windows_without_record(cw: DataFrame, records: DataFrame) -> DataFrame:
    """City-windows the attachment leaves out, so that the loss can be reported."""
    return cw.join(records.select(*S.KEY), S.KEY, "left_anti")


def reconcile_rows(records: DataFrame, stations: DataFrame, models: DataFrame, cfg: Settings) -> DataFrame:
    """The lazy composition, for callers that already checked their window."""
    return attach_reconciliation(records, rollup_region(city_windows(stations, models, cfg)))


def reconcile(
    records: DataFrame,
    stations: DataFrame,
    models: DataFrame,
    cfg: Settings,
    *,
    window: Stretch,
) -> DataFrame:
    """Reconcile one named window; runs a check over both inputs before returning."""
    check_inside_window(stations.select("ts").unionByName(models.select("ts")), window)
    return reconcile_rows(records, stations, models, cfg)


def explode_comparisons(records: DataFrame) -> DataFrame:
    """Flat city-window rows back out of the records."""
    return records.select(*S.KEY, F.inline("city_comparisons"))


def span_nodes(spans: DataFrame, unit_minutes: int) -> DataFrame:
    """Each half-open span under the dyadic nodes that make it up: at most two of each length, whatever the span's.

    A node of level k is 2**k units long and starts at a multiple of its length. A span that does not begin and end
    with a unit is listed under the units it touches too.
    """
    micros = unit_minutes * 60_000_000
    low = F.floor(F.unix_micros("window_start") / micros)
    high = F.floor((F.unix_micros("window_end") - 1) / micros) + 1
    held = spans.withColumns({"_low": low, "_high": high}).where("_low < _high")

    def at(level: Column) -> Column:
        size = F.pow(F.lit(2.0), level)
        first, last = F.ceil(F.col("_low") / size), F.floor(F.col("_high") / size)
        odd = [F.when((first < last) & (F.pmod(n, F.lit(2)) == 1), n) for n in (first, last)]
        ends = (odd[0], odd[1] - 1)
        return F.array(*[F.struct(level.cast("int").alias("_level"), n.cast("bigint").alias("_node")) for n in ends])

    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.col("_high") - F.col("_low"))).cast("int"))
    nodes = F.filter(F.array_distinct(F.flatten(F.transform(levels, at))), lambda n: n["_node"].isNotNull())
    return held.select(*spans.columns, F.inline(nodes))


def events_in_spans(events: DataFrame, spans: DataFrame, unit_minutes: int = 1, part_rows: int = 1_000_000) -> DataFrame:
    """Attach events to arbitrary half-open spans of their region.

    Tumbling windows never need this: their key is computed from ``ts``. Free spans, a minute or a year long, are listed
    under dyadic nodes and an event under one node of each length in use, which turns the interval condition into an
    equi join plus a filter. ``unit_minutes`` is the length of the smallest node; spans of one grid take that of the
    grid, and are then listed once. The events of each node are counted first, which combines map-side. A node with
    more than ``part_rows`` is dealt into parts by a hash of the row, and its spans are listed under each part.
    """
    micros, key = unit_minutes * 60_000_000, ["region", "_level", "_node"]
    listed = span_nodes(spans, unit_minutes)
    # One number per length of node.
    levels = sorted(r[0] for r in listed.select("_level").distinct().collect())
    unit = F.floor(F.unix_micros("ts") / micros)
    keyed = events.withColumn("_level", F.explode(F.lit(levels).cast("array<int>"))).withColumn(
        "_node", F.floor(unit / F.pow(F.lit(2.0), F.col("_level")))
    )
    counts = keyed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / part_rows).alias("_parts")).where("_parts > 1")
    # Written down, its size is known: small, it goes to the events; large, its join is one that can be split.
    hot = land(counts.join(listed.select(*key).distinct(), key, "left_semi"), "hot-nodes")
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    hashed = [F.col(f"`{c}`") for c, kind in events.dtypes if "map<" not in kind and "variant" not in kind]
    own = F.pmod(F.xxhash64(*hashed), parts)
    dealt = keyed.join(hot, key, "left").withColumn("_part", own).drop("_parts")
    spread = listed.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    return (
        dealt.join(spread.drop("_parts"), [*key, "_part"], "inner")
        .where((F.col("ts") >= F.col("window_start")) & (F.col("ts") < F.col("window_end")))
        .drop("_level", "_node", "_part")
    )
