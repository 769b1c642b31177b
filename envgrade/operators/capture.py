"""Hour gate over provider rows, its accounting, and the checks around a capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import Settings
from envgrade.operators.percentiles import exact_percentiles

# Gate outcomes, in the order they are tested.
MALFORMED = "malformed"
NULL_VALUE = "null_value"
NOT_ONE_HOUR = "period_not_one_hour_long"
NOT_ALIGNED = "period_not_hour_aligned"
FLAGGED = "has_flags_true"
NO_SAMPLES = "observed_count_below_one"
RETAINED = "retained"
REMOVALS = (MALFORMED, NULL_VALUE, NOT_ONE_HOUR, NOT_ALIGNED, FLAGGED, NO_SAMPLES)
OFF_HOUR = (NOT_ONE_HOUR, NOT_ALIGNED)

INSTANT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$"


class CaptureFault(RuntimeError):
    """A capture that must not be used."""


def provider_instant(text: Column) -> Column:
    return F.when(text.rlike(INSTANT), text.try_cast("timestamp"))


def read_hour_entry(df: DataFrame, entry: str = "entry") -> DataFrame:
    """Typed columns of one provider row, a VARIANT of any shape."""

    def get(path: str, type_: str) -> Column:
        return F.try_variant_get(F.col(entry), path, type_)

    def kind(path: str) -> Column:
        return F.schema_of_variant(get(path, "variant"))

    number = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$"
    return df.withColumns(
        {
            "is_object": F.coalesce(F.schema_of_variant(entry).startswith("OBJECT"), F.lit(False)),
            "value_is_null": F.coalesce(kind("$.value") == "VOID", F.lit(True)),
            "value": F.when(kind("$.value").rlike(number), get("$.value", "double")),
            "starts": provider_instant(get("$.period.datetimeFrom.utc", "string")),
            "ends": provider_instant(get("$.period.datetimeTo.utc", "string")),
            # The flag is nested; a few responses carry it at the top.
            "flagged": F.coalesce(
                get("$.flagInfo.hasFlags", "boolean"), get("$.hasFlags", "boolean"), F.lit(False)
            ),
            "observed": F.when(
                kind("$.coverage.observedCount") == "BIGINT", get("$.coverage.observedCount", "bigint")
            ),
            "expected": F.when(
                kind("$.coverage.expectedCount") == "BIGINT", get("$.coverage.expectedCount", "bigint")
            ),
            "percent": get("$.coverage.percentComplete", "double"),
            "summary_min": get("$.summary.min", "double"),
            "summary_max": get("$.summary.max", "double"),
        }
    )


def gate_reason() -> Column:
    """First failing rule of an hour row. Negative values are retained."""
    starts, ends = F.col("starts"), F.col("ends")
    length = F.unix_micros(ends) - F.unix_micros(starts)
    return (
        F.when(~F.col("is_object"), MALFORMED)
        .when(F.col("value_is_null"), NULL_VALUE)
        .when(starts.isNull() | F.col("value").isNull(), MALFORMED)
        .when(ends.isNull() | (length != 3_600_000_000), NOT_ONE_HOUR)
        .when(starts != F.date_trunc("hour", starts), NOT_ALIGNED)
        .when(F.col("flagged"), FLAGGED)
        .when(F.col("observed").isNull() | (F.col("observed") < 1), NO_SAMPLES)
        .otherwise(RETAINED)
    )


def station_hour_gate(rows: DataFrame) -> DataFrame:
    return rows.withColumn("gate_reason", gate_reason())


def construction_of(observed: Column) -> Column:
    return F.when(observed == 1, S.PROVIDER_HOURLY).otherwise(S.COMPUTED_MEAN)


def retained_stations(gated: DataFrame) -> DataFrame:
    """Station observations of the rows the gate kept."""
    return gated.where(F.col("gate_reason") == RETAINED).select(
        F.col("starts").alias("ts"),
        "region",
        "city",
        "station_id",
        F.col("value").alias("pm25_ugm3"),
        F.col("observed").cast("int").alias("sample_count"),
        construction_of(F.col("observed")).alias("construction"),
    )


def sample_count_conflict() -> Column:
    """True where a second route to the sample count disagrees with it."""
    implied = F.bround(F.col("percent") / 100.0 * F.col("expected"), 0).cast("bigint")
    by_percent = (F.col("expected") > 0) & (implied != F.col("observed"))
    one_sample_range = (F.col("observed") == 1) & (F.col("summary_min") != F.col("summary_max"))
    return F.coalesce(by_percent, F.lit(False)) | F.coalesce(one_sample_range, F.lit(False))


def drop_count_conflicts(rows: DataFrame) -> DataFrame:
    return rows.where(~sample_count_conflict())


def gate_tally(gated: DataFrame) -> DataFrame:
    """One row: returned, retained and every removal reason, zeros included."""
    reason = F.col("gate_reason")
    return gated.agg(
        F.count(F.lit(1)).alias("returned"),
        F.count_if(reason == RETAINED).alias("retained"),
        *[F.count_if(reason == r).alias(r) for r in REMOVALS],
    )


def off_hour_rows(gated: DataFrame) -> DataFrame:
    return gated.where(F.col("gate_reason").isin(*OFF_HOUR))


def off_hour_breakdown(gated: DataFrame) -> DataFrame:
    """Off-hour rows by station and by city, with the total (``level`` 0, 1, 2)."""
    return (
        off_hour_rows(gated)
        .rollup("city", "station_id")
        .agg(
            (F.lit(2) - F.grouping("city") - F.grouping("station_id")).cast("int").alias("level"),
            F.count_if(F.col("gate_reason") == NOT_ALIGNED).alias("not_aligned"),
            F.count_if(F.col("gate_reason") == NOT_ONE_HOUR).alias("not_one_hour"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


def cities_without_rows(admitted: DataFrame, gated: DataFrame) -> DataFrame:
    """Admitted cities that contributed nothing, with the cause."""
    contributing = gated.where(F.col("gate_reason") == RETAINED).select("city").distinct()
    off = off_hour_rows(gated).groupBy("city").agg(F.count(F.lit(1)).alias("off_hour_rows"))
    return (
        admitted.select("city")
        .distinct()
        .join(contributing, "city", "left_anti")
        .join(off, "city", "left")
        .select(
            "city",
            F.when(F.col("off_hour_rows") > 0, "off_hour_periods")
            .otherwise("nothing_served")
            .alias("cause"),
            F.coalesce("off_hour_rows", F.lit(0).cast("bigint")).alias("off_hour_rows"),
        )
    )


def observed_bounds(stations: DataFrame, models: DataFrame) -> DataFrame:
    """Rows and realized span per side; an empty side still has its row."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("side"),
            F.count(F.lit(1)).alias("n_rows"),
            F.min("ts").alias("min_ts"),
            F.max("ts").alias("max_ts"),
        )

    return side(stations, "station").unionByName(side(models, "model"))


def rows_per_city(stations: DataFrame, models: DataFrame) -> DataFrame:
    tagged = stations.select("city", F.lit(1).alias("s"), F.lit(0).alias("m")).unionByName(
        models.select("city", F.lit(0).alias("s"), F.lit(1).alias("m"))
    )
    return tagged.groupBy("city").agg(
        F.sum("s").alias("station_rows"), F.sum("m").alias("model_rows")
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def worst_duplicates(df: DataFrame, keys: list[str], limit: int = 3) -> DataFrame:
    return duplicate_keys(df, keys).orderBy(F.desc("n"), *keys).limit(limit)


def uniqueness_report(df: DataFrame, keys: list[str]) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated"),
        F.coalesce(F.max("n"), F.lit(0).cast("bigint")).alias("worst"),
    )


def check_unique(df: DataFrame, keys: list[str]) -> int:
    report = uniqueness_report(df, keys).first()
    if report["duplicated"]:
        worst = [tuple(r) for r in worst_duplicates(df, keys).collect()]
        raise CaptureFault(f"{report['duplicated']} keys appear more than once, worst {worst}")
    return report["n_keys"]


def resolution_summary(resolved: DataFrame) -> DataFrame:
    """Admitted, resolved and refused locations, the refusals also by kind."""
    kind = F.col("kind")
    return resolved.agg(
        F.count(F.lit(1)).alias("locations_admitted"),
        F.count_if(kind == "resolved").alias("resolved"),
        F.count_if(kind != "resolved").alias("refused"),
        *[F.count_if(kind == k).alias(k) for k in ("no_pm25_sensor", "none_covering_window", "ambiguous_multiple_covering")],
    )


def breakdown_checks(gated: DataFrame, stations: DataFrame, resolved: DataFrame) -> DataFrame:
    """Every total beside the sum of its parts: ``check``, ``total``, ``parts``, ``ok``."""
    tally = gate_tally(gated).select(
        "returned", "retained", sum(F.col(r) for r in REMOVALS).alias("removed"),
        (F.col(NOT_ONE_HOUR) + F.col(NOT_ALIGNED)).alias("gate_off_hour"),
    )
    off = off_hour_breakdown(gated).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("level") == level, F.col("n_rows"))), F.lit(0)).alias(name)
            for level, name in ((0, "off_total"), (1, "off_by_city"), (2, "off_by_station"))
        ]
    )
    landed = stations.agg(F.count(F.lit(1)).alias("landed"))
    res = resolution_summary(resolved)
    pairs = {
        "gate_sum": (tally, "returned", F.col("retained") + F.col("removed")),
        "off_hour_by_city": (off, "off_total", F.col("off_by_city")),
        "off_hour_by_station": (off, "off_total", F.col("off_by_station")),
        "resolution_sum": (res, "locations_admitted", F.col("resolved") + F.col("refused")),
        "refusals_by_kind": (
            res, "refused",
            F.col("no_pm25_sensor") + F.col("none_covering_window") + F.col("ambiguous_multiple_covering"),
        ),
    }
    rows = [
        df.select(F.lit(name).alias("check"), F.col(total).alias("total"), parts.alias("parts"))
        for name, (df, total, parts) in pairs.items()
    ]
    # Totals that come from two reports meet in one aggregate instead of a join.
    for name, left, right in (
        ("landed_rows", landed.select(F.col("landed").alias("x")), tally.select(F.col("retained").alias("x"))),
        ("off_hour_gate", off.select(F.col("off_total").alias("x")), tally.select(F.col("gate_off_hour").alias("x"))),
    ):
        both = left.withColumn("s", F.lit("l")).unionByName(right.withColumn("s", F.lit("r")))
        rows.append(
            both.agg(
                F.lit(name).alias("check"),
                F.sum(F.when(F.col("s") == "l", F.col("x"))).alias("total"),
                F.sum(F.when(F.col("s") == "r", F.col("x"))).alias("parts"),
            )
        )
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out.withColumn("ok", F.col("total") == F.col("parts"))


def check_breakdowns(gated: DataFrame, stations: DataFrame, resolved: DataFrame) -> None:
    bad = breakdown_checks(gated, stations, resolved).where(~F.col("ok")).collect()
    if bad:
        raise CaptureFault(f"breakdowns do not sum: {[tuple(r) for r in bad]}")


def instrument_drift(a: DataFrame, b: DataFrame, key: str = "sensor_id") -> DataFrame:
    """Sensors used by only one of two captures."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return (
        left.exceptAll(right).withColumn("only_in", F.lit("first"))
        .unionByName(right.exceptAll(left).withColumn("only_in", F.lit("second")))
    )


def drift_by_location(a: DataFrame, b: DataFrame) -> DataFrame:
    """Locations of both captures whose sensors differ, with the sensors of either side only.

    Captures of different admission versions hold different populations by intent, so
    only locations that both hold are compared.
    """
    keys = ["location_id", "sensor_id"]
    left, right = a.select(*keys).distinct(), b.select(*keys).distinct()
    sides = left.exceptAll(right).withColumn("only_in", F.lit("first")).unionByName(
        right.exceptAll(left).withColumn("only_in", F.lit("second"))
    )
    both = left.select("location_id").intersect(right.select("location_id"))
    return sides.join(both, "location_id", "left_semi")


def revision_check(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Served value of the same hour in two fetches; ``revised`` where it changed."""
    left = a.select(*keys, F.col(value).alias("first_value"))
    right = b.select(*keys, F.col(value).alias("second_value"))
    return left.join(right, keys, "inner").withColumn(
        "revised", ~F.col("first_value").eqNullSafe(F.col("second_value"))
    )


def call_status_summary(calls: DataFrame) -> DataFrame:
    """Per city: calls by outcome, rate limits, and whether the city is void.

    Domain probes are left out: their negative answer is the answer.
    """
    station = calls.where(~F.col("domain_probe"))
    status = F.col("status")
    return station.groupBy("city").agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(status == 200).alias("ok_calls"),
        F.count_if(status == 429).alias("rate_limited"),
        F.count_if((status != 200) & (status != 429)).alias("other_failures"),
        F.coalesce(F.bool_or(status != 200), F.lit(False)).alias("void"),
    )


def calls_by_status(calls: DataFrame) -> DataFrame:
    """Calls per city and status code; domain probes are left out here too."""
    return calls.where(~F.col("domain_probe")).groupBy("city", "status").agg(F.count(F.lit(1)).alias("calls"))


def station_population(stations: DataFrame, off_hour: DataFrame | None = None) -> DataFrame:
    """Per city: distinct stations and hours, rows, exact median, range, off-hour rows.

    Hours are numbers already, so they are counted as bits set, which combine map-side; counted as distinct values
    beside the stations, each row would be copied for either.
    """
    hour = F.floor(F.unix_seconds("ts") / 3600)
    parts = stations.groupBy("city", F.bitmap_bucket_number(hour).alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(hour))).alias("hours"),
        F.min("pm25_ugm3").alias("min_value"),
        F.max("pm25_ugm3").alias("max_value"),
    )
    base = parts.groupBy("city").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("hours").alias("hours"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
    )
    distinct = stations.groupBy("city").agg(F.count_distinct("station_id").alias("stations"))
    base = base.join(distinct, base["city"].eqNullSafe(distinct["city"])).drop(distinct["city"])
    medians = exact_percentiles(stations, ["city"], "pm25_ugm3", {"median_value": 0.5}).drop("n")
    out = base.join(medians, "city", "left")
    if off_hour is None:
        return out
    off = off_hour.groupBy("city").agg(F.count(F.lit(1)).alias("off_hour_rows"))
    return out.join(off, "city", "left").withColumn(
        "off_hour_rows", F.coalesce("off_hour_rows", F.lit(0).cast("bigint"))
    )


def qualifying_city_hours(stations: DataFrame, cfg: Settings) -> DataFrame:
    """Hours with enough distinct stations per city, and the total (city null)."""
    hours = stations.groupBy("city", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count_distinct("station_id").alias("n")
    )
    return hours.rollup("city").agg(
        F.count_if(F.col("n") >= cfg.min_stations).alias("qualifying_hours"),
        F.count(F.lit(1)).alias("hours"),
    )


def capture_report(
    window_name: str,
    gated: DataFrame,
    stations: DataFrame,
    models: DataFrame,
    admitted: DataFrame,
    resolved: DataFrame,
) -> DataFrame:
    """The counts-only record of a capture: ``section``, ``name``, ``n``, ``text``.

    Counts, timestamps and causes, and no measured value.
    """

    def lines(df: DataFrame, section: str, name: Column, n: Column | None, text: Column | None) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"),
            name.cast("string").alias("name"),
            (F.lit(None) if n is None else n).cast("bigint").alias("n"),
            (F.lit(None) if text is None else text).cast("string").alias("text"),
        )

    def unpivot(row: DataFrame, section: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("bigint").alias("v")) for c in row.columns])
        return lines(row.select(F.inline(pairs)), section, F.col("k"), F.col("v"), None)

    bounds = observed_bounds(stations, models)
    span = F.concat_ws("/", F.date_format("min_ts", "yyyy-MM-dd HH:mm"), F.date_format("max_ts", "yyyy-MM-dd HH:mm"))
    cities = rows_per_city(stations, models)
    parts = [
        lines(bounds, "window_requested", F.lit(window_name), None, F.col("side")),
        lines(bounds, "observed_bounds", F.col("side"), F.col("n_rows"), span),
        lines(cities, "station_rows", F.col("city"), F.col("station_rows"), None),
        lines(cities, "model_rows", F.col("city"), F.col("model_rows"), None),
        unpivot(gate_tally(gated), "validity_gate"),
        unpivot(resolution_summary(resolved), "sensor_resolution"),
        lines(
            off_hour_breakdown(gated).where("level = 1"),
            "off_hour_by_city", F.col("city"), F.col("n_rows"), None,
        ),
    ]
    excluded = cities_without_rows(admitted, gated)
    parts.append(lines(excluded, "exclusions", F.col("city"), F.col("off_hour_rows"), F.col("cause")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
