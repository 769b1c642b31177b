"""Station admission: radius search, funnel, and resolving locations to sensors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envgrade.config import Settings, Stretch
from envgrade.functions.scalars import haversine_m, station_radius_m


def with_radius(grid: DataFrame, cfg: Settings) -> DataFrame:
    """Grid step by domain, search radius and whether the cap was binding."""
    step = F.when(F.col("domain") == "europe", cfg.grid_step_europe).otherwise(cfg.grid_step_global)
    out = grid.withColumn("step", step)
    radius = station_radius_m(F.col("step"), F.col("grid_lat"), cfg)
    return out.withColumn("radius_m", radius)


# A circle whose top or bottom lies beyond this latitude is searched in whole degrees, as its width in degrees grows.
POLAR = 80.0
FINEST = 10


def _cell(degrees: Column, level: Column) -> Column:
    return F.floor(degrees * F.pow(F.lit(2.0), level))


def _around(cell: Column, level: Column) -> Column:
    """The number of a cell of longitude, counted from the date line."""
    half = (F.lit(180) * F.pow(F.lit(2.0), level)).cast("bigint")
    return F.pmod(cell + half, half * 2)


def radius_candidates(locations: DataFrame, grid: DataFrame, cfg: Settings) -> DataFrame:
    """Locations paired with the grid points whose circle touches their cell; a superset of the pairs in reach.

    Cells are squares of 1, 1/2, 1/4 ... degrees. A grid point takes the size that fits its radius (more than half of
    it, at most all of it), and is listed under the cells that its circle can touch, about a dozen. A location is
    listed once for each size in use. Cells near a pole span every longitude; near the date line they wrap.
    """
    # A margin of 1 % covers the difference between the two earth radii.
    lat_reach = F.col("radius_m") * 1.01 / F.lit(cfg.degree_km * 1000.0)
    widest = F.least(F.abs(F.col("grid_lat")) + lat_reach, F.lit(90.0))
    lon_reach = F.when(widest > 89.0, 180.0).otherwise(
        F.least(F.lit(180.0), lat_reach / F.cos(F.radians(widest)))
    )
    fitting = F.least(F.lit(FINEST), F.greatest(F.lit(0), F.ceil(-F.log2(lat_reach)).cast("int")))
    sized = grid.withColumn("_level", F.when((widest > POLAR) | (lat_reach <= 0), 0).otherwise(fitting).cast("int"))
    # At most FINEST + 1 numbers, whatever the size of the grid.
    levels = sorted(r[0] for r in sized.select("_level").distinct().collect() if r[0] is not None)

    def touched(at: str, reach: Column) -> Column:
        level = F.col("_level")
        return F.sequence(_cell(F.col(at) - reach, level), _cell(F.col(at) + reach, level))

    cells = sized.withColumn("_lat", F.explode(touched("grid_lat", lat_reach))).withColumn(
        # A reach over half the globe on both sides meets itself.
        "_lon", F.explode(F.array_distinct(F.transform(touched("grid_lon", lon_reach), lambda c: _around(c, F.col("_level")))))
    )
    keyed = locations.withColumn("_level", F.explode(F.lit(levels).cast("array<int>"))).withColumns(
        {
            "_lat": _cell(F.col("latitude"), F.col("_level")),
            "_lon": _around(_cell(F.col("longitude"), F.col("_level")), F.col("_level")),
        }
    )
    return keyed.join(cells, ["_level", "_lat", "_lon"], "inner").drop("_level", "_lat", "_lon")


def stations_in_radius(locations: DataFrame, grid: DataFrame, cfg: Settings) -> DataFrame:
    """Locations within the radius of a grid point, with their distance: an equi join on cells, then the distance."""
    distance = haversine_m(F.col("latitude"), F.col("longitude"), F.col("grid_lat"), F.col("grid_lon"))
    pairs = radius_candidates(locations, grid, cfg).withColumn("distance_m", distance)
    return pairs.where(F.col("distance_m") <= F.col("radius_m"))


def sensor_identity(cfg: Settings) -> Column:
    """What is wrong with a sensor's claim to measure PM2.5; null when nothing is."""
    wrong = (F.col("parameter") != cfg.pm25_parameter) | (F.col("units") != cfg.pm25_unit)
    said = F.concat(
        F.lit("measures "), F.coalesce("parameter", F.lit("?")), F.lit(" in "), F.coalesce("units", F.lit("?"))
    )
    return F.when(F.coalesce(wrong, F.lit(True)), said)


def check_pm25_sensor(sensors: DataFrame, cfg: Settings) -> DataFrame:
    return sensors.withColumn("rejection", sensor_identity(cfg))


def brackets(span: Stretch) -> Column:
    inside = (F.col("datetime_first") <= F.lit(span.start)) & (F.col("datetime_last") >= F.lit(span.end))
    return F.coalesce(inside, F.lit(False))


def _named(sensors: DataFrame, span: Stretch, cfg: Settings) -> DataFrame:
    return sensors.where(F.col("parameter") == cfg.pm25_parameter).withColumns(
        {
            "_wrong": sensor_identity(cfg).isNotNull(),
            "_covers": brackets(span),
        }
    )


def resolve_sensors(locations: DataFrame, sensors: DataFrame, span: Stretch, cfg: Settings) -> DataFrame:
    """Each location with its one covering PM2.5 sensor, or the kind of its refusal.

    A location whose PM2.5 sensor reports in another unit is refused with the kind
    of a location without cover, and told apart by ``identity_fault``.
    """
    per_location = _named(sensors, span, cfg).groupBy("location_id").agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if("_covers").alias("covering"),
        F.bool_or("_wrong").alias("identity_fault"),
        F.max(F.when(F.col("_covers"), F.col("sensor_id"))).alias("_only"),
    )
    joined = locations.join(per_location, "location_id", "left")
    zero = F.lit(0).cast("bigint")
    kind = (
        F.when(F.col("candidates").isNull(), "no_pm25_sensor")
        .when(F.col("identity_fault") | (F.col("covering") == 0), "none_covering_window")
        .when(F.col("covering") > 1, "ambiguous_multiple_covering")
        .otherwise("resolved")
    )
    return joined.withColumn("kind", kind).select(
        *locations.columns,
        "kind",
        F.when(F.col("kind") == "resolved", F.col("_only")).alias("pm25_sensor_id"),
        F.coalesce("candidates", zero).alias("candidates"),
        F.coalesce("covering", zero).alias("covering"),
        F.coalesce("identity_fault", F.lit(False)).alias("identity_fault"),
    )


def _pm25_by_location(sensors: DataFrame, span: Stretch, cfg: Settings) -> DataFrame:
    pm25 = sensors.where(F.col("parameter") == cfg.pm25_parameter).withColumn("_covers", brackets(span))
    # The first sensor by list position, as an aggregate that combines map-side.
    return pm25.groupBy("location_id").agg(
        F.bool_or("_covers").alias("any_covers"),
        F.min_by("_covers", F.struct("position", "sensor_id")).alias("first_covers"),
    )


def _judged(in_radius: DataFrame, sensors: DataFrame, span: Stretch, cfg: Settings) -> DataFrame:
    fixed = ~F.coalesce(F.col("is_mobile"), F.lit(False))
    graded = fixed & F.coalesce(F.col("is_monitor"), F.lit(False))
    joined = in_radius.join(_pm25_by_location(sensors, span, cfg), "location_id", "left")
    measured = graded & F.col("any_covers").isNotNull()
    return joined.withColumns(
        {
            "_fixed": fixed,
            "_graded": graded,
            "_measured": measured,
            "_admitted": measured & F.coalesce(F.col("any_covers"), F.lit(False)),
            "_first": measured & F.coalesce(F.col("first_covers"), F.lit(False)),
        }
    )


def admitted_locations(in_radius: DataFrame, sensors: DataFrame, span: Stretch, cfg: Settings) -> DataFrame:
    """One row per admitted location; the id list of a city is these rows."""
    return _judged(in_radius, sensors, span, cfg).where("_admitted").select(
        "region", "city", "location_id", F.col("location_id").cast("string").alias("station_id")
    )


def admission_funnel(in_radius: DataFrame, sensors: DataFrame, span: Stretch, cfg: Settings) -> DataFrame:
    """Per city, how many locations pass each step; each count bounds the next."""
    return _judged(in_radius, sensors, span, cfg).groupBy("city").agg(
        F.count(F.lit(1)).alias("in_radius"),
        F.count_if("_fixed").alias("fixed"),
        F.count_if("_graded").alias("reference_grade"),
        F.count_if("_measured").alias("with_pm25_sensor"),
        F.count_if("_admitted").alias("admitted"),
    )


def admission_shortfall(in_radius: DataFrame, sensors: DataFrame, span: Stretch, cfg: Settings) -> DataFrame:
    """Per city: locations the first-sensor rule leaves out, and those any sensor recovers."""
    return _judged(in_radius, sensors, span, cfg).groupBy("city").agg(
        F.count_if(F.col("_measured") & ~F.col("_first")).alias("examined"),
        F.count_if("_first").alias("admitted_first_sensor"),
        F.count_if("_admitted").alias("admitted_any_sensor"),
        F.count_if(F.col("_admitted") & ~F.col("_first")).alias("recovered"),
    )


def mapping_is_one_to_one(resolved: DataFrame) -> DataFrame:
    done = resolved.where(F.col("kind") == "resolved")
    return done.agg(
        F.count_distinct("location_id").alias("locations"),
        F.count_distinct("pm25_sensor_id").alias("sensors"),
        F.count_if(F.col("pm25_sensor_id") == F.col("location_id")).alias("same_as_location"),
    ).withColumn(
        "one_to_one", (F.col("locations") == F.col("sensors")) & (F.col("same_as_location") == 0)
    )

