"""Integrity guards. Each gives violation rows, and a verdict that fails on nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import Settings
from envgrade.operators.index import compute_records
from envgrade.operators.reconcile import city_model_values, city_station_values

# Means depend on the order of addition in their last digits only.
DIGITS = 9


class GuardFailure(AssertionError):
    """A guard found a violation, or had nothing to look at."""


def verdict(judged: DataFrame, name: str) -> DataFrame:
    """One row from rows with a ``violation`` flag; no rows is not a pass."""
    return judged.agg(
        F.lit(name).alias("guard"),
        F.count(F.lit(1)).alias("checked"),
        F.count_if("violation").alias("violations"),
    ).withColumn("passed", (F.col("checked") > 0) & (F.col("violations") == 0))


def enforce(judged: DataFrame, name: str) -> int:
    row = verdict(judged, name).first()
    if not row["passed"]:
        raise GuardFailure(f"{name}: {row['violations']} violations in {row['checked']} rows")
    return row["checked"]


def tier_is_earned(records: DataFrame) -> DataFrame:
    """The covered count equals the record's own detail and the tier follows from it."""
    covered = F.size(F.filter("city_comparisons", lambda c: c["state"] != S.NOT_COMPARED))
    earned = F.when(covered > 0, S.STATION_CHECKED).otherwise(S.UNCHECKED)
    fine = (F.col("covered_city_count") == covered) & (F.col("provenance_tier") == earned)
    return records.select(
        *S.KEY, "covered_city_count", "provenance_tier", (~F.coalesce(fine, F.lit(False))).alias("violation")
    )


def _same(a: Column, b: Column) -> Column:
    return F.round(a, DIGITS).eqNullSafe(F.round(b, DIGITS))


def reported_never_resolved(
    comparisons: DataFrame, stations: DataFrame, models: DataFrame, cfg: Settings
) -> DataFrame:
    """Both values of every comparison equal what the sources say, told anew from them.

    A comparison that is missing for a city-window the sources do hold is listed
    too, provided its region-window was reported at all.
    """
    said = (
        city_station_values(stations, cfg)
        .select(*S.CITY_KEY, F.col("station_pm25_ugm3").alias("station_said"))
        .join(
            city_model_values(models, cfg).withColumnRenamed("model_pm25_ugm3", "model_said"),
            S.CITY_KEY,
            "full_outer",
        )
    )
    reported = comparisons.select(
        *S.CITY_KEY, "station_pm25_ugm3", "model_pm25_ugm3", F.lit(True).alias("reported")
    )
    said = said.join(comparisons.select(*S.KEY).distinct(), S.KEY, "left_semi")
    both = reported.join(said, S.CITY_KEY, "full_outer")
    fine = (
        F.coalesce("reported", F.lit(False))
        & _same(F.col("station_pm25_ugm3"), F.col("station_said"))
        & _same(F.col("model_pm25_ugm3"), F.col("model_said"))
    )
    return both.withColumn("violation", ~fine).drop("reported")


def _rounded_index(records: DataFrame) -> DataFrame:
    types = dict(records.dtypes)
    return records.select(
        *S.KEY,
        *[F.round(c, DIGITS).alias(c) if types[c] == "double" else F.col(c) for c in S.INDEX_COLUMNS],
    )


def same_index(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct index rows of both sides, flagged where the sides hold them unequally often."""
    one, zero = F.lit(1), F.lit(0)
    left = _rounded_index(a).withColumns({"_a": one, "_b": zero})
    right = _rounded_index(b).withColumns({"_a": zero, "_b": one})
    return (
        left.unionByName(right)
        .groupBy(*S.KEY, *S.INDEX_COLUMNS)
        .agg((F.sum("_a") != F.sum("_b")).alias("violation"))
    )


def stations_do_not_move_the_index(events: DataFrame, cfg: Settings) -> DataFrame:
    without = events.where(F.col("event_type") != S.STATION)
    return same_index(compute_records(events, cfg), compute_records(without, cfg))


def reconciling_keeps_the_index(records: DataFrame, reconciled: DataFrame) -> DataFrame:
    return same_index(records, reconciled)


def funnel_is_monotone(funnel: DataFrame) -> DataFrame:
    steps = ["in_radius", "fixed", "reference_grade", "with_pm25_sensor", "admitted"]
    falling = [F.col(a) >= F.col(b) for a, b in zip(steps, steps[1:])]
    fine = falling[0] & falling[1] & falling[2] & falling[3]
    return funnel.withColumn("violation", ~fine)
