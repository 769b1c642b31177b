"""Configuration tables as DataFrames. Their size is fixed by the settings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.config import Settings


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs))).select(*columns)


def _monthly(spark: SparkSession, table, column: str, cfg: Settings) -> DataFrame:
    rows = [(r, m, float(v)) for r, months in table.items() for m, v in enumerate(months, 1)]
    return literal_table(spark, ["region", "month", column], rows)


def monthly_normals(spark: SparkSession, cfg: Settings) -> DataFrame:
    return _monthly(spark, cfg.temperature_normals, "normal_c", cfg)


def vegetation_reference(spark: SparkSession, cfg: Settings) -> DataFrame:
    return _monthly(spark, cfg.vegetation_reference, "vegetation_index", cfg)
